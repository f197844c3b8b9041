"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side of at most this many rows of at most some hundred bytes may be broadcast.
BROADCAST_ROWS = 100_000


# Texts reach Python in batches of some megabytes, so a worker's memory does not depend on
# how long ten thousand texts happen to be.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Apply the settings; queries and pipeline stages start with this, operators do not."""
    for name, value in BATCH_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows, else unchanged.

    Counting stops at the bound.  Callers pass a frame that is cheap to read (stored or
    aggregated); beyond the bound Spark joins by shuffling, with AQE splitting hot keys.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def whole_groups(
    batches: Iterable[pa.RecordBatch], key: str, least_rows: int = 4096
) -> Iterator[pa.Table]:
    """Tables that end where a group ends, from batches sorted by the column ``key``.

    A table has ``least_rows`` rows and what its last group needs beyond; callers bound the
    size of a group.
    """
    held = None
    slices = (
        batch.slice(at, least_rows)
        for batch in batches
        for at in range(0, batch.num_rows, least_rows)
    )
    for batch in slices:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if held.num_rows < least_rows:
            continue
        cut = pc.index(held[key], held[key][-1]).as_py()
        if cut:
            yield held.slice(0, cut)
            held = held.slice(cut)
    if held is not None:
        yield held
