"""Minima, maxima and counts of features that a stream keeps per group.

Each micro-batch updates what earlier ones left, so a feature that is absent from a batch (null
or NaN) keeps its older bounds.  Rows are combined inside the map tasks first: a group that holds
most of a batch sends one row per task to its state, not its flows.

A group's state is a few numbers per feature.  It expires when the watermark (the latest event
time less ``delay``) has passed the group's latest time by ``idle``; a row with ``expired`` says so, and later flows of
the group start anew.  Flows older than the watermark still count: bounds have no
windows to close.  The state is in the query's checkpoint, so a restarted query goes on where it stopped and a
replayed batch is counted once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "rows long, latest timestamp, counts array<long>, minima array<double>, maxima array<double>"


def _partial(features: list[str]):
    """One row per group of an Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            plain = [
                pc.if_else(pc.is_nan(table[f]), pa.scalar(None, pa.float64()), table[f]) for f in features
            ]
            for f, column in zip(features, plain, strict=True):
                table = table.set_column(table.schema.get_field_index(f), f, column)
            wanted = [("__time", "max"), ([], "count_all")]
            wanted += [(f, how) for f in features for how in ("count", "min", "max")]
            found = table.group_by("__group").aggregate(wanted).combine_chunks()

            def lists(how: str, kind: pa.DataType, found=found) -> pa.Array:
                columns = [found[f"{f}_{how}"].to_numpy(zero_copy_only=False) for f in features]
                rows = np.array(columns, dtype=object).T.tolist() if columns else [[]] * found.num_rows
                rows = [[None if v is None or v != v else v for v in r] for r in rows]
                return pa.array(rows, pa.list_(kind))

            yield pa.record_batch(
                {
                    "group": found["__group"].combine_chunks(),
                    "rows": found["count_all"].combine_chunks(),
                    "latest": found["__time_max"].combine_chunks(),
                    "counts": lists("count", pa.int64()),
                    "minima": lists("min", pa.float64()),
                    "maxima": lists("max", pa.float64()),
                }
            )

    return run


def _bounds(rows, pick) -> np.ndarray:
    """The least or largest of lists in which None stands for no value."""
    found = np.array([[np.nan if v is None else v for v in r] for r in rows], dtype=float)
    return pick(found, axis=0)


def running_bounds(
    flows: DataFrame, group: str, time: str, features: list[str], delay: str, idle_seconds: int
) -> DataFrame:
    """A stream of updates: group, rows, latest, counts, minima, maxima, expired.

    An update tells all that is known of its group; the one of most rows since the last expiry
    is the latest.  A null group is a group of its own; rows without a time are left out.
    """
    narrow = flows.select(
        F.col(group).alias("__group"),
        F.col(time).cast("timestamp").alias("__time"),
        *[F.col(f).cast("double").alias(f) for f in features],
    ).filter("__time IS NOT NULL")
    kind = dict(narrow.dtypes)["__group"]
    partial = narrow.mapInArrow(_partial(features), f"group {kind}, {STATE}")
    partial = partial.withWatermark("latest", delay)

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            held = state.get
            state.remove()
            yield _shown(key, held, True)
            return
        rows, latest = [], []
        counts, low, high = [], [], []
        if state.exists:
            n, when, c, a, b = state.get
            rows, latest, counts, low, high = [n], [when], [c], [a], [b]
        for frame in frames:
            rows += frame["rows"].tolist()
            latest += frame["latest"].tolist()
            counts += frame["counts"].tolist()
            low += frame["minima"].tolist()
            high += frame["maxima"].tolist()
        when = pd.Timestamp(max(latest))
        held = (
            int(sum(rows)),
            when.to_pydatetime(),
            [int(v) for v in np.sum([list(c) for c in counts], axis=0)],
            [None if v != v else float(v) for v in _bounds(low, np.fmin.reduce)],
            [None if v != v else float(v) for v in _bounds(high, np.fmax.reduce)],
        )
        state.update(held)
        until = int(when.timestamp() * 1000) + idle_seconds * 1000
        state.setTimeoutTimestamp(max(until, state.getCurrentWatermarkMs() + 1))
        yield _shown(key, held, False)

    return partial.groupBy("group").applyInPandasWithState(
        update,
        f"group {kind}, {STATE}, expired boolean",
        STATE,
        "update",
        GroupStateTimeout.EventTimeTimeout,
    )


def _shown(key: tuple, held: tuple, expired: bool) -> pd.DataFrame:
    n, when, counts, low, high = held
    return pd.DataFrame(
        {
            "group": [key[0]], "rows": [n], "latest": [pd.Timestamp(when)], "counts": [list(counts)],
            "minima": [list(low)], "maxima": [list(high)], "expired": [expired],
        }
    )


def start_running_bounds(
    updates: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Write the updates of each micro-batch as Parquet; a replayed batch overwrites its folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = updates.writeStream.outputMode("update").foreachBatch(write)
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
