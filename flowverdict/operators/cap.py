"""Row caps and dense row numbers in a stated order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowverdict.sources.scratch import reliable_checkpoint, stored


def dense_index(df: DataFrame, order_by: list[str], name: str = "flow_idx") -> DataFrame:
    """Add 0, 1, 2, ... in the order of ``order_by``, which must identify each row.

    The rows are range-partitioned and sorted, so no task sees more than its share; the
    offset of each partition comes from the partition sizes.  The checkpoint fixes the
    partition bounds, which Spark would otherwise sample anew for each job; it is written
    when this function is called.
    """
    ordered = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    ordered = reliable_checkpoint(ordered.withColumn("__id", F.monotonically_increasing_id()))
    ordered = ordered.withColumns(
        {"__part": F.shiftright("__id", 33), "__row": F.col("__id").bitwiseAND((1 << 33) - 1)}
    )
    # One row per partition.
    sizes = ordered.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset")
    )
    numbered = ordered.join(F.broadcast(offsets), "__part")
    return numbered.withColumn(name, F.col("__offset") + F.col("__row")).drop(
        "__id", "__part", "__row", "__offset"
    )


def cut_off(df: DataFrame, n: int, order_by: list[str]) -> Row | None:
    """The order key of the n-th row; None if there are fewer rows.

    Only the keys are read and put into range partitions, unsorted.  Their counts tell the
    partition that holds the n-th row, and only that one is ranked.
    """
    ranged = df.select(*order_by).repartitionByRange(*order_by)
    ranged = stored(ranged.withColumn("__part", F.spark_partition_id()), "order-keys")
    sizes = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    # One row per partition.
    running = F.sum("__size").over(Window.orderBy("__part"))
    sizes = sizes.withColumn("__upto", running)
    edge = sizes.filter(f"__upto >= {n}").orderBy("__part").first()
    if edge is None:
        return None
    within = n - (edge["__upto"] - edge["__size"])
    rank = F.row_number().over(Window.partitionBy("__part").orderBy(*order_by))
    last = ranged.filter(F.col("__part") == edge["__part"]).withColumn("__rank", rank)
    # Equal keys share a range partition, so the row after the last one tells of a tie.
    found = last.filter(F.col("__rank").isin(within, within + 1)).orderBy("__rank")
    found = found.select(*order_by).collect()
    if len(found) == 2 and found[0] == found[1]:
        raise ValueError(f"the order key {tuple(found[0])} at row {n} is repeated")
    return found[0]


def row_cap(df: DataFrame, n: int | None, order_by: list[str]) -> DataFrame:
    """The first ``n`` rows in the order of ``order_by``; all of them for ``None``.

    The key of row ``n`` must not be that of row ``n + 1``, or it is an error.

    The same plan for every ``n``: the key of the n-th row is looked up when this function
    is called, the result is a lazy filter on it.  Nulls come first.
    """
    if n is None:
        return df
    if n <= 0:
        return df.limit(0)
    last = cut_off(df, n, order_by)
    if last is None:
        return df
    key = df.select(*order_by).schema
    if len(order_by) == 1 and not isinstance(key[0].dataType, T.StructType):
        # A comparison that the scan can use.
        column = F.col(order_by[0])
        if last[0] is None:
            return df.filter(column.isNull())
        return df.filter(column.isNull() | (column <= F.lit(last[0]).cast(key[0].dataType)))
    bound = df.sparkSession.createDataFrame([last], key).select(F.struct(*order_by)).scalar()
    return df.filter(F.struct(*order_by) <= bound)


def number_rows(df: DataFrame, order_by: list[str]) -> DataFrame:
    """Add ``flow_idx`` (see ``dense_index``)."""
    return dense_index(df, order_by)
