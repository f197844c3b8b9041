"""Running totals in a global order, without a task that sees more than its share."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowverdict.llm.tables import broadcast_if_small
from flowverdict.sources.scratch import stored


def by_range(df: DataFrame, order: list[str], part: str = "part") -> DataFrame:
    """``df`` stored in range partitions of ``order``, whose number is the column ``part``."""
    ranged = df.repartitionByRange(*order).withColumn(part, F.spark_partition_id())
    return stored(ranged, "ranges")


def running_total(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over all rows before each row; ``order`` identifies the rows.

    The window runs inside range partitions; what came before a partition is a window over
    one row for each.
    """
    ranged = by_range(df, order, "__part")
    to_here = (Window.unboundedPreceding, -1)
    totals = ranged.groupBy("__part").agg(F.sum(value).alias("__total"))
    before = F.sum("__total").over(Window.orderBy("__part").rowsBetween(*to_here))
    before = totals.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    inside = F.sum(value).over(Window.partitionBy("__part").orderBy(*order).rowsBetween(*to_here))
    summed = ranged.withColumn("__inside", F.coalesce(inside, F.lit(0)))
    summed = summed.join(broadcast_if_small(stored(before, "totals")), "__part")
    return summed.withColumn(name, F.col("__before") + F.col("__inside")).drop(
        "__part", "__before", "__inside"
    )
