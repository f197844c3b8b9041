"""Fields that rules name and flow tables usually lack, derived from the flows themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_rare_destination(flows: DataFrame, destination: str, at_most: int) -> DataFrame:
    """Add the rule field ``rare_destination``: at most so many flows go there.

    Destinations are counted map-side first, and only the rare ones take part in the join,
    so frequent ones meet no partner; Spark may split them or broadcast the rare ones.  A
    null destination is not rare.  An existing field of the name is replaced.
    """
    flows = flows.drop("rare_destination")
    counts = flows.groupBy(destination).agg(F.count(F.lit(1)).alias("__flows"))
    rare = counts.filter(F.col("__flows") <= at_most).select(
        destination, F.lit(True).alias("rare_destination")
    )
    return flows.join(rare, destination, "left").withColumn(
        "rare_destination", F.coalesce("rare_destination", F.lit(False))
    )
