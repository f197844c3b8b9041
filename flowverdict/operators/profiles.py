"""Numeric profiles of groups: a mergeable quantile sketch, exact medians and deviations.

**Sketch.** A value above 0 falls into the bucket ``ceil(log(value) / log(gamma))`` with
gamma = (1 + accuracy) / (1 - accuracy); values of 0 and below share the lowest bucket.  A
sketch is a table (group, bucket, n), so it is built by an aggregate that combines map-side,
stored as Parquet, and merged by adding (``merge_sketches``): a busy group costs one row for each
bucket, some thousand at most.  The value returned for a rank lies within ``accuracy`` (relative) of the
exact value of that rank, since it stands for the bucket that holds that rank exactly.

**Medians** are exact, by counting in levels: the range of a group is cut into equal
intervals, flows are counted by interval, and the interval that holds the wanted rank is
cut again until few distinct values are left.  Every level is one aggregate; no
group and no interval is gathered in a task.

Nulls and NaN are left out of both; a group without values has no row.  A null group is a group of its
own.  Repeated rows count repeatedly, extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowverdict.sources.scratch import stored

ACCURACY = 0.01
LEAST_ROWS = 50
LOWEST = -(1 << 30)
PARTS = 1024
# Rows of an interval that are ranked by a window.
RANKED = 100_000
MAX_LEVELS = 200
BROADCAST_ROWS = 100_000


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def bucket_of(value: Column, accuracy: float = ACCURACY) -> Column:
    gamma = (1 + accuracy) / (1 - accuracy)
    number = F.ceil(F.ln(value) / F.lit(log(gamma)))
    # Infinity is above all buckets.
    number = F.when(value == float("inf"), F.lit(1 << 30)).otherwise(number)
    return F.when(value > 0, number).otherwise(F.lit(LOWEST)).cast("int")


def bucket_value(bucket: Column, accuracy: float = ACCURACY) -> Column:
    """The value that stands for a bucket; 0 for the lowest."""
    gamma = (1 + accuracy) / (1 - accuracy)
    middle = F.pow(F.lit(gamma), bucket) * (2 / (gamma + 1))
    return F.when(bucket == LOWEST, 0.0).otherwise(middle)


def _valued(df: DataFrame, group: str, value: str) -> DataFrame:
    rows = df.select(F.col(group).alias("group"), F.col(value).cast("double").alias("value"))
    return rows.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def quantile_sketch(df: DataFrame, group: str, value: str, accuracy: float = ACCURACY) -> DataFrame:
    """group, bucket, n."""
    rows = _valued(df, group, value).withColumn("bucket", bucket_of(F.col("value"), accuracy))
    return rows.groupBy("group", "bucket").agg(F.count(F.lit(1)).alias("n"))


def merge_sketches(*sketches: DataFrame) -> DataFrame:
    """The sketch of all rows that the sketches hold; they must be of one accuracy."""
    every = reduce(DataFrame.unionByName, sketches)
    return every.groupBy("group", "bucket").agg(F.sum("n").alias("n"))


def sketch_quantiles(sketch: DataFrame, share: float) -> DataFrame:
    """group, n, bucket that holds the value of rank ceil(share * n) (1 at least)."""
    order = Window.partitionBy("group").orderBy("bucket")
    rows = sketch.withColumns(
        {"upto": F.sum("n").over(order), "total": F.sum("n").over(Window.partitionBy("group"))}
    )
    wanted = F.greatest(F.lit(1), F.ceil(F.col("total") * F.lit(share)))
    rows = rows.filter(F.col("upto") >= wanted)
    return rows.groupBy("group").agg(F.max("total").alias("n"), F.min("bucket").alias("bucket"))


def with_response_abnormal(
    flows: DataFrame,
    group: str,
    value: str,
    sketch: DataFrame,
    share: float = 0.99,
    least_rows: int = LEAST_ROWS,
    accuracy: float = ACCURACY,
) -> DataFrame:
    """Add ``response_time_abnormal``: the value lies above its group's quantile.

    Groups that the sketch knows from fewer than ``least_rows`` rows, or not at all, are held
    against the quantile of all groups.  Nulls are not abnormal.  Compared by bucket.
    """
    everything = sketch.groupBy(F.lit(0).alias("group"), "bucket").agg(F.sum("n").alias("n"))
    overall = sketch_quantiles(everything, share).first()
    # Without any row in the sketch nothing is abnormal.
    overall = overall["bucket"] if overall else 1 << 30
    own = sketch_quantiles(sketch, share).filter(F.col("n") >= least_rows)
    own = own.select(F.col("group").alias("__group"), F.col("bucket").alias("__bucket"))
    flows = flows.drop("response_time_abnormal")
    joined = flows.join(_small(stored(own, "quantiles")), F.col(group).eqNullSafe(F.col("__group")), "left")
    number = F.col(value).cast("double")
    above = bucket_of(number, accuracy) > F.coalesce("__bucket", F.lit(overall))
    flag = F.coalesce(above & ~F.isnan(number) & number.isNotNull(), F.lit(False))
    return joined.withColumn("response_time_abnormal", flag).drop("__group", "__bucket")


def _ranked(rows: DataFrame) -> DataFrame:
    """group, which (0 / 1), found: the values of the lower and the upper middle rank."""
    sizes = rows.groupBy("group").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    # Ranks count from 0; ``before`` rows lie below the interval.
    wanted = sizes.select(
        "group",
        F.posexplode(F.array(F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2))).alias("which", "rank"),
        "low",
        "high",
        F.lit(0).cast("long").alias("before"),
        F.col("n").alias("size"),
    )
    wanted = stored(wanted, "intervals")
    done = []
    for _ in range(MAX_LEVELS):
        settled = (F.col("low") == F.col("high")) | (F.col("size") <= RANKED)
        done.append(wanted.filter(settled))
        wanted = wanted.filter(~settled)
        if wanted.isEmpty():
            break
        keyed = wanted.withColumnRenamed("group", "__group")
        inside = rows.join(_small(keyed), F.col("group").eqNullSafe(F.col("__group")))
        inside = inside.filter("value >= low AND value <= high")
        # Halved first, so that the width of the whole range of doubles is finite; monotone in the value.
        at = (F.col("value") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2)
        part = F.least(F.floor(at * PARTS), F.lit(PARTS - 1))
        counts = inside.withColumn("part", part).groupBy("group", "which", "rank", "before", "part")
        counts = counts.agg(F.count(F.lit(1)).alias("size"), F.min("value").alias("low"), F.max("value").alias("high"))
        order = Window.partitionBy("group", "which").orderBy("part")
        upto = F.sum("size").over(order)
        counts = counts.withColumn("before", F.col("before") + upto - F.col("size"))
        counts = counts.filter((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("size")))
        wanted = stored(counts.select("group", "which", "rank", "low", "high", "before", "size"), "intervals")
    else:
        raise RuntimeError("intervals did not settle")
    last = stored(reduce(DataFrame.unionByName, done), "intervals")
    flat = last.filter("low = high").select("group", "which", F.col("low").alias("found"))
    keyed = last.filter("low < high").withColumnRenamed("group", "__group")
    inside = rows.join(_small(keyed), F.col("group").eqNullSafe(F.col("__group")))
    inside = inside.filter("value >= low AND value <= high")
    counts = inside.groupBy("group", "which", "rank", "before", "value").agg(F.count(F.lit(1)).alias("size"))
    upto = F.col("before") + F.sum("size").over(Window.partitionBy("group", "which").orderBy("value"))
    counts = counts.withColumn("upto", upto).filter((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("size")))
    return flat.unionByName(counts.select("group", "which", F.col("value").alias("found")))


def medians(df: DataFrame, group: str, value: str) -> DataFrame:
    """group, median: the middle value, or half the sum of the two middle ones."""
    found = _ranked(stored(_valued(df, group, value), "values"))
    middle = F.when(F.min("found") == F.max("found"), F.min("found"))
    return found.groupBy("group").agg(
        middle.otherwise(F.min("found") + (F.max("found") - F.min("found")) * 0.5).alias("median")
    )


def robust_spread(df: DataFrame, group: str, value: str) -> DataFrame:
    """group, median, mad: the median and the median absolute deviation from it."""
    middle = stored(medians(df, group, value), "medians")
    keyed = middle.withColumnRenamed("group", "__group")
    rows = _valued(df, group, value).join(_small(keyed), F.col("group").eqNullSafe(F.col("__group")))
    off = rows.select("group", F.abs(F.col("value") - F.col("median")).alias("off"))
    spread = medians(off, "group", "off").select(F.col("group").alias("__group"), F.col("median").alias("mad"))
    return middle.join(spread, F.col("group").eqNullSafe(F.col("__group"))).select("group", "median", "mad")


def with_outlier(
    flows: DataFrame, group: str, value: str, spread: DataFrame, into: str, times: float = 6.0
) -> DataFrame:
    """Add ``into``: the value is further from its group's median than ``times`` its deviation.

    For ``content_length_anomaly`` and the like.  Unknown groups and nulls are no outliers;
    where the deviation is 0 every other value is one.
    """
    own = spread.select(F.col("group").alias("__group"), "median", "mad")
    own = own.withColumnsRenamed({"median": "__median", "mad": "__mad"})
    joined = flows.drop(into).join(_small(stored(own, "spread")), F.col(group).eqNullSafe(F.col("__group")), "left")
    number = F.col(value).cast("double")
    far = F.abs(number - F.col("__median")) > F.col("__mad") * times
    flag = F.coalesce(far & ~F.isnan(number), F.lit(False))
    return joined.withColumn(into, flag).drop("__group", "__median", "__mad")
