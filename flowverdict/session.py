"""Session settings the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The catalog and the cleaning of a wide table are single projections of many small
# expressions.  HotSpot does not compile methods above 8,000 bytes of bytecode, and Spark
# would put such a projection into one method of whole-stage code.  With this limit it
# generates split projections instead, which run several times faster.
HUGE_METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")


def tune_session(spark: SparkSession) -> SparkSession:
    """Apply the settings unless the user chose a lower limit."""
    name, value = HUGE_METHOD_LIMIT
    if int(spark.conf.get(name)) > int(value):
        spark.conf.set(name, value)
    return spark
