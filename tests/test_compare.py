"""The comparator against a literal truth table."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowverdict.operators.compare import TYPED, compare_column, compare_values

# kind, actual, value, and the operators for which the comparison holds.
NUMBERS = [
    ("long", 0, 0, ">= <= =="), ("long", 0, 5, "< <= !="), ("long", 5, 0, "> >= !="),
    ("long", -3, -2.5, "< <= !="), ("long", 5, "5", ">= <= =="), ("long", 5, True, "> >= !="),
    ("long", 0, False, ">= <= =="), ("long", 5, "nan", "!="), ("long", 5, "inf", "< <= !="),
    ("double", 5.0, 5, ">= <= =="), ("double", -2.5, -2.5, ">= <= =="), ("double", 1e20, 1e20, ">= <= =="),
    ("double", math.nan, 5, "!="), ("double", math.nan, "nan", "!="), ("double", math.inf, "inf", ">= <= =="),
    ("double", math.inf, 1e20, "> >= !="), ("double", -math.inf, 0, "< <= !="),
    ("boolean", True, 0, "> >= !="), ("boolean", True, True, ">= <= =="), ("boolean", False, "5", "< <= !="),
    ("string", "5", 5, ">= <= =="), ("string", " 5 ", "5", ">= <= =="), ("string", "1_0", 5, "> >= !="),
    ("string", "1e2", 5, "> >= !="), ("string", ".5", 5, "< <= !="), ("string", "5.", 5, ">= <= =="),
    ("string", "inf", 1e20, "> >= !="), ("string", "-Infinity", 0, "< <= !="), ("string", "NaN", 5, "!="),
]
# Where one side is no number, texts are compared without case and the operator is ignored.
TEXTS = [
    ("long", 5, "", False), ("long", 5, "GET", False), ("long", None, "None", True), ("long", None, 0, False),
    ("long", 0, None, False), ("long", None, None, True), ("double", None, "none", True), ("double", 5.0, "true", False),
    ("boolean", True, "true", True), ("boolean", False, "false", True), ("boolean", None, False, False), ("boolean", True, "", False),
    ("string", "", "", True), ("string", "GET", "get", True), ("string", "Get", "GET", True), ("string", "abc", "GET", False),
    ("string", "true", True, True), ("string", "TRUE", "true", True), ("string", "False", False, True), ("string", "true", 5, False),
    ("string", "1__0", 5, False), ("string", "1.0d", 5, False), ("string", "0x1p3", 5, False), ("string", ".", 0, False),
    ("string", "None", None, True), ("string", None, None, True), ("string", None, "", False), ("string", "5", "", False),
]
OPS = [">", ">=", "<", "<=", "==", "!=", "~", None]
TYPES = {"long": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "string": T.StringType()}
TABLE = [(k, a, op, v, op in holds.split()) for k, a, v, holds in NUMBERS for op in OPS]
TABLE += [(k, a, op, v, same) for k, a, v, same in TEXTS for op in OPS]


@pytest.mark.parametrize("kind", list(TYPES))
def test_columns(spark, kind):
    rows = [r for r in TABLE if r[0] == kind]
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("a", TYPES[kind])])
    df = spark.createDataFrame([(i, r[1]) for i, r in enumerate(rows)], schema)
    tests = F.array(*[F.expr(compare_column("a", TYPES[kind], op, v)) for _, _, op, v, _ in rows])
    for row in df.select("i", F.element_at(tests, F.col("i") + 1).alias("holds")).collect():
        assert row.holds is rows[row.i][4], rows[row.i]


def test_plain_values():
    for row in TABLE:
        assert compare_values(*row[1:4]) == row[4], row


def test_typed_mode(spark):
    df = spark.createDataFrame([("GET",), ("",), ("7",)], "m string")
    test = {
        op: F.expr(compare_column("m", T.StringType(), op, "", TYPED)).alias(op)
        for op in ("==", "!=", ">")
    }
    rows = df.select(*test.values()).collect()
    assert [tuple(r) for r in rows] == [(False, True, False), (True, False, False), (False, True, False)]
