"""Flow CSV files, typed over whole columns, and single flows."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POSITION = "flow_position"

# Cell texts that count as missing.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# Cell texts that count as booleans.
TRUE_TEXTS = ["True", "TRUE", "true"]
FALSE_TEXTS = ["False", "FALSE", "false"]

WHOLE_TEXT = r"^\s*[+-]?\d+\s*$"
DECIMAL_TEXT = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"


def unique_headers(headers: list[str]) -> list[str]:
    """Empty headers get a name, repeated ones a counting suffix (``.1``, ``.2``)."""
    names: list[str] = []
    for i, header in enumerate(headers):
        base = header or f"Unnamed: {i}"
        name, n = base, 0
        while name in names:
            n += 1
            name = f"{base}.{n}"
        names.append(name)
    return names


def _header_groups(
    reader, spark: SparkSession, path: str | list[str]
) -> list[tuple[list[str], list[str]]]:
    """The distinct headers and the files that have them."""
    files = spark.read.text(path).inputFiles()
    if len(files) <= 1:
        header = reader(header=False).csv(path).first()
        if header is None:
            raise ValueError(f"no header in {path}")
        return [([h or "" for h in header], path if isinstance(path, list) else [path])]
    # One pass over the lines; the driver gets the first line of each file.
    place = F.struct("_metadata.file_block_start", F.monotonically_increasing_id())
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), place.alias("place")
    )
    found: dict[str, list[str]] = {}
    for row in lines.groupBy("file").agg(F.min_by("value", "place").alias("line")).collect():
        found.setdefault(row.line, []).append(unquote(row.file))
    groups = []
    for members in sorted(found.values(), key=min):
        header = reader(header=False).csv(members[0]).first()
        groups.append(([h or "" for h in header], sorted(members)))
    if not groups:
        raise ValueError(f"no header in {path}")
    return groups


def _text_frame(
    spark: SparkSession, path: str | list[str], position: bool, multi_line: bool
) -> tuple[DataFrame, list[str]]:
    def reader(**more):
        return spark.read.options(
            quote='"', escape='"', encoding="UTF-8", multiLine=multi_line, **more
        )

    groups = [(unique_headers(h), files) for h, files in _header_groups(reader, spark, path)]
    names = list(dict.fromkeys(n for own, _ in groups for n in own))
    # Names Spark may carry through any expression; the real ones come back at the end.
    number = {n: f"c{i}" for i, n in enumerate(names)}
    whole = None
    for own, files in groups:
        fields = [T.StructField(number[n], T.StringType()) for n in own]
        # One field more than the header has, to notice cells beyond it.
        surplus = T.StructField("surplus", T.StringType())
        df = reader(header=True, enforceSchema=True).schema(T.StructType([*fields, surplus]))
        df = df.csv(files)
        beyond = F.raise_error(F.lit(f"a row has more cells than the header of {files[0]}"))
        df = df.filter(
            F.when(F.col("surplus").isNull(), True).otherwise(beyond.cast("boolean"))
        )
        columns = [
            F.col(c) if n in own else F.lit(None).cast("string").alias(c)
            for n, c in number.items()
        ]
        if position:
            where = F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("row"),
            )
            columns.append(where.alias(POSITION))
        df = df.select(*columns)
        whole = df if whole is None else whole.unionByName(df)
    return whole, names


def _present(name: str) -> Column:
    c = F.col(name)
    return F.when(~c.isin(MISSING_TEXTS), c)


def infer_types(df: DataFrame, columns: list[str]) -> list[T.DataType]:
    """One aggregate over the whole table decides each column: whole numbers without gaps
    are long, numbers double, booleans boolean, the rest text."""
    tests = []
    for name in columns:
        c = _present(name)
        whole = c.rlike(WHOLE_TEXT) & c.try_cast("long").isNotNull()
        tests.append(
            F.struct(
                F.count(c).alias("present"),
                F.count(F.lit(1)).alias("rows"),
                F.bool_and(whole).alias("whole"),
                F.bool_and(c.rlike(DECIMAL_TEXT)).alias("decimal"),
                F.bool_and(c.isin(TRUE_TEXTS + FALSE_TEXTS)).alias("boolean"),
            ).alias(name)
        )
    found = df.agg(*tests).first()

    def decide(t) -> T.DataType:
        if t.present == 0:
            return T.DoubleType()
        if t.whole and t.present == t.rows:
            return T.LongType()
        if t.decimal:
            return T.DoubleType()
        return T.BooleanType() if t.boolean else T.StringType()

    return [decide(found[name]) for name in columns]


def _typed(name: str, dtype: T.DataType) -> Column:
    c = _present(name)
    if isinstance(dtype, T.BooleanType):
        return F.when(c.isin(TRUE_TEXTS), True).when(c.isin(FALSE_TEXTS), False)
    return c if isinstance(dtype, T.StringType) else c.cast(dtype)


def read_flow_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    position: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Flow records from CSV with a header row in each file.

    Files may order their columns differently or lack some: columns are taken by name, and
    what a file lacks is missing.  A row with more cells than its header is an error.  Quoted
    line breaks need ``multi_line``; without it each line is a record.
    Without ``schema`` the types come from one extra pass over the data; large inputs
    should give one (fields by header name, others are read as text).  ``position`` adds
    ``flow_position``, a column to order by in file order.
    """
    df, names = _text_frame(spark, path, position, multi_line)
    raw = [f"c{i}" for i in range(len(names))]
    if schema is None:
        types = infer_types(df, raw)
    else:
        known = {f.name.strip(): f.dataType for f in schema.fields}
        types = [known.get(n.strip(), T.StringType()) for n in names]
    columns = [_typed(r, t).alias(n) for r, t, n in zip(raw, types, names)]
    return df.select(*columns, *([POSITION] if position else []))


def single_flow(spark: SparkSession, flow: dict) -> DataFrame:
    """One flow given as a dictionary; goes through the plan with ``cleaned=False``."""
    kinds = {bool: T.BooleanType(), int: T.LongType(), float: T.DoubleType()}
    fields = [T.StructField(k, kinds.get(type(v), T.StringType())) for k, v in flow.items()]
    values = tuple(
        v if v is None or type(v) in kinds else str(v) for v in flow.values()
    )
    return spark.createDataFrame([values], T.StructType(fields))
