"""Raw flow table -> clean, typed flow table."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowverdict.functions import sqltext as sql
from flowverdict.schema import FEATURES, HEADER_NAMES


def rename_headers(df: DataFrame) -> DataFrame:
    """Trim each header and map the known ones; the others pass through."""
    names = [HEADER_NAMES.get(c.strip(), c.strip()) for c in df.columns]
    twice = sorted(n for n, count in Counter(names).items() if count > 1)
    if twice:
        raise ValueError(f"columns named twice after renaming: {', '.join(twice)}")
    return df if names == df.columns else df.toDF(*names)


def _cleaned(c: str, dtype: T.DataType) -> str:
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        # NaN sorts above infinity, so one comparison drops both.
        kept = f"IF(abs({c}) < double('inf'), {c}, NULL)"
        return f"coalesce({kept}, CAST(0 AS {dtype.simpleString()}))"
    if isinstance(dtype, T.NumericType):
        return f"coalesce({c}, CAST(0 AS {dtype.simpleString()}))"
    if isinstance(dtype, T.BooleanType):
        return f"coalesce({c}, false)"
    if isinstance(dtype, T.StringType):
        return f"coalesce({c}, '0')"
    return c


def clean(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Infinities, NaN and nulls become 0 in every column (text ``"0"``) but ``keep``."""
    columns = []
    for f in df.schema.fields:
        c = sql.name(f.name)
        columns.append(c if f.name in keep else f"{_cleaned(c, f.dataType)} AS {c}")
    return df.selectExpr(*columns)


def missing_features(df: DataFrame) -> list[str]:
    return [f for f in FEATURES if f not in df.columns]


def fill_missing(df: DataFrame) -> DataFrame:
    """Features the input lacks become 0."""
    absent = missing_features(df)
    return df.selectExpr("*", *[f"0 AS {f}" for f in absent]) if absent else df


def ingest(df: DataFrame, cleaned: bool = True, keep: list[str] = ()) -> DataFrame:
    """Rename, clean and fill.  A single flow given as a dictionary is not cleaned."""
    df = rename_headers(df)
    if cleaned:
        df = clean(df, keep)
    return fill_missing(df)


def label_column(df: DataFrame) -> str | None:
    """The first column called "label", whatever its case and padding."""
    return next((c for c in df.columns if c.strip().lower() == "label"), None)


def is_benign(df: DataFrame) -> Column:
    """True for benign flows, never null; true everywhere when the flows carry no label."""
    name = label_column(df)
    if name is None:
        return F.lit(True)
    return F.coalesce(F.upper(F.col(f"`{name}`")).contains("BENIGN"), F.lit(False))


def benign_only(df: DataFrame) -> DataFrame:
    return df.filter(is_benign(df))
