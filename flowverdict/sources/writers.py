"""Result sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from flowverdict.functions.pytext import python_text
from flowverdict.functions.sqltext import name


def _csv_cell(c: str, dtype: T.DataType) -> str:
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.BooleanType)):
        return f"IF({c} IS NULL, NULL, {python_text(c, dtype)}) AS {c}"
    return c


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """A folder of UTF-8 CSV files with a header, quotes doubled inside quoted cells, no
    index column, numbers without Java's exponent form."""
    cells = [_csv_cell(name(f.name), f.dataType) for f in df.schema.fields]
    df.selectExpr(*cells).write.mode(mode).options(
        header=True, quote='"', escape='"', emptyValue="", encoding="UTF-8"
    ).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).parquet(path)
