"""Columns printed the way Python's ``str`` prints the same value."""

from __future__ import annotations

from pyspark.sql import types as T


def _double_text(c: str) -> str:
    c = f"CAST({c} AS DOUBLE)"
    shown = f"CAST({c} AS STRING)"
    digits = f"CAST(CAST({c} AS DECIMAL(38,21)) AS STRING)"
    plain = f"regexp_replace(regexp_replace({digits}, '0+$', ''), '[.]$', '.0')"
    mantissa = f"regexp_replace(substring_index({shown}, 'E', 1), '[.]0$', '')"
    exponent = f"try_cast(substring_index({shown}, 'E', -1) AS INT)"
    power = f"CAST(abs({exponent}) AS STRING)"
    power = f"IF(length({power}) < 2, concat('0', {power}), {power})"
    return (
        f"CASE WHEN isnan({c}) THEN 'nan' WHEN {c} = double('inf') THEN 'inf' "
        f"WHEN {c} = double('-inf') THEN '-inf' WHEN {c} = 0D THEN {shown} "
        f"WHEN abs({c}) >= 1.0e-4D AND abs({c}) < 1.0e16D THEN {plain} "
        f"ELSE concat({mantissa}, IF({exponent} < 0, 'e-', 'e+'), {power}) END"
    )


def python_text(c: str, dtype: T.DataType) -> str:
    """SQL that prints the column ``c`` of type ``dtype``."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        shown = _double_text(c)
    elif isinstance(dtype, T.BooleanType):
        shown = f"IF({c}, 'True', 'False')"
    else:
        shown = f"CAST({c} AS STRING)"
    return f"IF({c} IS NULL, 'None', {shown})"
