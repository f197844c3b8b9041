"""The rule comparator, compiled from the column's type.

One comparison mixes two behaviours.  If both sides read as numbers, the operator
applies; otherwise the two sides are compared as text, ignoring case, and the operator
is *not* looked at (so ``!=`` on text means equality).  Which of the two applies is
known from the schema for every column type but text, so most conditions compile to a
single primitive comparison.  ``mode="typed"`` gives rule authors what they expect
instead: ``!=`` on text differs, and an absent column never matches.
"""

from __future__ import annotations

import math
import operator
from typing import Any

from pyspark.sql import types as T

from flowverdict.functions import sqltext as sql

STRICT = "strict"
TYPED = "typed"

OPERATORS = {
    ">": operator.gt,
    ">=": operator.ge,
    "<": operator.lt,
    "<=": operator.le,
    "==": operator.eq,
    "!=": operator.ne,
}

# Text that reads as a number; a cast alone would also take "1.0d" and refuse "1_000".
_DIGITS = "[0-9]+(_[0-9]+)*"
NUMBER_TEXT = (
    f"^[+-]?(({_DIGITS}[.]?({_DIGITS})?|[.]{_DIGITS})([eE][+-]?{_DIGITS})?"
    "|(?i:inf|infinity|nan))$"
)


def as_number(value: Any) -> float | None:
    try:
        return float(value)
    except (TypeError, ValueError):
        return None


def text_to_number(c: str) -> str:
    """SQL for the number a text column reads as, else null."""
    trimmed = f"trim(BOTH ' \\t\\r\\n' FROM {c})"
    return (
        f"IF({trimmed} RLIKE {sql.text(NUMBER_TEXT)}, "
        f"try_cast(replace({trimmed}, '_', '') AS DOUBLE), NULL)"
    )


def compare_values(actual: Any, op: str | None, value: Any, mode: str = STRICT) -> bool:
    """The comparison of two plain values; decides the constant cases at plan time."""
    left, right = as_number(actual), as_number(value)
    if left is None or right is None:
        same = str(actual).upper() == str(value).upper()
        if mode == TYPED:
            return {"==": same, "!=": not same}.get(op, False)
        return same
    return op in OPERATORS and OPERATORS[op](left, right)


def _on_numbers(c: str, op: str | None, right: float, floating: bool) -> str:
    if op not in OPERATORS:
        return "false"
    if math.isnan(right):
        return sql.boolean(op == "!=")
    # 443.0 against a BIGINT column is compared as BIGINT, without a cast per row.
    whole = not floating and right.is_integer() and abs(right) < 2**53
    test = f"{c} {op} {int(right) if whole else sql.double(right)}"
    # Spark orders NaN above every number; Python lets no comparison with it hold.
    return f"(NOT isnan({c}) AND {test})" if floating and op in (">", ">=") else f"({test})"


def _on_text(c: str, op: str | None, value: Any, mode: str) -> str:
    same = f"(upper({c}) = {sql.text(str(value).upper())})"
    if mode == TYPED:
        return {"==": same, "!=": f"(NOT {same})"}.get(op, "false")
    return same


def compare_column(
    column: str, dtype: T.DataType, op: str | None, value: Any, mode: str = STRICT
) -> str:
    """SQL for ``column op value``, a boolean that is never null."""
    c = sql.name(column)
    right = as_number(value)
    if isinstance(dtype, T.BooleanType):
        when_true, when_false = (compare_values(b, op, value, mode) for b in (True, False))
        if when_true == when_false:
            test = f"IF({c} IS NULL, NULL, {sql.boolean(when_true)})"
        else:
            test = c if when_true else f"(NOT {c})"
    elif isinstance(dtype, T.NumericType):
        if right is None:
            # No number prints as a text that does not read as a number.
            test = f"IF({c} IS NULL, NULL, {sql.boolean(mode == TYPED and op == '!=')})"
        else:
            floating = isinstance(dtype, (T.DoubleType, T.FloatType))
            test = _on_numbers(c, op, right, floating)
            if c not in test:
                test = f"IF({c} IS NULL, NULL, {test})"
    else:
        c = c if isinstance(dtype, T.StringType) else f"CAST({c} AS STRING)"
        test = _on_text(c, op, value, mode)
        if right is not None:
            number = text_to_number(c)
            test = f"IF({number} IS NULL, {test}, {_on_numbers(number, op, right, True)})"
        if mode == TYPED:
            test = f"IF({c} IS NULL, NULL, {test})"
    return f"coalesce({test}, {sql.boolean(compare_values(None, op, value, mode))})"
