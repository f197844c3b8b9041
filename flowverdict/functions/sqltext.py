"""Literals and names for Spark SQL expressions.

A catalog or a wide flow table needs thousands of small expressions.  They are written as
SQL text and parsed once; building them node by node would cost a call into the JVM each.
"""

from __future__ import annotations

import math


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def double(value: float) -> str:
    if math.isnan(value) or math.isinf(value):
        return f"double('{value}')"
    return f"{float(value)!r}D"


def boolean(value: bool) -> str:
    return "true" if value else "false"


def pinned(expression: str, default: str) -> str:
    """The expression, evaluated where it is written.

    The optimizer moves a filter below the projection it reads from by copying the
    projected expression into the filter, as often as it is named and without looking at
    its size.  It does not do so for an expression that may depend on the partition.
    ``default`` (never returned) gives the type.
    """
    return f"IF(spark_partition_id() < 0, {default}, {expression})"


def array(items: list[str]) -> str:
    return f"array({', '.join(items)})"
