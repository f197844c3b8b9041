"""The rules as data: a second plan for the same answer.

The catalog is a constant array, the fields of a flow are read into another, and a rule
matches when all its conditions hold, tested inside the row.  The plan's size does not
depend on the catalog, nothing is shuffled and rows need no key, so this serves catalogs
too large to compile.  The compiled projection in ``rules`` is faster and stays the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowverdict.functions import sqltext as sql
from flowverdict.functions.pytext import python_text
from flowverdict.operators.compare import as_number, text_to_number
from flowverdict.sources.catalog import Rule

def _condition(number: int, op: str, value: float | None, shown: str) -> str:
    value_sql = "CAST(NULL AS DOUBLE)" if value is None else sql.double(value)
    return f"struct({number} AS field, {sql.text(op)} AS op, {value_sql} AS value, {sql.text(shown)} AS value_text)"


def constant_rules(rules: list[Rule], fields: list[str]) -> Column:
    """The catalog as one array, which the optimizer folds into a literal."""
    number = {f: i for i, f in enumerate(fields)}
    none = f"slice({sql.array([_condition(0, '', None, '')])}, 1, 0)"
    rows = []
    for i, r in enumerate(rules):
        own = [
            _condition(number[str(c.field)], str(c.op), as_number(c.value), str(c.value).upper())
            for c in r.conditions
        ]
        rows.append(f"struct({i} AS rule_idx, {sql.array(own) if own else none} AS conditions)")
    empty = f"slice(array(struct(0 AS rule_idx, {none} AS conditions)), 1, 0)"
    return F.expr(sql.array(rows) if rows else empty)


def field_reading(name: str, types: dict[str, T.DataType]) -> tuple[str, str]:
    """A field as number (null if it does not read as one) and as upper-case text."""
    if name not in types:
        number, shown = "0D", "'0'"
    else:
        c, dtype = sql.name(name), types[name]
        shown = f"upper({python_text(c, dtype)})"
        if isinstance(dtype, (T.NumericType, T.BooleanType)):
            number = f"CAST({c} AS DOUBLE)"
        else:
            number = text_to_number(f"CAST({c} AS STRING)")
    return number, shown


def _reading(name: str, types: dict[str, T.DataType]) -> str:
    number, shown = field_reading(name, types)
    return f"struct({number} AS actual, {shown} AS actual_text)"


def _passed(reading: Column, condition: Column) -> Column:
    a, v, op = reading["actual"], condition["value"], condition["op"]
    by_number = (
        F.when(F.isnan(a) | F.isnan(v), op == "!=")
        .when(op == ">", a > v)
        .when(op == ">=", a >= v)
        .when(op == "<", a < v)
        .when(op == "<=", a <= v)
        .when(op == "==", a == v)
        .when(op == "!=", a != v)
        .otherwise(F.lit(False))
    )
    numeric = a.isNotNull() & v.isNotNull()
    same = reading["actual_text"] == condition["value_text"]
    return F.coalesce(F.when(numeric, by_number).otherwise(same), F.lit(False))


def matched_by_data(df: DataFrame, rules: list[Rule]) -> Column:
    """The indices of the matched rules in catalog order."""
    types = {f.name: f.dataType for f in df.schema.fields}
    fields = sorted({str(c.field) for r in rules for c in r.conditions})
    catalog = constant_rules(rules, fields)
    readings = F.expr(sql.array([_reading(f, types) for f in fields or [""]]))

    # Bound to a variable, so the fields are read once for all conditions.
    def matched(read: Column) -> Column:
        held = F.filter(
            catalog,
            lambda r: F.forall(r["conditions"], lambda c: _passed(F.get(read, c["field"]), c)),
        )
        return F.transform(held, lambda r: r["rule_idx"])

    return F.transform(F.array(readings), matched)[0]


def matches_by_division(df: DataFrame, rules: list[Rule], key: list[str]) -> DataFrame:
    """(key, rule_idx) of each match, once for every row."""
    long = df.select(*key, F.explode_outer(matched_by_data(df, rules)).alias("rule_idx"))
    return long.filter(F.col("rule_idx").isNotNull())
