"""Per-condition and per-comparison counts over a flow table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowverdict.functions.sqltext import array, text
from flowverdict.operators.compare import STRICT, compare_column
from flowverdict.operators.rules import column_types, condition_sql
from flowverdict.sources.catalog import Rule


def _counted(df: DataFrame, tests: list[str]) -> DataFrame:
    """One row (position, flows) per test: how many rows of ``df`` pass it."""
    counts = df.agg(F.expr(array([f"count_if({t})" for t in tests])).alias("counts"))
    return counts.select(F.posexplode("counts").alias("position", "flows"))


def condition_hits(df: DataFrame, rules: list[Rule], mode: str = STRICT) -> DataFrame:
    """rule_idx, condition_idx, flows: how many flows satisfy each single condition."""
    types = column_types(df)
    places, tests = [], []
    for i, rule in enumerate(rules):
        for j, condition in enumerate(rule.conditions):
            places.append((i, j))
            tests.append(condition_sql(types, condition, mode))
    hits = _counted(df, tests)
    where = array([f"struct({i} AS rule_idx, {j} AS condition_idx)" for i, j in places])
    return hits.selectExpr(f"element_at({where}, position + 1) AS at", "flows").select(
        "at.*", "flows"
    )


def comparison_hits(
    df: DataFrame, columns: list[str], operators: list[str], values: list, mode: str = STRICT
) -> DataFrame:
    """column, op, value, flows for every combination of the three lists."""
    types = column_types(df)
    cases = [(c, op, v) for c in columns for op in operators for v in values]
    hits = _counted(df, [compare_column(c, types[c], op, v, mode) for c, op, v in cases])
    named = array(
        [
            f"struct({text(c)} AS `column`, {text(op)} AS op, {text(repr(v))} AS value)"
            for c, op, v in cases
        ]
    )
    return hits.selectExpr(f"element_at({named}, position + 1) AS at", "flows").select(
        "at.*", "flows"
    )
