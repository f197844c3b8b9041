"""Result tables of the two front ends, and rule listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowverdict.functions.rounding import round_exact
from flowverdict.functions.sqltext import array, text
from flowverdict.operators.fusion import with_reasoning
from flowverdict.operators.rules import exploded_matches
from flowverdict.sources.catalog import Rule


def report_rows(scored: DataFrame, index: str = "flow_idx") -> DataFrame:
    """The command-line result: one row per flow, twelve columns."""
    return with_reasoning(scored).selectExpr(
        f"CAST({index} AS BIGINT) AS flow_idx",
        "src_ip",
        "dst_ip",
        "src_port",
        "dst_port",
        "label",
        "action",
        "risk_score",
        "any_match AS rule_matched",
        "array_join(rule_names, ', ') AS matched_rules",
        "anomaly_score AS ml_score",
        "reasoning",
    )


def table_rows(scored: DataFrame, key: list[str] = ()) -> DataFrame:
    """The table of the analysis page: nine columns with display names."""
    return with_reasoning(scored).selectExpr(
        *key,
        "action AS Action",
        "risk_score AS `Risk Score`",
        "IF(any_match, 'Yes', 'No') AS `Rule Hit`",
        "IF(any_match, array_join(rule_names, ', '), 'None') AS `Matched Rules`",
        "highest_severity AS `Rule Severity`",
        f"{round_exact('anomaly_score', 3)} AS `ML Score`",
        "dst_port AS `Dst Port`",
        "label AS Label",
        "reasoning AS Reasoning",
    )


def table_view(rows: DataFrame) -> DataFrame:
    return rows.drop("Reasoning")


def match_listing(evaluated: DataFrame, rules: list[Rule], key: list[str]) -> DataFrame:
    """One line of text per match: id, name, severity, confidence."""
    lines = [
        f"[{r.rule_id}] {r.name} | Severity: {r.severity_or_low} | Confidence: {r.confidence}"
        for r in rules
    ]
    listing = f"element_at({array([text(line) for line in lines])}, rule_idx + 1) AS listing"
    return exploded_matches(evaluated, key).selectExpr(*key, "rule_idx", listing)


def rule_listing(catalog: DataFrame) -> DataFrame:
    """The catalog as shown to a reader, one row per condition."""
    listed = filter_catalog(catalog)
    shown = F.concat_ws("  ", "c.field", "c.op", "c.value")
    return listed.select(
        "rule_idx",
        "rule_id",
        "rule_name",
        "category",
        "severity",
        "confidence",
        F.posexplode_outer("conditions").alias("condition_idx", "c"),
    ).select(
        "rule_idx", "rule_id", "rule_name", "category", "severity", "confidence",
        "condition_idx", shown.alias("condition"),
    )


def filter_catalog(
    catalog: DataFrame,
    categories: list[str] | None = None,
    severities: list[str] | None = None,
) -> DataFrame:
    """Rules of the chosen categories and severities; None chooses all."""
    catalog = catalog.withColumns(
        {
            "category": F.coalesce("category", F.lit("Misc")),
            "severity": F.coalesce("severity", F.lit("LOW")),
        }
    )
    if categories is not None:
        catalog = catalog.filter(F.col("category").isin(categories))
    if severities is not None:
        catalog = catalog.filter(F.col("severity").isin(severities))
    return catalog


def catalog_categories(catalog: DataFrame) -> DataFrame:
    return filter_catalog(catalog).select("category").distinct()


def rule_hits(evaluated: DataFrame, catalog: DataFrame) -> DataFrame:
    """The catalog with the number of flows each rule matched, zero included.

    The count is combined within each map task, so a rule that matches a third of all
    flows costs no more than any other.
    """
    hits = (
        exploded_matches(evaluated)
        .groupBy("rule_idx")
        .agg(F.count(F.lit(1)).alias("flows"))
    )
    return catalog.join(hits, "rule_idx", "left").withColumn(
        "flows", F.coalesce("flows", F.lit(0))
    )


def group_hits(hits: DataFrame) -> DataFrame:
    """``rule_hits`` summed up by category and severity: rules, rules_hit, hits."""
    return filter_catalog(hits).groupBy("category", "severity").agg(
        F.count(F.lit(1)).alias("rules"),
        F.count_if(F.col("flows") > 0).alias("rules_hit"),
        F.sum("flows").alias("hits"),
    )
