"""Counts, shares, frequencies and the risk histogram.

All of them derive from one small profile: the number of flows per action and risk score.
A risk score has four decimals, so the profile has at most a few ten thousand rows
whatever the number of flows, and the flows are scored once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowverdict.functions.rounding import round_exact
from flowverdict.operators.fusion import FusionSettings, fuse_each
from flowverdict.operators.ingest import is_benign

BINS = 10


def risk_profile(scored: DataFrame) -> DataFrame:
    return scored.groupBy("action", "risk_score").agg(F.count(F.lit(1)).alias("flows"))


def action_totals(profile: DataFrame) -> DataFrame:
    """One row: total, blocks, alerts, allows and their shares as text (null if empty)."""

    def flows(action: str):
        return F.coalesce(F.sum(F.when(F.col("action") == action, F.col("flows"))), F.lit(0))

    totals = profile.agg(
        F.coalesce(F.sum("flows"), F.lit(0)).alias("total"),
        flows("BLOCK").alias("blocks"),
        flows("ALERT").alias("alerts"),
        flows("ALLOW").alias("allows"),
    )
    shares = []
    for name in ("block", "alert", "allow"):
        shares.append(f"try_divide(CAST({name}s AS DOUBLE), total) * 100D AS __{name}")
        shown = f"format_string('%.1f%%', {round_exact(f'__{name}', 1)})"
        shares.append(f"IF(total > 0, {shown}, NULL) AS {name}_share")
    return totals.selectExpr("*", *shares).drop("__block", "__alert", "__allow")


def action_frequency(profile: DataFrame) -> DataFrame:
    """Flows per action, most frequent first."""
    counts = profile.groupBy("action").agg(F.sum("flows").alias("flows"))
    return counts.orderBy(F.desc("flows"), "action")


def risk_histogram(profile: DataFrame, bins: int = BINS) -> DataFrame:
    """Equal-width bins over the observed range, closed on the right, the first one also
    on the left; empty bins are kept.  A constant score widens the range by 0.1%."""
    scores = profile.groupBy("risk_score").agg(F.sum("flows").alias("flows"))
    # A risk score has four decimals, so one row holds them all: some ten thousand cells.
    whole = scores.agg(
        F.min("risk_score").alias("lo"),
        F.max("risk_score").alias("hi"),
        F.collect_list(F.struct("risk_score", "flows")).alias("cells"),
    ).filter("lo IS NOT NULL")
    margin = F.when(
        F.col("lo") == F.col("hi"),
        F.when(F.col("lo") == 0, 0.001).otherwise(F.abs("lo") * 0.001),
    ).otherwise(0.0)
    whole = whole.select(
        (F.col("lo") - margin).alias("lo"), (F.col("hi") + margin).alias("hi"), "cells"
    ).withColumn("step", (F.col("hi") - F.col("lo")) / bins)
    edges = F.transform(
        F.sequence(F.lit(0), F.lit(bins)),
        lambda i: F.when(i == bins, F.col("hi")).otherwise(i * F.col("step") + F.col("lo")),
    )
    every = whole.withColumn("edges", edges).select(
        F.posexplode(F.slice("edges", 1, bins)).alias("at", "lower"), "edges", "cells"
    ).withColumn("upper", F.element_at("edges", F.col("at") + 2))

    def inside(cell):
        above = (cell["risk_score"] > F.col("lower")) | (F.col("at") == 0)
        return above & (cell["risk_score"] <= F.col("upper"))

    flows = F.aggregate(
        F.filter("cells", inside), F.lit(0).cast("long"), lambda n, cell: n + cell["flows"]
    )
    return every.select(
        (F.col("at") + 1).alias("bin"), "lower", "upper", flows.alias("flows")
    ).orderBy("bin")


def label_actions(scored: DataFrame) -> DataFrame:
    """Flows per label and action."""
    return scored.groupBy("label", "action").agg(F.count(F.lit(1)).alias("flows"))


def detection_counts(scored: DataFrame) -> DataFrame:
    """One row: benign and other flows, split by whether an alert or block was raised."""
    raised, benign = F.col("action") != "ALLOW", is_benign(scored)
    return scored.agg(
        F.count_if(~benign & raised).alias("true_positives"),
        F.count_if(benign & raised).alias("false_positives"),
        F.count_if(~benign & ~raised).alias("false_negatives"),
        F.count_if(benign & ~raised).alias("true_negatives"),
    )


CUBE = ["any_match", "highest_severity", "max_confidence", "anomaly_score", "is_anomaly"]


def settings_cube(scored: DataFrame) -> DataFrame:
    """Flows by all that fusion reads, and by label: one pass, combined map-side.

    Rules and scores of four decimals bound the cells (some ten thousand in practice).
    """
    return scored.groupBy(*CUBE, is_benign(scored).alias("benign")).agg(
        F.count(F.lit(1)).alias("flows")
    )


def settings_sweep(cube: DataFrame, settings: dict[str, FusionSettings]) -> DataFrame:
    """One row for each of the settings: flows by action, and precision and recall of raising.

    Exact, as each cell gets the action that its flows would get; flows are not scored again.
    """
    fused = fuse_each(cube, settings)
    flows, raised = F.col("flows"), F.col("action") != "ALLOW"

    def total(where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, flows)), F.lit(0))

    counts = fused.groupBy("setting").agg(
        total(F.col("action") == "BLOCK").alias("blocked"),
        total(F.col("action") == "ALERT").alias("alerted"),
        total(F.col("action") == "ALLOW").alias("allowed"),
        total(raised & ~F.col("benign")).alias("true_positives"),
        total(raised & F.col("benign")).alias("false_positives"),
        total(~raised & ~F.col("benign")).alias("false_negatives"),
    )
    hits = F.col("true_positives").cast("double")
    return counts.withColumns(
        {
            "precision": F.try_divide(hits, F.col("true_positives") + F.col("false_positives")),
            "recall": F.try_divide(hits, F.col("true_positives") + F.col("false_negatives")),
        }
    )


def row_counts(flows: DataFrame, rules: list, analysed: int | None = None) -> DataFrame:
    """One row: total, benign and analysed flows, and the number of rules."""
    total = F.count(F.lit(1))
    capped = total if analysed is None else F.least(total, F.lit(analysed))
    return flows.agg(
        total.alias("total_flows"),
        F.count_if(is_benign(flows)).alias("benign_flows"),
        capped.alias("analysed_flows"),
        F.lit(len(rules)).alias("rules_loaded"),
    )
