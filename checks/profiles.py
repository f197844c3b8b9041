"""Queries of numeric profiles and of the settings sweep, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import oracle as o
from checks.registry import full, register
from flowverdict.operators import profiles as pr
from flowverdict.operators.fusion import FusionSettings
from flowverdict.operators.rules import evaluate_rules
from flowverdict.plans import reports
from checks import event_flows as ef
from flowverdict.sources.catalog import default_catalog

# Flows go to the user; one user in three has few flows of its own.
_DEST = "CASE WHEN event_id % 5 < 2 THEN 7 WHEN event_id % 97 = 0 THEN event_id ELSE user_id END"
_GAMMA = f"ln(CAST({(1 + pr.ACCURACY) / (1 - pr.ACCURACY)!r} AS DOUBLE))"
_BUCKET = f"CASE WHEN value > 0 THEN ceil(ln(value) / {_GAMMA})::INTEGER ELSE {pr.LOWEST} END"


def destinations(spark, sf_dir):
    return ef.read_events(spark, sf_dir).selectExpr("event_id", f"{_DEST} AS destination", "value")


@register(
    "response_quantiles",
    f"""WITH ranked AS (
      SELECT {_DEST} AS destination, value, {_BUCKET} AS bucket,
             row_number() OVER (PARTITION BY {_DEST} ORDER BY value) AS place,
             count(*) OVER (PARTITION BY {_DEST}) AS n FROM events)
    SELECT destination, n, bucket, true AS within FROM ranked
    WHERE place = greatest(1, ceil(n * CAST(0.95 AS DOUBLE)))""",
)
def response_quantiles(spark, sf_dir):
    """The 0.95 quantile of each destination by a sketch merged from two halves; SQL ranks exactly."""
    rows = destinations(spark, sf_dir)
    halves = [pr.quantile_sketch(rows.filter(F.col("event_id") % 2 == i), "destination", "value") for i in (0, 1)]
    found = pr.sketch_quantiles(pr.merge_sketches(*halves), 0.95)
    keyed = found.withColumnRenamed("group", "destination")
    # The value that stands for the bucket lies within the bound of each value in it.
    held = rows.withColumn("own", pr.bucket_of(F.col("value"))).join(keyed, "destination").filter("own = bucket")
    off = F.abs(pr.bucket_value(F.col("bucket")) - F.col("value")) <= F.col("value") * (pr.ACCURACY + 1e-9)
    return held.groupBy("destination", "n", "bucket").agg(F.every(off | (F.col("bucket") == pr.LOWEST)).alias("within"))


@register(
    "response_abnormal",
    f"""WITH ranked AS (
      SELECT event_id, {_DEST} AS destination, value, {_BUCKET} AS bucket FROM events
    ), placed AS (
      SELECT *, row_number() OVER (PARTITION BY destination ORDER BY value) AS place,
             count(*) OVER (PARTITION BY destination) AS n,
             row_number() OVER (ORDER BY value) AS overall_place, count(*) OVER () AS total FROM ranked
    ), own AS (SELECT destination, bucket AS bar FROM placed
               WHERE n >= {pr.LEAST_ROWS} AND place = greatest(1, ceil(n * CAST(0.99 AS DOUBLE)))
    ), overall AS (SELECT bucket AS bar FROM placed
                   WHERE overall_place = greatest(1, ceil(total * CAST(0.99 AS DOUBLE))))
    SELECT event_id, bucket > coalesce(own.bar, overall.bar) AS response_time_abnormal
    FROM ranked LEFT JOIN own USING (destination), overall""",
)
def response_abnormal(spark, sf_dir):
    rows = destinations(spark, sf_dir)
    sketch = pr.quantile_sketch(rows, "destination", "value")
    found = pr.with_response_abnormal(rows, "destination", "value", sketch)
    return found.select("event_id", "response_time_abnormal")


@register(
    "size_outliers",
    f"""WITH sized AS (SELECT event_id, {_DEST} AS destination, value FROM events),
    spread AS (SELECT destination, median(value) AS median, mad(value) AS mad FROM sized GROUP BY destination)
    SELECT event_id, abs(value - median) > mad * 6 AS content_length_anomaly
    FROM sized JOIN spread USING (destination)""",
)
def size_outliers(spark, sf_dir):
    rows = destinations(spark, sf_dir)
    spread = pr.robust_spread(rows, "destination", "value")
    found = pr.with_outlier(rows, "destination", "value", spread, "content_length_anomaly")
    return found.select("event_id", "content_length_anomaly")


@register(
    "size_spread",
    f"""SELECT {_DEST} AS destination, round(median(value), 9) AS median, round(mad(value), 9) AS mad
    FROM events GROUP BY 1""",
)
def size_spread(spark, sf_dir):
    spread = pr.robust_spread(destinations(spark, sf_dir), "destination", "value")
    return spread.select(
        F.col("group").alias("destination"), F.round("median", 9).alias("median"), F.round("mad", 9).alias("mad")
    )


# 20 weights and 20 pairs of thresholds: (name, rule weight, alert, block).
_SWEEP = [
    (f"w{w:02d}a{a}b{b}", w / 20, 0.1 + 0.2 * a, 0.25 + 0.25 * b)
    for w in range(1, 21) for a in range(5) for b in range(4)
]


@register(
    "settings_sweep",
    f"""{o.rules_prefix()}, {o.SUMMARY}, {o.SYNTHETIC},
    settings(setting, w, m, a, b) AS (VALUES {", ".join(
        f"('{n}', {o.real(w)}, {o.real(1.0 - w)}, {o.real(a)}, {o.real(b)})" for n, w, a, b in _SWEEP)}),
    crossed AS (SELECT scored.*, settings.* FROM scored, settings),
    {o.fused("crossed", "w", "m", "a", "b", "swept")},
    counted AS (
      SELECT setting, count(*) FILTER (WHERE action = 'BLOCK') AS blocked,
             count(*) FILTER (WHERE action = 'ALERT') AS alerted,
             count(*) FILTER (WHERE action = 'ALLOW') AS allowed,
             count(*) FILTER (WHERE action != 'ALLOW' AND upper(label) NOT LIKE '%BENIGN%') AS true_positives,
             count(*) FILTER (WHERE action != 'ALLOW' AND upper(label) LIKE '%BENIGN%') AS false_positives,
             count(*) FILTER (WHERE action = 'ALLOW' AND upper(label) NOT LIKE '%BENIGN%') AS false_negatives
      FROM swept GROUP BY setting)
    SELECT *, CASE WHEN true_positives + false_positives > 0
                   THEN true_positives / (true_positives + false_positives) END AS precision,
           CASE WHEN true_positives + false_negatives > 0
                THEN true_positives / (true_positives + false_negatives) END AS recall
    FROM counted""",
)
def settings_sweep(spark, sf_dir):
    """400 settings from one pass over the flows."""
    settings = {n: FusionSettings.from_rule_weight(w, alert_at=a, block_at=b) for n, w, a, b in _SWEEP}
    evaluated = evaluate_rules(full(spark, sf_dir), default_catalog())
    cube = reports.settings_cube(ef.with_synthetic_scores(evaluated))
    return reports.settings_sweep(cube, settings)
