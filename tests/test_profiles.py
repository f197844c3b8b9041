import math
import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from flowverdict.operators import profiles as pr
from flowverdict.operators.fusion import FusionSettings, fuse
from flowverdict.plans import reports

SCHEMA = "g string, v double, group string, value int"


def values(seed):
    rng = random.Random(seed)
    rows = [("hot", rng.lognormvariate(0, 4)) for _ in range(900)]
    rows += [("same", 2.5)] * 60 + [("zero", 0.0)] * 5 + [("zero", -1.0)] * 4 + [("one", 7.0), ("two", 1.0), ("two", 4.0)]
    rows += [(None, 3.0), (None, 5.0), ("none", None), ("none", math.nan), ("hot", None), ("hot", math.nan)]
    rows += [("far", x) for x in (-1e308, -5.0, 0.0, 1e-300, 1e308)] + [("mixed", rng.uniform(-5, 5)) for _ in range(200)]
    return rows


def held(rows):
    out = {}
    for g, v in rows:
        if v is not None and not math.isnan(v):
            out.setdefault(g, []).append(v)
    return out


def frame(spark, rows):
    return spark.createDataFrame([(g, v, "x", 1) for g, v in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("ranked, parts", [(100_000, 1024), (3, 4)])
def test_medians_by_levels(spark, monkeypatch, ranked, parts):
    """Few parts and rows make many levels; the result is that of sorting."""
    monkeypatch.setattr(pr, "RANKED", ranked)
    monkeypatch.setattr(pr, "PARTS", parts)
    rows = values(1)
    got = {r.group: (r.median, r.mad) for r in pr.robust_spread(frame(spark, rows), "g", "v").collect()}
    for g, own in held(rows).items():
        middle = median(own)
        assert got[g][0] == pytest.approx(middle, rel=1e-12)
        assert got[g][1] == pytest.approx(median([abs(v - middle) for v in own]), rel=1e-9)
    assert set(got) == set(held(rows))


def test_outliers(spark):
    rows = values(2) + [("same", 2.6), ("strange", 1.0)]
    df = frame(spark, rows)
    spread = pr.robust_spread(df.filter("g != 'strange'"), "g", "v")
    found = pr.with_outlier(df, "g", "v", spread, "content_length_anomaly").collect()
    assert len(found) == len(rows) and found[0].asDict().keys() == {"g", "v", "group", "value", "content_length_anomaly"}
    by = {(r.g, r.v): r.content_length_anomaly for r in found}
    assert by["same", 2.6] and not by["same", 2.5] and not by["strange", 1.0] and not by["none", None]


@pytest.mark.parametrize("share", [0.0, 0.5, 0.99, 1.0])
def test_sketch_is_within_its_bound(spark, share):
    rows = values(3)
    df = frame(spark, rows)
    parts = [pr.quantile_sketch(df.filter(F.pmod(F.hash("v"), F.lit(3)) == i), "g", "v") for i in range(3)]
    found = pr.sketch_quantiles(pr.merge_sketches(*parts), share)
    got = {r.group: (r.n, r.at) for r in found.withColumn("at", pr.bucket_value(F.col("bucket"))).collect()}
    for g, own in held(rows).items():
        exact = sorted(own)[max(1, math.ceil(share * len(own))) - 1]
        assert got[g][0] == len(own)
        assert got[g][1] == pytest.approx(max(exact, 0.0), rel=pr.ACCURACY + 1e-9)
    whole = pr.quantile_sketch(df, "g", "v")
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, pr.merge_sketches(*parts).collect()), key=str)


def test_abnormal_responses_fall_back(spark):
    rows = [("busy", float(i)) for i in range(1, 101)] + [("rare", 3.0), ("rare", 5000.0), ("busy", None), (None, 2.0)]
    df = frame(spark, rows)
    sketch = pr.quantile_sketch(df, "g", "v")
    found = pr.with_response_abnormal(df, "g", "v", sketch, share=0.9)
    by = {(r.g, r.v): r.response_time_abnormal for r in found.collect()}
    assert by["busy", 100.0] and not by["busy", 89.0] and not by["busy", None]
    assert by["rare", 5000.0] and not by["rare", 3.0] and not by[None, 2.0]
    empty = pr.with_response_abnormal(df, "g", "v", sketch.filter("false"))
    assert not any(r.response_time_abnormal for r in empty.collect())


def test_sweep_is_what_scoring_anew_gives(spark):
    rng = random.Random(6)
    rows = []
    for _ in range(300):
        hit = rng.random() < 0.6
        rows.append((
            hit, rng.choice(["LOW", "MEDIUM", "HIGH", "CRITICAL"]) if hit else "NONE",
            rng.choice([0.6, 0.88, 0.97]) if hit else 0.0, round(rng.random(), 4), rng.random() < 0.5,
            rng.choice(["BENIGN", "DDoS", None]),
        ))
    df = spark.createDataFrame(rows, "any_match boolean, highest_severity string, max_confidence double, anomaly_score double, is_anomaly boolean, label string")
    settings = {f"s{w}": FusionSettings.from_rule_weight(w / 4, alert_at=0.1 * w, block_at=0.3 + 0.15 * w) for w in range(5)}
    swept = {r.setting: r for r in reports.settings_sweep(reports.settings_cube(df), settings).collect()}
    for name, own in settings.items():
        scored = fuse(df, own)
        raised = reports.detection_counts(scored).first()
        actions = {r.action: r["count"] for r in scored.groupBy("action").count().collect()}
        row = swept[name]
        assert (row.blocked, row.alerted, row.allowed) == tuple(actions.get(a, 0) for a in ("BLOCK", "ALERT", "ALLOW"))
        assert (row.true_positives, row.false_positives) == (raised.true_positives, raised.false_positives)
        flagged = raised.true_positives + raised.false_positives
        assert row.precision == (raised.true_positives / flagged if flagged else None)
