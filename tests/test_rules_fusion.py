from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowverdict import FusionSettings, default_catalog, evaluate_rules, score_flows
from flowverdict.functions.pytext import python_text
from flowverdict.functions.rounding import round_exact
from flowverdict.operators.compare import TYPED
from flowverdict.operators.fusion import fuse
from flowverdict.operators.rules import exploded_matches, rule_results
from flowverdict.operators.rules_relational import matches_by_division
from flowverdict.sources.catalog import (
    Condition,
    Rule,
    catalog_frame,
    catalog_from_frame,
    load_catalog,
    rules_from_dicts,
)
from checks.event_flows import core_flows, flows_from_events, read_events
from pyspark.sql import types as T


def test_catalog_facts():
    rules = default_catalog()
    assert len(rules) == 61
    assert sum(len(r.conditions) for r in rules) == 153
    assert len({r.category for r in rules}) == 7
    assert len({c.field for r in rules for c in r.conditions}) == 54


def test_catalog_defaults_and_checks(tmp_path):
    (only,) = rules_from_dicts([{}])
    assert (only.rule_id, only.name, only.severity_or_low, only.confidence) == (
        "unknown", "Unnamed Rule", "LOW", 0.8)
    assert (only.category_or_general, only.category_or_misc) == ("General", "Misc")
    with pytest.raises(ValueError, match="severity"):
        rules_from_dicts([{"severity": "SEVERE"}])
    path = tmp_path / "rules.json"
    path.write_text('{"rules": [{"id": "A", "conditions": [{"field": "x", "op": ">", "value": 1}]}]}')
    assert load_catalog(path)[0].conditions == (Condition("x", ">", 1),)
    path.write_text("{}")
    assert load_catalog(path) == []


def test_catalog_from_yaml(tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "rules.yaml"
    path.write_text("rules:\n- id: A\n  conditions:\n  - {field: x, op: '==', value: true}\n")
    assert load_catalog(path)[0].conditions == (Condition("x", "==", True),)


def test_catalog_table_round_trip(spark):
    rules = default_catalog() + [Rule("N", conditions=(Condition("x", "==", None), Condition("y", "<", 2.5)))]
    assert catalog_from_frame(catalog_frame(spark, rules)) == rules


@pytest.mark.parametrize("sf, full, core", [
    ("0.001", (979, 4828), (898, 2254)),
    ("0.01", (9791, 49859), (9053, 23916)),
])
def test_hit_counts(spark, sf, full, core):
    events = read_events(spark, f"/root/testdata/sf{sf}")
    for flows, want in ((flows_from_events(events), full), (core_flows(events), core)):
        evaluated = evaluate_rules(flows, default_catalog())
        got = evaluated.agg(F.count_if("any_match"), F.sum(F.size("matched"))).first()
        assert tuple(got) == want
    if sf == "0.01":
        fired = exploded_matches(evaluate_rules(flows_from_events(events), default_catalog()))
        assert fired.select("rule_idx").distinct().count() == 61


def test_edge_rules(spark):
    """Empty condition lists match, absent columns count as 0, odd names stay intact."""
    rules = [
        Rule("A", "it's \\ odd"),
        Rule("B", conditions=(Condition("absent", "==", 0),)),
        Rule("C", conditions=(Condition("absent", "==", "0"),)),
        Rule("D", conditions=(Condition("absent", "==", ""),)),
        Rule("E", "E", severity="CRITICAL", confidence=0.1, conditions=(Condition("a b`c", ">", 1),)),
    ]
    df = spark.createDataFrame([(1, 0), (2, 5)], "k int, `a b``c` int")
    rows = evaluate_rules(df, rules).orderBy("k").collect()
    assert [r.matched for r in rows] == [[0, 1, 2], [0, 1, 2, 4]]
    assert [r.highest_severity for r in rows] == ["LOW", "CRITICAL"]
    assert [r.max_confidence for r in rows] == [0.8, 0.8]
    assert rows[0].rule_names[0] == "it's \\ odd"
    divided = matches_by_division(df, rules, ["k"]).collect()
    assert sorted((r.k, r.rule_idx) for r in divided) == [
        (1, 0), (1, 1), (1, 2), (2, 0), (2, 1), (2, 2), (2, 4)]


def test_empty_catalog(spark, flows):
    row = evaluate_rules(flows, []).first()
    assert (row.any_match, row.highest_severity, row.max_confidence, row.matched) == (False, "NONE", 0.0, [])


def test_many_rules_use_several_words(spark):
    rules = [Rule(str(i), str(i), severity="HIGH" if i == 150 else "LOW", confidence=0.5 + i / 1000,
                  conditions=(Condition("x", ">=", i),)) for i in range(200)]
    df = spark.createDataFrame([(i,) for i in (-1, 0, 61, 62, 123, 124, 150, 199)], "x int")
    for r in evaluate_rules(df, rules).collect():
        assert r.matched == list(range(r.x + 1))
        assert r.highest_severity == ("NONE" if r.x < 0 else "HIGH" if r.x >= 150 else "LOW")
        assert r.max_confidence == (0.0 if r.x < 0 else 0.5 + r.x / 1000)


def test_two_plans_agree(spark, flows):
    rules = default_catalog()
    compiled = exploded_matches(evaluate_rules(flows, rules), ["event_id"])
    divided = matches_by_division(flows, rules, ["event_id"])
    assert compiled.exceptAll(divided).count() == 0 and divided.exceptAll(compiled).count() == 0


def test_rules_as_data_keep_repeated_rows(spark, flows):
    rules = default_catalog()
    twice = flows.limit(50).union(flows.limit(50))
    compiled = exploded_matches(evaluate_rules(twice, rules), ["event_id"])
    divided = matches_by_division(twice, rules, ["event_id"])
    assert compiled.exceptAll(divided).count() == 0 and divided.exceptAll(compiled).count() == 0
    assert divided.count() == 2 * divided.distinct().count()


def test_large_catalogs_give_the_same_results(spark, flows, monkeypatch):
    few = evaluate_rules(flows, default_catalog())
    scored = score_flows(flows, key=["event_id"])
    monkeypatch.setattr("flowverdict.operators.rules.COMPILED_RULES", 10)
    monkeypatch.setattr("flowverdict.plans.pipeline.COMPILED_RULES", 10)
    names = ["event_id", "any_match", "highest_severity", "max_confidence", "matched", "rule_names"]
    many = evaluate_rules(flows, default_catalog())
    assert many.select(names).exceptAll(few.select(names)).count() == 0
    assert score_flows(flows, key=["event_id"]).select(scored.columns).exceptAll(scored).count() == 0
    with pytest.raises(ValueError):
        evaluate_rules(flows, default_catalog(), TYPED)


def test_details(spark):
    rules = [Rule(conditions=(Condition("d", ">", 5), Condition("b", "==", True), Condition("s", "==", "x"),
                              Condition("gone", "==", 0)))]
    df = spark.createDataFrame([(2e7, True, "X"), (6.5, True, "x"), (1.0, True, "x")], "d double, b boolean, s string")
    got = rule_results(df, rules, ["d"], details=True).orderBy("d").collect()
    assert [r.details for r in got] == [
        "",
        "d > 5 (actual: 6.5); b == True (actual: True); s == x (actual: x); gone == 0 (actual: 0)",
        "d > 5 (actual: 20000000.0); b == True (actual: True); s == x (actual: X); gone == 0 (actual: 0)",
    ]
    assert [r.confidence for r in got] == [0.0, 0.8, 0.8]
    assert got[0].category == "General"


def test_only_needed_columns_are_read(spark):
    events = read_events(spark, "/root/testdata/sf0.001")
    rules = [r for r in default_catalog() if r.rule_id == "NET-003"]
    plan = evaluate_rules(events.withColumn("duration", F.col("value")), rules).select("any_match")
    scan = [line for line in plan._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    assert "ReadSchema: struct<value:double>" in scan[0]


NUMBERS = st.one_of(
    st.floats(0, 1.2),
    st.integers(0, 12000).map(lambda i: i / 10000 + 0.00005),
    st.integers(0, 2**14).map(lambda i: i / 2**14),
    st.floats(-100, 100),
)


@given(st.lists(NUMBERS, min_size=50, max_size=400))
@settings(max_examples=5, deadline=None)
def test_round_exact(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (1, 2, 3, 4):
        rows = df.selectExpr("v", f"{round_exact('v', digits)} AS r").collect()
        for row in rows:
            assert row.r == round(row.v, digits), row.v


def test_python_text(spark):
    values = [0.0, -0.0, 1.0, 400.0, 2e7, 1e15, 1e16, 1.5e300, 1e-4, 1e-5, -2.5e-7, 0.1, 123456.789,
              float("nan"), float("inf"), float("-inf"), 1 / 3]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    rows = df.selectExpr("i", f"{python_text('v', T.DoubleType())} AS t").orderBy("i").collect()
    assert [r.t for r in rows] == [str(v) for v in values]


@given(st.lists(st.tuples(st.integers(0, 100), st.integers(0, 10000), st.booleans()), min_size=20, max_size=200))
@settings(max_examples=5, deadline=None)
def test_fusion_against_exact_arithmetic(spark, cases):
    """Within one unit of the decimal result; always in range, boosted only on agreement."""
    rows = [(i, c > 0, "HIGH" if c else "NONE", c / 100, m / 10000, a) for i, (c, m, a) in enumerate(cases)]
    df = spark.createDataFrame(
        rows, "i int, any_match boolean, highest_severity string, max_confidence double, "
              "anomaly_score double, is_anomaly boolean")
    for r in fuse(df).collect():
        rule = Decimal("0.75") * Decimal(str(r.max_confidence))
        risk = Decimal("0.55") * rule + Decimal("0.45") * Decimal(str(r.anomaly_score))
        if r.any_match and r.is_anomaly:
            risk += min(Decimal("0.15"), (1 - risk) * Decimal("0.3"))
        assert abs(Decimal(str(r.risk_score)) - risk) < Decimal("0.00012")
        assert 0.0 <= r.risk_score <= 1.0
        assert r.action == ("BLOCK" if r.risk_score >= 0.7 else "ALERT" if r.risk_score >= 0.35 else "ALLOW")
        # The same steps in Python doubles give the same bits.
        weighted = min(round(0.55 * (0.75 * r.max_confidence if r.any_match else 0.0) + 0.45 * r.anomaly_score, 4), 1.0)
        if r.any_match and r.is_anomaly:
            weighted = round(weighted + min(0.15, (1.0 - weighted) * 0.3), 4)
        assert r.risk_score == weighted


def test_action_bounds_are_inclusive(spark):
    df = spark.createDataFrame(
        [(s, False, "NONE", 0.0, s, False) for s in (0.35, 0.3499, 0.7, 0.6999)],
        "i double, any_match boolean, highest_severity string, max_confidence double, "
        "anomaly_score double, is_anomaly boolean")
    only_model = FusionSettings.from_rule_weight(0.0)
    assert {r.i: r.action for r in fuse(df, only_model).collect()} == {
        0.35: "ALERT", 0.3499: "ALLOW", 0.7: "BLOCK", 0.6999: "ALERT"}


def test_weights_are_checked():
    with pytest.raises(ValueError):
        FusionSettings(0.5, 0.6)
    assert FusionSettings.from_rule_weight(0.3).ml_weight == 0.7


def test_rules_alone_never_block(flows):
    scored = score_flows(flows, key=["event_id"])
    assert scored.filter("action = 'BLOCK'").count() == 0
    assert scored.agg(F.max("risk_score")).first()[0] <= 0.5335
