"""Shapes of the physical plans."""

from pyspark.sql import functions as F

from flowverdict import score_flows
from flowverdict.operators.forest import draw_samples, grow_forest
from flowverdict.operators.features import with_vector
from flowverdict.plans.reports import risk_profile


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scoring_does_not_shuffle(flows, trained):
    for options in ({}, {"model": trained.model, "stats": "frozen"}):
        assert "Exchange" not in plan_of(score_flows(flows, key=["event_id"], **options))


def test_batch_statistics_are_one_subquery(flows, trained):
    plan = plan_of(score_flows(flows, key=["event_id"], model=trained.model))
    assert plan.count("Exchange SinglePartition") == 1
    assert plan.count("FileScan") == 2
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_rules_only_query_skips_the_model(flows, trained):
    scored = score_flows(flows, key=["event_id"], model=trained.model)
    plan = plan_of(scored.select("event_id", "any_match", "highest_severity"))
    assert "EvalPython" not in plan and "Subquery" not in plan


def test_rules_run_before_the_model(flows, trained):
    """Past the rules a flow is a few words wide; raw columns do not travel to Python."""
    scored = score_flows(flows, key=["event_id"], model=trained.model, stats="frozen")
    lines = plan_of(scored.select("event_id", "action", "risk_score")).splitlines()
    walk = next(i for i, line in enumerate(lines) if "ArrowEvalPython" in line)
    assert "__rules0" in lines[walk + 1] and "http_method" not in lines[walk].split("walk(")[0]


def test_filters_on_results_do_not_copy_the_model(flows, trained):
    scored = score_flows(flows, key=["event_id"], model=trained.model, stats="frozen")
    for condition in ("action = 'BLOCK'", "risk_score > 0.9", "rule_score > 0.5", "ml_score > 0.9",
                      "any_match AND highest_severity = 'HIGH'", "anomaly_score > 0.9"):
        plan = plan_of(scored.filter(condition))
        assert plan.count("ArrowEvalPython") == 1
        assert len(plan) < 300_000


def test_profile_scores_once(flows, trained):
    plan = plan_of(risk_profile(score_flows(flows, key=["event_id"], model=trained.model, stats="frozen")))
    assert plan.count("FileScan") == 1


def test_filter_gives_the_right_rows(flows):
    scored = score_flows(flows, key=["event_id"])
    assert scored.filter("action = 'ALERT'").count() == 857
    assert scored.filter("highest_severity = 'NONE'").count() == 21
    assert scored.agg(F.count_if("any_match")).first()[0] == 979


def test_samples_are_cut_before_the_shuffle(flows, trained):
    """Each map task sends at most one sample per tree, however many rows share a key."""
    samples = draw_samples(flows, ["event_id"], 1000, 20, 64, 42)
    plan = plan_of(samples)
    final, exchange, partial = (plan.index(s) for s in ("64, Final", "Exchange hashpartitioning(tree_id", "64, Partial"))
    assert final < exchange < partial
    assert "size(" not in plan.split("Generate explode")[1].split("FileScan")[0]
    plan = plan_of(grow_forest(with_vector(samples, trained.model.stats), 20, 42, 6))
    # A second, tiny shuffle keeps the trees in tasks of their own.
    assert plan.count("Exchange hashpartitioning") == 2
    assert "REPARTITION_BY_NUM" in plan


def test_matches_are_evaluated_once(flows):
    """No size filter appears below the generator that lists the matches."""
    from flowverdict import default_catalog, evaluate_rules
    from flowverdict.operators.rules import exploded_matches

    plan = plan_of(exploded_matches(evaluate_rules(flows, default_catalog()), ["event_id"]))
    assert plan.count("__rules0") > 0
    assert "- Filter" not in plan.split("Generate")[1]


def test_where_reaches_the_scan(spark, flows, trained, tmp_path):
    days = flows.withColumn("day", F.col("event_id") % 5)
    days.write.partitionBy("day").parquet(str(tmp_path / "flows"))
    table = spark.read.parquet(str(tmp_path / "flows"))
    for options in ({}, {"model": trained.model, "stats": "frozen"}, {"model": trained.model}):
        scored = score_flows(table, key=["event_id", "day"], where="day = 3 AND dst_port = 22", **options)
        plan = plan_of(scored)
        scans = [line for line in plan.splitlines() if "PartitionFilters" in line]
        assert scans and all("(day#" in s.split("PartitionFilters")[1] for s in scans)
        assert all("EqualTo(dst_port,22)" in s for s in scans)
        want = flows.filter("event_id % 5 = 3 AND dst_port = 22").count()
        assert scored.count() == want > 0


def test_rules_as_data_do_not_shuffle(flows):
    from flowverdict import default_catalog
    from flowverdict.operators.rules_relational import matches_by_division

    plan = plan_of(matches_by_division(flows, default_catalog(), ["event_id"]))
    main = plan.split("Subquery")[0]
    assert "Exchange" not in main and "Join" not in plan


def test_histogram_scores_once(flows, trained):
    from flowverdict.plans.reports import risk_histogram

    scored = score_flows(flows, key=["event_id"], model=trained.model, stats="frozen")
    plan = plan_of(risk_histogram(risk_profile(scored)))
    assert "Window" not in plan
