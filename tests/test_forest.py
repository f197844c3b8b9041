import numpy as np
import pytest
from pyspark.sql import functions as F

from flowverdict import default_catalog, evaluate_rules, score_flows, score_forest, train_forest, train_model
from flowverdict.functions.draws import uniform
from flowverdict.operators import forest_kernels as kernels
from flowverdict.operators.features import with_vector
from flowverdict.operators.forest import draw_samples, scale_score
from flowverdict.sources.model_store import load_model, save_model
from flowverdict.sources.scratch import scratch_folder


def test_node_table(trained):
    model = trained.model
    assert (trained.total_rows, trained.benign_rows, trained.missing) == (1000, 334, [])
    assert (model.trees, model.sample_rows) == (100, 256)
    for _, tree in model.nodes.groupby("tree_id"):
        tree = tree.set_index("node_id")
        assert tree.loc[1].n_rows == 256
        assert tree.depth.max() <= 8
        leaves = tree[tree.feature < 0]
        assert leaves.n_rows.sum() == 256
        for node, row in tree[tree.feature >= 0].iterrows():
            assert tree.loc[2 * node].n_rows + tree.loc[2 * node + 1].n_rows == row.n_rows
            assert tree.loc[2 * node].n_rows > 0 and tree.loc[2 * node + 1].n_rows > 0


@pytest.mark.parametrize("partitions", [1, 17])
def test_trees_do_not_depend_on_partitioning(flows, trained, partitions):
    again = train_model(flows.repartition(partitions), ["event_id"]).model
    assert again.nodes.equals(trained.model.nodes)


def test_seed_changes_trees(flows, trained):
    assert not train_model(flows, ["event_id"], seed=7).model.nodes.equals(trained.model.nodes)


def test_without_key(flows):
    model = train_model(flows, trees=5, sample_rows=32).model
    assert (model.nodes[model.nodes.node_id == 1].n_rows == 32).all()
    assert model.nodes.depth.max() <= 5


def test_samples_are_exact_and_distinct(spark):
    df = spark.range(20000)
    got = draw_samples(df, ["id"], 20000, 30, 64, 1).toPandas()
    assert (got.groupby("tree_id").id.nunique() == 64).all()
    assert got.tree_id.nunique() == 30
    # Every third of the input is drawn from about equally.
    assert np.allclose(np.histogram(got.id, 3)[0] / len(got), 1 / 3, atol=0.06)
    # Independent samples share few rows.
    assert got.id.nunique() > 0.9 * len(got)


def test_samples_with_one_hot_key(spark):
    """A third of the rows carry one key; each tree still gets its exact sample."""
    df = spark.range(30000).select(F.when(F.col("id") < 10000, 1).otherwise(F.col("id")).alias("k"), "id")
    got = draw_samples(df, ["k"], 30000, 20, 64, 1, overdraw=8.0).toPandas()
    assert (got.groupby("tree_id").size() == 64).all()


def test_small_input_trains_on_every_row(spark):
    df = spark.createDataFrame([(i, float(i), 6.0) for i in range(20)], "id int, duration double, protocol_type double")
    model = train_model(df, ["id"], trees=10).model
    assert model.sample_rows == 20
    assert (model.nodes[model.nodes.node_id == 1].n_rows == 20).all()


def test_draws_agree_with_kernels(spark):
    rows = spark.range(50).select("id", uniform(42, "word", F.lit(3), F.col("id")).alias("u")).collect()
    assert all(r.u == kernels.uniform(42, "word", 3, r.id) for r in rows)
    assert 0.3 < np.mean([r.u for r in rows]) < 0.7


def test_mean_path():
    assert kernels.mean_path(1) == 0 and kernels.mean_path(2) == 1
    assert kernels.mean_path(256) == pytest.approx(10.2448, abs=1e-3)


def test_walk_agrees_with_plain_recursion(trained, flows):
    model = trained.model
    tables = {t: g.set_index("node_id") for t, g in model.nodes.groupby("tree_id")}
    scored = score_flows(flows, model=model, stats="frozen", key=["event_id"])
    scores = {r.event_id: r.raw_score for r in scored.select("event_id", "raw_score").collect()}
    sample = with_vector(flows, model.stats).filter("event_id < 5").collect()
    for row in sample:
        total = 0.0
        for tree in tables.values():
            node = 1
            while tree.loc[node].feature >= 0:
                n = tree.loc[node]
                node = 2 * node + int(row.features[int(n.feature)] > n.threshold)
            total += tree.loc[node].depth + float(kernels.mean_path(tree.loc[node].n_rows))
        want = -(2.0 ** -(total / model.trees / float(kernels.mean_path(256))))
        assert scores[row.event_id] == pytest.approx(want, abs=1e-12)


def test_far_point_scores_above_the_bulk(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(0, 1, (1000, 2)))] + [(9999, 40.0, -40.0)]
    df = spark.createDataFrame(rows, "id int, duration double, byte_count double")
    model = train_model(df, ["id"]).model
    scored = score_flows(df, rules=[], model=model, key=["id"]).select("id", "raw_score").toPandas()
    far = scored[scored.id == 9999].raw_score.iloc[0]
    assert far < scored[scored.id != 9999].raw_score.min()


def test_every_flow_is_anomalous_at_the_default_threshold(flows, trained):
    """With 256-row trees the longest path still scales above 0.56."""
    low, high, flagged = (
        score_flows(flows, model=trained.model, key=["event_id"])
        .agg(F.min("anomaly_score"), F.max("anomaly_score"), F.count_if("is_anomaly")).first()
    )
    assert low >= 0.5604 and high <= 1.0 and flagged == 1000


def test_scaling(spark):
    df = spark.createDataFrame([(-0.5,), (-0.4,), (-0.6,), (-0.9,), (0.1,), (0.5,)], "raw_score double")
    got = {r.raw_score: (r.anomaly_score, r.is_anomaly) for r in scale_score(df, 0.55).collect()}
    assert got == {-0.5: (0.8571, True), -0.4: (0.7143, True), -0.6: (1.0, True), -0.9: (1.0, True),
                   0.1: (0.0, False), 0.5: (0.0, False)}


def test_contamination_is_recorded_only(flows, trained):
    other = train_model(flows, ["event_id"], contamination=0.2).model
    assert other.contamination == 0.2 and other.nodes.equals(trained.model.nodes)


def test_save_and_load(spark, flows, trained):
    folder = scratch_folder(spark, "test-model")
    with pytest.raises(FileNotFoundError):
        load_model(spark, folder)
    small = train_model(flows, ["event_id"], trees=3).model
    save_model(spark, small, folder)
    save_model(spark, trained.model, folder)
    loaded = load_model(spark, folder)
    assert loaded.nodes.equals(trained.model.nodes)
    assert loaded.stats == trained.model.stats
    assert (loaded.trees, loaded.seed, loaded.threshold) == (100, 42, 0.55)


def test_no_model(flows):
    with pytest.raises(RuntimeError, match="no trained model"):
        score_forest(flows, None)
    with pytest.raises(RuntimeError, match="no trained model"):
        score_flows(flows, require_model=True)
    row = score_flows(flows).agg(F.max("anomaly_score"), F.count_if("is_anomaly")).first()
    assert tuple(row) == (0.0, 0)


def test_training_input_is_checked(spark, flows):
    with pytest.raises(ValueError, match="no rows"):
        train_model(flows.filter("label <> 'BENIGN'"), ["event_id"])
    with pytest.raises(ValueError, match="trees"):
        train_model(flows, ["event_id"], trees=0)
    with pytest.raises(ValueError, match="found"):
        train_forest(spark.range(3), ["id"], lambda s: s.withColumn("features", F.array(F.lit(1.0))), 50)


def test_rules_are_independent_of_the_model(flows, trained):
    with_model = score_flows(flows, model=trained.model, key=["event_id"]).select("event_id", "matched")
    without = evaluate_rules(flows, default_catalog()).select("event_id", "matched")
    assert with_model.exceptAll(without).count() == 0


@pytest.mark.parametrize(
    "key", ["event_id % 50", "CAST(NULL AS BIGINT)", "IF(event_id % 5 < 3, -1, event_id)"]
)
def test_a_key_that_repeats_is_an_error(flows, key):
    """50 values, null throughout, and one value for 60 % of the flows."""
    with pytest.raises(Exception, match="does not identify flows"):
        train_model(flows.withColumn("k", F.expr(key)), ["k"])


def test_null_parts_of_a_key_count(spark):
    rows = [(i if i % 2 else None, None if i % 2 else i) for i in range(400)]
    df = spark.createDataFrame([(*r, 0.5 * n) for n, r in enumerate(rows)], "a int, b int, duration double")
    model = train_model(df, ["a", "b"], trees=5, sample_rows=64).model
    assert (model.nodes[model.nodes.node_id == 1].n_rows == 64).all()


def test_rows_are_included_at_equal_rates(spark):
    """Each row is in a tree's sample with probability 64 / 2000, independently by tree."""
    got = draw_samples(spark.range(2000), ["id"], 2000, 200, 64, 3).toPandas()
    counts = np.bincount(got.id, minlength=2000)
    mean, spread = 200 * 64 / 2000, 200 * (64 / 2000) * (1 - 64 / 2000)
    assert counts.mean() == mean
    assert 0.85 * spread < counts.var() < 1.15 * spread
    assert counts.max() < mean + 6 * spread**0.5


def test_isolation_depths_have_the_expected_moments(spark):
    """The mean depth over uniform points is near that of an unsuccessful search."""
    df = spark.range(4000).select("id", *[F.rand(i).alias(c) for i, c in enumerate(("duration", "pkt_count", "byte_count"))])
    model = train_model(df, ["id"], trees=60).model
    leaves = model.nodes[model.nodes.feature < 0]
    depth = (leaves.depth + leaves.n_rows.map(lambda n: float(kernels.mean_path(n)))) * leaves.n_rows
    assert depth.sum() / leaves.n_rows.sum() == pytest.approx(float(kernels.mean_path(256)), rel=0.1)
