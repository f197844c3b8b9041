import re
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowverdict.operators.cap import dense_index, number_rows, row_cap
from flowverdict.operators.features import (
    feature_columns,
    identity_columns,
    minmax_frame,
    stats_from_row,
    with_vector,
)
from flowverdict.operators.ingest import (
    benign_only,
    clean,
    fill_missing,
    ingest,
    label_column,
    missing_features,
    rename_headers,
)
from flowverdict.schema import FEATURES


def test_headers(spark):
    df = spark.createDataFrame([(1, 2, 3)], "` Flow Duration` int, `Flow Bytes/s ` int, odd int")
    assert rename_headers(df).columns == ["duration", "flow_bytes_per_sec", "odd"]


def test_headers_may_not_collide(spark):
    df = spark.createDataFrame([(1, 2)], "`Label` int, ` Label ` int")
    with pytest.raises(ValueError, match="label"):
        rename_headers(df)


def test_clean(spark):
    rows = [(math.nan, 1, "x", True), (math.inf, None, None, None), (-math.inf, 2, "", False),
            (None, 3, "0", True), (1.5, -4, "y", False)]
    df = clean(spark.createDataFrame(rows, "d double, i long, s string, b boolean"))
    assert [tuple(r) for r in df.collect()] == [
        (0.0, 1, "x", True), (0.0, 0, "0", False), (0.0, 2, "", False), (0.0, 3, "0", True),
        (1.5, -4, "y", False)]


def test_fill_missing(spark):
    df = fill_missing(spark.createDataFrame([(7,)], "duration int"))
    assert set(FEATURES) <= set(df.columns)
    assert df.first().duration == 7 and df.first().idle_mean == 0
    assert missing_features(df) == []


def test_label_and_benign(spark):
    df = spark.createDataFrame([("benign",), ("DDoS",), (None,), ("x-BENIGN-y",)], "` LABEL ` string")
    assert label_column(df) == " LABEL "
    assert benign_only(df).count() == 2
    assert benign_only(df.toDF("other")).count() == 4


def test_identity(spark):
    df = spark.createDataFrame([(80.9, 6.0, None)], "dst_port double, protocol_type double, label string")
    df = ingest(df)
    row = df.selectExpr(*[f"{e} AS {n}" for n, e in identity_columns(df).items()]).first()
    assert row.asDict() == {"label": "0", "src_ip": "", "dst_ip": "", "src_port": 0,
                            "dst_port": 80, "protocol": "6.0"}
    bare = spark.createDataFrame([(1,)], "x int")
    row = bare.selectExpr(*[f"{e} AS {n}" for n, e in identity_columns(bare).items()]).first()
    assert row.label == "UNKNOWN" and row.protocol == ""


def test_vector_against_numpy(spark):
    rng = np.random.default_rng(3)
    data = pd.DataFrame({f: rng.normal(0, 50, 40) for f in FEATURES})
    data["protocol_type"] = rng.choice([6.0, 17.0, 1.0, 2.0], 40)
    data["idle_mean"] = 4.0
    df = spark.createDataFrame(data)
    got = np.array([r.features for r in with_vector(df, minmax_frame(df)).collect()], dtype=np.float32)
    want = ((data - data.min()) / (data.max() - data.min()).replace(0, 1)).clip(0, 1)
    want["protocol_type"] = data.protocol_type.where(data.protocol_type.isin([6, 17, 1]), 0)
    assert np.array_equal(np.sort(got, axis=0), np.sort(want.to_numpy(dtype=np.float32), axis=0))


def test_frozen_statistics_clip(spark):
    df = fill_missing(spark.createDataFrame([(-5.0,), (5.0,), (50.0,)], "duration double"))
    rows = with_vector(df, {"duration": (0.0, 10.0)}).collect()
    assert [r.features[0] for r in rows] == [0.0, 0.5, 1.0]
    # A feature nobody fitted is clipped as it is.
    rows = with_vector(df, {}).collect()
    assert [r.features[0] for r in rows] == [0.0, 1.0, 1.0]


def test_refit_keeps_absent_features():
    earlier = {"duration": (0.0, 1.0), "dst_port": (1.0, 2.0)}
    assert stats_from_row({"duration_min": 5.0, "duration_max": 6.0}, earlier) == {
        "duration": (5.0, 6.0), "dst_port": (1.0, 2.0)}


def test_text_feature_is_an_error(spark):
    df = fill_missing(spark.createDataFrame([("12",), ("TCP",)], "protocol_type string"))
    values = df.select(F.expr(feature_columns(df, {})["protocol_type"]))
    assert values.limit(1).collect()[0][0] == 0.0
    with pytest.raises(Exception, match="protocol_type is not a number: TCP"):
        values.collect()


def test_row_cap(spark):
    df = spark.range(50).repartition(4)
    assert [r.id for r in row_cap(df, 3, ["id"]).orderBy("id").collect()] == [0, 1, 2]
    assert row_cap(df, 100, ["id"]).count() == 50
    assert row_cap(df, 0, ["id"]).count() == 0
    assert row_cap(df, None, ["id"]).count() == 50
    numbered = number_rows(row_cap(df, 5, ["id"]), ["id"]).collect()
    assert sorted((r.flow_idx, r.id) for r in numbered) == [(i, i) for i in range(5)]


def test_row_cap_is_the_same_filter_for_every_size(spark):
    """No sort, no shuffle of the rows and no limit: a filter on the key of the last row."""
    df = spark.range(600_000).withColumn("x", F.col("id") % 7).repartition(7)
    plans = set()
    for n in (3, 321, 300_000):
        capped = row_cap(df, n, ["id"])
        assert capped.agg(F.count("*"), F.max("id")).first() == (n, n - 1)
        plan = capped._jdf.queryExecution().optimizedPlan().toString()
        assert "Limit" not in plan and "Sort" not in plan
        plans.add(re.sub(r"<= \d+", "<= LAST", re.sub(r"#\d+L?", "", plan)))
    assert len(plans) == 1


def test_row_cap_refuses_a_tie_at_the_cut(spark):
    """With a repeated order key there is no first ``n``; ties elsewhere do no harm."""
    df = spark.createDataFrame([(k,) for k in (1, 1, 2, 3, 3, None)], "k int").repartition(3)
    assert sorted(r.k or 0 for r in row_cap(df, 3, ["k"]).collect()) == [0, 1, 1]
    assert row_cap(df, 4, ["k"]).count() == 4
    assert row_cap(df, 6, ["k"]).count() == 6
    for n in (2, 5):
        with pytest.raises(ValueError, match="repeated"):
            row_cap(df, n, ["k"])


def test_row_cap_by_several_columns_with_nulls(spark):
    rows = [(None, 2), (None, 1), (1, None), (1, 5), (2, 0), (0, 9)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(3)
    in_order = sorted(rows, key=lambda r: [(v is not None, v or 0) for v in r])
    for n in range(1, 8):
        got = [tuple(r) for r in row_cap(df, n, ["a", "b"]).collect()]
        assert sorted(map(str, got)) == sorted(map(str, in_order[:n]))
    assert row_cap(df.select("a").limit(1), 1, ["a"]).count() == 1


def test_dense_index_with_one_hot_value(spark):
    """A third of the rows share the first sort column."""
    df = spark.range(3000).select(F.when(F.col("id") < 1000, 7).otherwise(F.col("id")).alias("k"), "id")
    got = dense_index(df.repartition(5), ["k", "id"]).orderBy("k", "id").collect()
    assert [r.flow_idx for r in got] == list(range(3000))


def test_rare_destination(spark):
    from flowverdict.operators.upstream import with_rare_destination

    rows = [("a", False)] * 5 + [("b", True), ("b", None), (None, True)]
    got = with_rare_destination(spark.createDataFrame(rows, "d string, rare_destination boolean"), "d", 2)
    assert sorted((str(r.d), r.rare_destination) for r in got.collect()) == (
        [("None", False)] + [("a", False)] * 5 + [("b", True)] * 2
    )
