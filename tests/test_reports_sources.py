import csv
import glob
import io
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowverdict import default_catalog, read_flow_csv, score_flows
from flowverdict.operators.cap import row_cap
from flowverdict.plans import reports, results
from flowverdict.sources.catalog import Rule, catalog_frame
from flowverdict.sources.flow_csv import POSITION, unique_headers
from flowverdict.sources.scratch import scratch_folder
from flowverdict.sources.writers import write_csv, write_parquet


def profile(spark, scores):
    df = spark.createDataFrame([("ALERT", s) for s in scores], "action string, risk_score double")
    return reports.risk_profile(df)


@pytest.mark.parametrize("scores", [
    [0.1, 0.2, 0.2, 0.35, 0.9],
    [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0],
    [0.5] * 4,
    [0.0] * 3,
    [0.3333, 0.7777],
])
def test_histogram_against_pandas(spark, scores):
    got = [r.flows for r in reports.risk_histogram(profile(spark, scores)).orderBy("bin").collect()]
    assert got == pd.Series(scores).value_counts(bins=10, sort=False).tolist()


def test_reports_of_nothing(spark):
    empty = profile(spark, [])
    row = reports.action_totals(empty).first()
    assert (row.total, row.blocks, row.block_share) == (0, 0, None)
    assert reports.risk_histogram(empty).count() == 0
    assert reports.action_frequency(empty).count() == 0


def test_totals(spark):
    df = spark.createDataFrame([("BLOCK", 0.9)] + [("ALLOW", 0.1)] * 7, "action string, risk_score double")
    row = reports.action_totals(reports.risk_profile(df)).first()
    assert row.asDict() == {"total": 8, "blocks": 1, "alerts": 0, "allows": 7,
                            "block_share": "12.5%", "alert_share": "0.0%", "allow_share": "87.5%"}
    frequency = reports.action_frequency(reports.risk_profile(df)).collect()
    assert [tuple(r) for r in frequency] == [("ALLOW", 7), ("BLOCK", 1)]


def test_row_counts(flows):
    row = reports.row_counts(flows, default_catalog(), 500).first()
    assert tuple(row) == (1000, 334, 500, 61)


def test_capped_run(flows):
    capped = score_flows(flows, key=["event_id"], cap=10)
    assert sorted(r.event_id for r in capped.collect()) == list(range(10))
    assert score_flows(flows, key=["event_id"], cap=0).count() == 0
    with pytest.raises(ValueError, match="order_by"):
        score_flows(flows, cap=10)


def test_rule_listing_and_filter(spark):
    rules = [Rule("A", "a"), *default_catalog()[:2]]
    catalog = catalog_frame(spark, rules)
    listing = results.rule_listing(catalog).collect()
    assert [(r.rule_id, r.category, r.condition) for r in listing] == [
        ("A", "Misc", ""), ("NET-001", "Anomaly", "dst_port  >  49152"),
        ("NET-001", "Anomaly", "pkt_count  >  50"),
        ("NET-002", "Anomaly", "flow_bytes_per_sec  >  10000000"), ("NET-002", "Anomaly", "duration  >  60")]
    chosen = results.filter_catalog(catalog, ["Misc"], ["LOW"]).collect()
    assert [r.rule_id for r in chosen] == ["A"]


# -- CSV ----------------------------------------------------------------------------------

TEXT = ''' Flow Duration,Flow Bytes/s,Flag,Name,Name,Whole,Gaps,Empty,When
1,Infinity,True,"a, ""b""",x,5,7,,2017-07-07 03:30:00
2,NaN,FALSE,NA,y,-6,,NA,7/7/2017
 3,1.5e3,true,c,,7,9,nan,x
'''


@pytest.fixture
def csv_path(tmp_path):
    path = tmp_path / "flows.csv"
    path.write_text(TEXT)
    return str(path)


def test_csv_types_and_values_like_pandas(spark, csv_path):
    df = read_flow_csv(spark, csv_path)
    want = pd.read_csv(csv_path, low_memory=False)
    assert df.columns == want.columns.tolist()
    kinds = {"int64": "bigint", "float64": "double", "bool": "boolean", "object": "string", "str": "string"}
    assert [t for _, t in df.dtypes] == [kinds[str(t)] for t in want.dtypes]
    for got, expected in zip(df.collect(), want.to_dict("records")):
        for a, b in zip(got, expected.values()):
            missing = b is None or (isinstance(b, float) and math.isnan(b))
            assert (a is None) if missing else a == b


def test_csv_with_schema_needs_no_inference(spark, csv_path):
    schema = T.StructType([T.StructField("Flow Duration", T.DoubleType())])
    df = read_flow_csv(spark, csv_path, schema)
    assert dict(df.dtypes)[" Flow Duration"] == "double"
    assert {t for n, t in df.dtypes if n != " Flow Duration"} == {"string"}


def test_csv_position_follows_the_file(spark, tmp_path):
    path = tmp_path / "many.csv"
    path.write_text("n\n" + "\n".join(str(i * 7 % 1000) for i in range(1000)) + "\n")
    df = read_flow_csv(spark, str(path), position=True)
    first = row_cap(df, 5, [POSITION]).orderBy(POSITION).collect()
    assert [r.n for r in first] == [0, 7, 14, 21, 28]


def test_headers():
    assert unique_headers(["a", "a", "", "a", "a.1"]) == ["a", "a.1", "Unnamed: 2", "a.2", "a.1.1"]


def test_csv_sink_like_pandas(spark):
    rows = [("BLOCK", 0.0001, 'say "hi", ok', "", True, 12), ("ALLOW", 1e-05, "→", None, False, 3)]
    names = ["Action", "Risk Score", "Reasoning", "Empty", "Hit", "Port"]
    df = spark.createDataFrame(rows, "a string, r double, t string, e string, h boolean, p long").toDF(*names)
    folder = scratch_folder(spark, "test-csv")
    write_csv(df.coalesce(1), folder)
    text = "".join(open(f, encoding="utf-8").read() for f in glob.glob(f"{folder}/*.csv"))
    want = io.StringIO()
    pd.DataFrame(rows, columns=names).to_csv(want, index=False)
    assert list(csv.reader(io.StringIO(text))) == list(csv.reader(io.StringIO(want.getvalue())))


def test_parquet_sink(spark, flows):
    folder = scratch_folder(spark, "test-parquet")
    write_parquet(score_flows(flows, key=["event_id"]), folder)
    assert spark.read.parquet(folder).count() == 1000


def test_csv_to_result(spark, csv_path):
    """A file of few known columns runs through the whole plan."""
    scored = score_flows(read_flow_csv(spark, csv_path))
    rows = results.report_rows(scored.withColumn("flow_idx", F.lit(0))).collect()
    assert len(rows) == 3
    # The label column is absent, so every flow is UNKNOWN.
    assert {r.label for r in rows} == {"UNKNOWN"}


def test_files_with_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Destination Port,Protocol,Label\n443,6,x\n80,17,\n")
    (tmp_path / "b c.csv").write_text("Protocol,Destination Port,Extra\n6,22,7\n")
    df = read_flow_csv(spark, str(tmp_path))
    assert df.columns == ["Destination Port", "Protocol", "Label", "Extra"]
    rows = {tuple(r) for r in df.collect()}
    assert rows == {(443, 6, "x", None), (80, 17, None, None), (22, 6, None, 7.0)}
    assert read_flow_csv(spark, str(tmp_path), position=True).count() == 3


@pytest.mark.parametrize("files", [["a"], ["a", "b"]])
def test_surplus_cells_are_an_error(spark, tmp_path, files):
    for name in files:
        (tmp_path / f"{name}.csv").write_text("p,q\n1,2\n3,4,5\n6\n")
    with pytest.raises(Exception, match="more cells than the header"):
        read_flow_csv(spark, str(tmp_path)).collect()
    with pytest.raises(Exception, match="more cells than the header"):
        read_flow_csv(spark, str(tmp_path), schema=T.StructType()).select("q").collect()


def test_detection_counts(spark):
    rows = [("BENIGN", "ALLOW"), ("benign", "BLOCK"), ("DDoS", "ALERT"), (None, "ALLOW"), ("x", "BLOCK")]
    scored = spark.createDataFrame(rows, "label string, action string")
    assert tuple(reports.detection_counts(scored).first()) == (2, 1, 1, 1)
    assert reports.label_actions(scored).count() == 5


def test_saved_models_are_chosen_by_id(spark, trained, tmp_path):
    from dataclasses import replace

    from flowverdict.sources.model_store import load_model, save_model

    path = str(tmp_path / "models")
    first = save_model(spark, trained.model, path)
    assert save_model(spark, trained.model, path) == first
    other = replace(trained.model, nodes=trained.model.nodes.assign(threshold=0.0))
    assert save_model(spark, other, path) != first
    assert load_model(spark, path, first).nodes.equals(trained.model.nodes)
    assert (load_model(spark, path).nodes.threshold == 0).all()
    with pytest.raises(FileNotFoundError):
        load_model(spark, path, "none")


def test_catalog_through_the_readers_of_spark(spark, tmp_path):
    import json

    from flowverdict.sources.catalog import load_catalog

    file = tmp_path / "rules.json"
    file.write_text(json.dumps({"rules": [{"id": "A", "conditions": [{"field": "x", "op": ">", "value": 1}]}]}))
    assert load_catalog(f"file://{file}", spark) == load_catalog(file)


def test_scratch_folders_are_removed(spark):
    from pathlib import Path

    from flowverdict.sources.scratch import remove_scratch, scratch_folder, scratch_scope, stored

    before = stored(spark.range(5), "kept")
    with pytest.raises(RuntimeError), scratch_scope(spark):
        inside = stored(spark.range(9), "inside")
        assert inside.count() == 9
        raise RuntimeError
    path = [Path(f.removeprefix("file:")) for f in inside.inputFiles()]
    assert before.count() == 5 and not any(p.exists() for p in path)
    own = scratch_folder(spark, "own")
    spark.range(3).write.parquet(own)
    assert remove_scratch(spark, [own]) == 1 and not Path(own).exists()
    assert remove_scratch(spark, [own]) == 0 and before.count() == 5
