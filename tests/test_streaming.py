import pytest

from flowverdict import score_flows
from checks.event_flows import flows_from_events, read_events
from flowverdict.sources.scratch import scratch_folder
from flowverdict.streaming.scoring import score_stream, start_batch_scoring
from tests.conftest import SF


@pytest.fixture
def stream(spark, tmp_path):
    """The events in four files, read one file per micro-batch."""
    events = read_events(spark, SF)
    folder = str(tmp_path / "events")
    events.repartition(4, "event_id").write.parquet(folder)
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
    return flows_from_events(source.parquet(folder))


def test_frozen_stream_equals_batch(spark, stream, flows, trained):
    folder = scratch_folder(spark, "test-stream")
    columns = ["event_id", "action", "risk_score", "anomaly_score"]
    scored = score_stream(stream, trained.model, key=["event_id"]).select(*columns)
    query = (
        scored.writeStream.option("checkpointLocation", f"{folder}/c")
        .trigger(availableNow=True).start(f"{folder}/rows")
    )
    query.awaitTermination()
    got = spark.read.parquet(f"{folder}/rows")
    want = score_flows(flows, model=trained.model, stats="frozen", key=["event_id"]).select(*columns)
    assert got.count() == 1000
    assert got.exceptAll(want).count() == 0


def test_batch_statistics_per_micro_batch(spark, stream, trained):
    folder = scratch_folder(spark, "test-batches")
    start_batch_scoring(
        stream, f"{folder}/rows", f"{folder}/c", trained.model, key=["event_id"]
    ).awaitTermination()
    rows = spark.read.parquet(f"{folder}/rows")
    assert rows.select("batch_id").distinct().count() == 4
    assert rows.select("event_id").distinct().count() == rows.count() == 1000


def test_streams_refuse_what_needs_a_batch(stream, trained):
    with pytest.raises(ValueError, match="cap"):
        score_stream(stream, cap=5)
    with pytest.raises(ValueError, match="batch"):
        score_stream(stream, trained.model, stats="batch")
