import math
import random
from datetime import datetime, timedelta, timezone

import pytest

from flowverdict.sources.scratch import scratch_folder
from flowverdict.streaming.statistics import running_bounds, start_running_bounds

SCHEMA = "sensor string, at timestamp, x double, y bigint, expired boolean"
START = datetime(2024, 1, 1, tzinfo=timezone.utc)
FEATURES = ["x", "y"]


def batch(seed, hour, n=200):
    """Most rows are of one sensor; y is missing from odd batches."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        sensor = "hot" if rng.random() < 0.7 else rng.choice(["a", "b", None])
        x = rng.choice([rng.uniform(-9, 9), None, math.nan])
        rows.append((sensor, START + timedelta(hours=hour, seconds=rng.randrange(3000)), x, None if seed % 2 else rng.randrange(99), True))
    return rows


def bounds(rows):
    out = {}
    for sensor, _, x, y, _ in rows:
        n, own = out.get(sensor, (0, ([], [])))
        own[0].extend([x] if x is not None and not math.isnan(x) else [])
        own[1].extend([float(y)] if y is not None else [])
        out[sensor] = n + 1, own
    return {
        s: (n, [len(v) for v in own], [min(v, default=None) for v in own], [max(v, default=None) for v in own])
        for s, (n, own) in out.items()
    }


@pytest.fixture
def run(spark, tmp_path):
    folder, scratch = tmp_path / "in", scratch_folder(spark, "bounds")
    folder.mkdir()

    def more(rows, name):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")
        source = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(str(folder))
        updates = running_bounds(source, "sensor", "at", FEATURES, "1 hour", 4 * 3600)
        start_running_bounds(updates, f"{scratch}/rows", f"{scratch}/c").awaitTermination()
        return spark.read.parquet(f"{scratch}/rows").collect()

    return more


def latest(updates):
    """The last update of each sensor that has not expired since."""
    out = {}
    for r in sorted(updates, key=lambda r: (r.batch_id, r.expired)):
        out[r.group] = None if r.expired else (r.rows, list(r.counts), list(r.minima), list(r.maxima))
    return {k: v for k, v in out.items() if v}


def test_restarted_stream_equals_a_replay(run):
    """Each call starts the query again from its checkpoint."""
    rows = []
    for n in range(3):
        rows += batch(n, n)
        assert latest(run(batch(n, n), n)) == bounds(rows)


def test_idle_groups_expire(run):
    first = [("old", START, 5.0, 1, True), ("kept", START, 1.0, 2, True)]
    run(first, 0)
    later = [("kept", START + timedelta(hours=20), 3.0, 0, True)]
    run(later, 1)
    # The watermark moves with the batch before.
    updates = run([("kept", START + timedelta(hours=21), 2.0, 7, True)], 2)
    assert [r.group for r in updates if r.expired] == ["old"]
    assert latest(updates)["kept"] == (3, [3, 3], [1.0, 0.0], [3.0, 7.0])
    anew = run([("old", START + timedelta(hours=22), 9.0, 9, True)], 3)
    assert latest(anew)["old"] == (1, [1, 1], [9.0, 9.0], [9.0, 9.0])
