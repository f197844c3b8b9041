import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowverdict.operators import rule_index
from flowverdict.operators.rule_index import matched_by_index
from flowverdict.operators.rules import evaluate_rules
from flowverdict.operators.rules_relational import matched_by_data
from flowverdict.sources.catalog import Condition, Rule, default_catalog

OPS = [">", ">=", "<", "<=", "==", "!=", "~", None]


def catalog(seed, n=400):
    rng = random.Random(seed)
    fields = ["x", "n", "t", "b", "absent", "d"]
    values = [0, 1, 2, -3, 2.5, "1", "a", "A", "nan", float("nan"), float("inf"), True, "true", "", "1e0", None]
    rules = []
    for i in range(n):
        own = tuple(
            Condition(rng.choice(fields), rng.choice(OPS), rng.choice(values)) for _ in range(rng.choice([0, 1, 1, 2, 3]))
        )
        rules.append(Rule(rule_id=f"r{i}", name=f"r{i}", severity="LOW", conditions=own))
    return rules


def flows(spark, seed, n=150):
    rng = random.Random(seed)
    inf, nan = float("inf"), float("nan")
    rows = [
        (
            i, rng.choice([0.0, 1.0, 2.5, -3.0, nan, inf, None]), rng.choice([0, 1, 2, -3, None]),
            rng.choice(["a", "A", "1", " 1 ", "1e0", "nan", "", "true", "0", None]), rng.choice([True, False, None]),
            rng.choice([None, 0, 2]),
        )
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "id int, x double, n bigint, t string, b boolean, d int")
    return df.withColumn("d", F.col("d").cast("decimal(5,2)")).repartition(3)


@pytest.mark.parametrize("seed, pairs", [(1, 1 << 21), (2, 64), (3, 1 << 21)])
def test_same_as_testing_every_rule(spark, monkeypatch, seed, pairs):
    monkeypatch.setattr(rule_index, "PAIRS", pairs)
    df, rules = flows(spark, seed), catalog(seed)
    both = df.select("id", matched_by_data(df, rules).alias("want"), matched_by_index(df, rules).alias("got"))
    rows = both.collect()
    assert len(rows) == 150 and any(r.want for r in rows)
    for r in rows:
        assert r.got == r.want, r.id


def test_shipped_rules(spark, flows_table=None):
    from checks.event_flows import flows_from_events, read_events

    df = flows_from_events(read_events(spark, "/root/testdata/sf0.001"))
    rules = default_catalog()
    got = df.select("event_id", matched_by_index(df, rules).alias("m")).collect()
    want = evaluate_rules(df, rules).select("event_id", "matched").collect()
    assert dict(map(tuple, got)) == dict(map(tuple, want))


def test_no_rules_and_no_flows(spark):
    df = flows(spark, 5)
    assert {tuple(r[0]) for r in df.select(matched_by_index(df, [])).collect()} == {()}
    bare = [Rule(conditions=()), Rule(conditions=())]
    assert {tuple(r[0]) for r in df.select(matched_by_index(df, bare)).collect()} == {(0, 1)}
    assert df.filter("false").select(matched_by_index(df, catalog(1))).collect() == []


def test_memory_does_not_grow_with_the_rows():
    """Half of the rules match each flow."""
    rules = [Rule(rule_id=f"r{i}", conditions=(Condition("x", "<" if i % 2 else ">=", 3 * i),)) for i in range(2400)]
    index = rule_index.RuleIndex(rules)

    def peak(n):
        values = pa.array(np.arange(n) * 37.0 % 7200)
        bounds = pa.array(np.arange(n + 1, dtype=np.int32))
        numbers, shown = (pa.ListArray.from_arrays(bounds, x) for x in (values, pa.nulls(n, pa.string())))
        at, found = 0, 0
        tracemalloc.start()
        for part in index.matches(numbers, shown):
            for got in part[:: max(1, len(part) // 2)]:  # arrays of some rows
                assert all(type(r) is int for r in got.as_py())
            x = 37.0 * at % 7200
            assert part[0].as_py() == [i for i in range(2400) if (x < 3 * i if i % 2 else x >= 3 * i)]
            at, found = at + len(part), found + len(part.flatten())
        largest = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert at == n and found > 1000 * n
        return largest

    few, many = peak(500), peak(6000)
    assert many < 1.5 * few and many < 60e6
