import hashlib
from collections import Counter

import pytest

from flowverdict.llm import exact_dedup

ROWS = [
    (1, "hot"), (2, "hot"), (9, "hot"), (9, "hot"), (4, "hot"), (None, "hot"),
    (3, "pair"), (7, "pair"), (5, ""), (6, None), (8, "Pair"), (10, "x" * 300_000),
    (None, "lost"), (None, "lost"), (11, "twin"), (11, "twin"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, f"extra {i}", "d", i) for i, (k, t) in enumerate(ROWS)]
    schema = "doc_id long, text string, digest string, kept string, row long"
    return spark.createDataFrame(rows, schema).repartition(4)


def expected():
    groups = {}
    for key, text in ROWS:
        groups.setdefault(text or "", []).append(key)
    return groups


@pytest.mark.parametrize("hot_rows", [3, 1000])
def test_groups(docs, hot_rows):
    got = exact_dedup.duplicate_groups(docs, tracked=16, hot_rows=hot_rows).collect()
    groups = expected()
    want = Counter()
    for text, keys in groups.items():
        best = max((k for k in keys if k is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        for key in keys:
            want[key, best, len(keys), digest] += 1
    assert Counter((r.key, r.keep_key, r.group_size, r.digest) for r in got) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) == len({r.digest for r in kept})
    assert all(r.key == r.keep_key for r in kept)


@pytest.mark.parametrize("hot_rows", [3, 1000])
def test_kept_rows_keep_their_columns(docs, hot_rows):
    got = exact_dedup.keep_one(docs, tracked=16, hot_rows=hot_rows)
    assert got.columns == docs.columns
    rows = got.collect()
    assert Counter(r.text or "" for r in rows) == Counter(expected().keys())
    for r in rows:
        assert ROWS[r.row] == (r.doc_id, r.text) and r.digest == f"extra {r.row}"
        assert r.doc_id == max((k for k in expected()[r.text or ""] if k is not None), default=None)


def test_heavy_hitters_are_found_among_many(spark):
    many = spark.range(20_000).selectExpr(
        "id AS doc_id", "IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS text"
    )
    rows = exact_dedup._rows(many, "text", "doc_id")
    (hot,) = exact_dedup.hot_groups(rows, tracked=64, hot_rows=100).collect()
    assert hot.hot_size == 6667 and hot.hot_keep.key == 19998


def test_no_python_in_the_plan(docs):
    for frame in (exact_dedup.duplicate_groups(docs), exact_dedup.keep_one(docs)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.duplicate_groups(empty).collect() == []
    assert exact_dedup.keep_one(empty).collect() == []


@pytest.mark.parametrize("kind", ["string", "date", "long"])
def test_keys_of_any_type(spark, kind):
    rows = [("2024-01-01", "a"), ("2024-03-01", "a"), (None, "a"), (None, "b"), (None, "b"), ("2024-02-01", None)]
    key = {"string": "k", "date": "cast(k AS date)", "long": "cast(replace(k, '-', '') AS long)"}[kind]
    docs = spark.createDataFrame(rows, "k string, text string").selectExpr(f"{key} AS doc_id", "text")
    for hot in (1000, 2):
        got = exact_dedup.keep_one(docs, hot_rows=hot).selectExpr("cast(doc_id AS string) AS k", "text").collect()
        want = {("2024-03-01", "a"), (None, "b"), ("2024-02-01", None)}
        if kind == "long":
            want = {(k and k.replace("-", ""), t) for k, t in want}
        assert len(got) == 3 and {tuple(r) for r in got} == want
