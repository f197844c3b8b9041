import random
from math import comb

import numpy as np
import pytest

from flowverdict.llm import jaccard_join as j
from flowverdict.llm.components import connected_components

from .plain import near_duplicate_rows, shingles

VOCABULARY = [f"u{i}" for i in range(500)]


def corpus(seed):
    rng = random.Random(seed)

    def sentence(n):
        return " ".join(rng.choices(VOCABULARY, k=n))

    texts = [None, "", "!!!", "---", "***", "!!!", "one", "One!", "two words", sentence(20_000)]
    for size, copies in ((60, 40), (100, 25), (200, 6), (30, 4)):
        base = sentence(size).split()
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words))] = rng.choice(VOCABULARY)
            texts.append(" ".join(words))
    texts += [sentence(rng.randrange(5, 80)) for _ in range(60)]
    rng.shuffle(texts)
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [(1000, texts[0]), (1000, texts[0]), (1001, texts[1])]


@pytest.mark.parametrize("seed, block", [(1, 256), (2, 8)])
def test_against_all_pairs(spark, monkeypatch, seed, block):
    """With small blocks a class is spread over many block pairs."""
    monkeypatch.setattr(j, "BUCKET_BLOCK", block)
    monkeypatch.setattr(j, "VERIFY_BLOCK", block)
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, node string, size int")
    got = j.near_duplicates(docs.repartition(4)).collect()
    assert len(got) == len(rows)
    assert {r.key: (r.class_key, r.n_links) for r in got} == near_duplicate_rows(rows)
    monkeypatch.setattr(j, "BUCKET_BLOCK", 256)


def test_one_of_each_class_stays(spark):
    rows = corpus(3) + [(None, "null key twice here now"), (None, "null key twice here now")]
    docs = spark.createDataFrame([(i, t, f"e{n}") for n, (i, t) in enumerate(rows)], "doc_id long, text string, node string")
    kept = j.keep_one_of_each(docs.repartition(4))
    assert kept.columns == docs.columns
    want = {c for c, _ in near_duplicate_rows(rows[:-2]).values()}
    got = kept.collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted(want)
    assert sum(r.doc_id is None for r in got) == 1
    assert all(rows[int(r.node[1:])] == (r.doc_id, r.text) for r in got)


def test_least_matches_is_the_posterior_bound():
    least = j.least_matches(0.8, 1e-6)

    def posterior(n, m):  # P(similarity >= 0.8) after m of n, uniform prior
        return sum(comb(n + 1, i) * 0.8**i * 0.2 ** (n + 1 - i) for i in range(m + 1))

    for n, m in zip(range(16, 129, 16), least):
        assert posterior(n, m) >= 1e-6 and (m == 0 or posterior(n, m - 1) < 1e-6)


def test_minhash_estimates_jaccard():
    draw = np.random.default_rng(1)
    common = draw.integers(1 << 62, size=800).astype(np.uint64)
    own = draw.integers(1 << 62, size=(2, 100)).astype(np.uint64)
    both = np.concatenate([common, own[0], common, own[1]])
    values = j.minhash(both, np.array([0, 900, 1800, 1800]))
    assert abs((values[0] == values[1]).mean() - 0.8) < 0.12 and not values[2].any()


def test_matrix_and_pairwise_counts_agree():
    draw = np.random.default_rng(2)
    sets = [np.unique(draw.integers(0, 300, n).astype(np.uint64)) for n in (50, 200, 1, 90, 250)]
    a, b = np.triu_indices(5, 1)
    want = [len(np.intersect1d(sets[x], sets[y])) for x, y in zip(a, b)]
    assert j._shared_of_pairs(sets, a, b).tolist() == want
    assert j._shared_by_matrix(sets, a, b).tolist() == want


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(400 + i, 401 + i) for i in range(60)]
    edges += [(5, 5), (None, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {r.node: r.component for r in got} == {x: find(x) for x in parent if find(x) != x}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert j.near_duplicates(empty).collect() == []
    assert j.keep_one_of_each(empty).collect() == []


def test_exact_links_reach_the_threshold_exactly():
    nine = np.arange(9, dtype=np.uint64)
    sets = [nine, nine[1:], np.concatenate([nine[:8], nine[8:] + np.uint64(50)])]
    linked = j.exact_links(sets, np.array([0, 0]), np.array([1, 2]), 0.8)
    assert linked.tolist() == [True, True] and len(shingles("a b c d e f")) == 2
