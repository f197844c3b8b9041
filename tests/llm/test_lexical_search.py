import random
import re
from collections import Counter
from math import log

import numpy as np
import pytest

from flowverdict.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_search(docs, items, top=10):
    bags = [(k, Counter(terms(t))) for k, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n_docs, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for (key, bag), n in zip(bags, sizes, strict=True):
            score = 0
            for t in set(terms(text)) & set(bag):
                weight = int(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 100 - 90 + (90 * n * n_docs) // total
                score += weight * ((1000000000 * bag[t]) // (1000 * bag[t] + 8 * m))
            if score > 0:
                scored.append((-score, key is None, key))
        scored.sort(key=lambda e: e[:2] if e[1] else e)
        out += [(item, n + 1, e[2], -e[0]) for n, e in enumerate(scored[:top])]
    return sorted(out, key=str)


def corpus(seed, n=400):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(120)] + ["Éa", "éa", "ÀB", "x_y", "中文", "A1"]
    share = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, share, k=rng.choice([1, 3, 30, 200])))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, "!!! ---"), (n + 3, " ".join(rng.choices(words, k=5000)))]
    same = " ".join(rng.choices(words, share, k=12))
    docs += [(n + 10 + i, same) for i in range(60)] + [(n + 10, same), (None, same), (None, same + " w1")]
    items = [(i, " ".join(rng.choices(words + ["zz"], share + [0.1], k=rng.choice([1, 4, 40])))) for i in range(25)]
    items += [(90, same), (91, None), (92, "..."), (93, "zz"), (94, "w0 W0 w0"), (94, "w0 w1"), (None, "w2 w3")]
    rng.shuffle(docs)
    return docs, items


@pytest.mark.parametrize("seed, bucket, lead, block", [(1, 2048, 1024, 1 << 19), (2, 16, 8, 1 << 19), (3, 32, 1, 60)])
def test_against_plain(spark, monkeypatch, seed, bucket, lead, block):
    """Small buckets and blocks of queries give the same; the first bounds do not matter."""
    docs, items = corpus(seed)
    monkeypatch.setattr(ls, "BUCKET", bucket)
    monkeypatch.setattr(ls, "LEAD", lead)
    frame = spark.createDataFrame([(k, t, 1, 2) for k, t in docs], "doc_id long, text string, query int, terms int")
    queries = spark.createDataFrame([(k, t, 7) for k, t in items], "item_id long, text string, item int")
    got = ls.ranked_search(frame.repartition(3), queries, block_terms=block).collect()
    assert sorted(map(tuple, got), key=str) == plain_search(docs, items)


def parts_of(docs, items):
    """Vectors and queries of one task, without Spark."""
    import pyarrow as pa

    block = pa.table({"query": [i for i, _ in items], "item": [i for i, _ in items], "text": [t for _, t in items]})
    block = pa.Table.from_batches(list(ls._query_terms(block.to_batches()))).select(["query", "terms"])
    vocabulary = ls.Vocabulary(block)
    table = pa.table({"key": [k for k, _ in docs], "text": [t for _, t in docs]})
    batches = list(ls._vectorise(vocabulary)(table.to_batches()))
    counts = next(ls._document_counts(batches)).to_pydict()
    counts = dict(zip(counts["term"], counts["count"], strict=True))
    n, total = counts[-1], counts[-2]
    weights = [int(1000 * log((2 * n + 2) / (2 * counts.get(t, 0) + 1))) for t in range(len(vocabulary.hashes))]
    queries = ls._Queries(vocabulary, np.array(weights, dtype=np.int64), n, total)
    return ls._Vectors(batches, queries), queries


def test_bounds_prune_and_keep_what_counts():
    """Most vectors are never scored, and their true scores are below the final bound."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(3000)]
    share = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, share, k=rng.randrange(5, 60)))) for i in range(6000)]
    items = [(i, " ".join(rng.choices(words, share, k=12))) for i in range(20)]
    docs += [(9000 + i, text) for i, text in items]
    vectors, queries = parts_of(docs, items)
    queries.bucket = 256
    scored = []
    best = ls._Best(np.zeros(len(items), dtype=np.int64), 10)
    real = best.add
    best.add = lambda q, scores, rows, v: scored.append(len(rows)) or real(q, scores, rows, v)
    ls._search(vectors, queries, best, np.arange(len(items)))
    assert sum(scored) < 0.1 * len(docs) * len(items)
    want = plain_search(docs, items)
    got = [(i, n + 1, e[2], -e[0]) for i, entries in enumerate(best.entries) for n, e in enumerate(entries)]
    assert sorted(got, key=str) == want


def test_a_bucket_is_left_out_by_norm(monkeypatch):
    docs = [(i, "a b c d e f") for i in range(50)] + [(100 + i, "a " + "x " * 400) for i in range(500)]
    items = [(0, "a b c d e f")]
    vectors, queries = parts_of(docs, items)
    queries.bucket = 10
    best = ls._Best(np.zeros(1, dtype=np.int64), 10)
    seen = []
    monkeypatch.setattr(ls.np, "repeat", lambda *a, real=np.repeat, **k: seen.append(1) or real(*a, **k))
    ls._search(vectors, queries, best, np.arange(1))
    assert [e[2] for e in best.entries[0]] == list(range(10))
    assert len(seen) < 30


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert ls.ranked_search(docs, items).collect() == []
    some = spark.createDataFrame([("k", "a b")], "doc_id string, text string")
    assert ls.ranked_search(some, items.filter("false")).collect() == []
    assert [tuple(r) for r in ls.ranked_search(some, items).collect()] == [(1, 1, "k", 2 * int(1000 * log(4 / 3)) * (10**9 // (1000 + 800)))]
