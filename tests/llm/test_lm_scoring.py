import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from flowverdict.llm import lm_scoring as lm
from flowverdict.llm.text import word_hashes

from .plain import words


@pytest.fixture(scope="module")
def texts():
    """Sentences in which every word follows from its neighbours, and shuffled ones."""
    rng = random.Random(3)
    chain = [f"k{i}" for i in range(40)]
    out = []
    for _ in range(1500):
        at, n = rng.randrange(40), rng.randrange(20, 60)
        out.append(" ".join(chain[(at + i) % 40] for i in range(n)))
    return out


@pytest.fixture(scope="module")
def trained(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    vocabulary = lm.build_vocabulary(docs)
    return docs, vocabulary, lm.train(docs, vocabulary)


def test_gradient():
    draw = np.random.default_rng(0)
    p = lm.Parameters(*[x.astype(float) for x in lm.initial_parameters(draw.random(lm.VOCABULARY))])
    around, word = draw.integers(0, lm.VOCABULARY + 1, (12, 2 * lm.SIDE)), draw.integers(0, lm.VOCABULARY, 12)
    for x, g in zip(p, lm.gradient(p, around, word)):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        values = []
        for step in (1e-5, -2e-5):
            x[at] += step
            values.append(-lm.log_probability(p, around, word).mean())
        x[at] += 1e-5
        assert g[at] == pytest.approx((values[0] - values[1]) / 2e-5, rel=1e-4)


def test_gradient_sums_repeated_words():
    """Against sums row by row, with words and neighbours that repeat up to hundreds of times."""
    draw = np.random.default_rng(1)
    p = lm.Parameters(*[x.astype(float) for x in lm.initial_parameters(draw.random(lm.VOCABULARY))])
    around = np.minimum(draw.pareto(0.4, (700, 2 * lm.SIDE)), lm.VOCABULARY).astype(np.int64)
    word = np.minimum(draw.pareto(0.4, 700), lm.VOCABULARY - 1).astype(np.int64)
    want = lm.Parameters(*[np.zeros_like(x) for x in p])
    for i in range(700):
        for x, g in zip(want, lm.gradient(p, around[i : i + 1], word[i : i + 1])):
            x += g / 700
    for x, g in zip(want, lm.gradient(p, around, word)):
        assert np.allclose(x, g, rtol=1e-9, atol=1e-12)


def test_large_logits():
    draw = np.random.default_rng(2)
    p = lm.initial_parameters(draw.random(lm.VOCABULARY))
    around, word = draw.integers(0, lm.VOCABULARY, (9, 2 * lm.SIDE)), draw.integers(0, lm.VOCABULARY, 9)
    want, slopes = lm.log_probability(p, around, word), lm.gradient(p, around, word)
    for shift in (200, -200):
        q = p._replace(class_bias=p.class_bias + np.float32(shift), member_bias=p.member_bias - np.float32(shift))
        assert np.allclose(lm.log_probability(q, around, word), want, atol=1e-3)
        for x, g in zip(lm.gradient(q, around, word), slopes):
            assert np.allclose(x, g, atol=1e-4)


def test_a_step_takes_what_its_words_need():
    """Nothing of the vocabulary's size is made for a batch."""
    start = lm.initial_parameters(np.ones(1 << 18))
    trainer, draw = lm.Trainer(start), np.random.default_rng(3)
    around, word = draw.integers(0, 1 << 18, (lm.BATCH, 2 * lm.SIDE)), draw.integers(0, 1 << 18, lm.BATCH)
    tracemalloc.start()
    trainer.step(around, word)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < start.embedding.nbytes / 2


def test_probabilities_sum_to_one_and_the_word_is_masked(trained):
    _, vocabulary, model = trained
    around = np.full((lm.VOCABULARY, 2 * lm.SIDE), 5)
    total = np.exp(lm.log_probability(model, around, np.arange(lm.VOCABULARY))).sum()
    assert total == pytest.approx(1, abs=1e-3)
    ids, first = np.array([4, 5, 6]), np.array([0, 3])
    assert 5 not in lm.contexts(ids, first, np.array([1]))


def test_contexts_stay_inside_texts():
    ids, first = np.array([1, 2, 3, 4]), np.array([0, 1, 1, 4])
    got = lm.contexts(ids, first, np.arange(4))
    pad = lm.PAD
    assert got.tolist() == [
        [pad] * 6,
        [pad, pad, pad, 3, 4, pad],
        [pad, pad, 2, 4, pad, pad],
        [pad, 2, 3, pad, pad, pad],
    ]


def test_training_learns_from_both_sides(spark, texts, trained):
    docs, vocabulary, model = trained
    start = lm.initial_parameters(vocabulary.counts)
    held = pa.array([" ".join(f"k{(s + i) % 40}" for i in range(50)) for s in range(20)])
    rng = random.Random(8)
    shuffled = pa.array([" ".join(rng.sample(t.as_py().split(), 50)) for t in held])

    def mean(p, column):
        n, total = lm.Scorer(p, vocabulary).score(column)
        return total.sum() / n.sum()

    assert mean(model, held) > mean(start, held) + 0.5
    assert mean(model, held) > mean(model, shuffled) + 0.5


def test_scores_are_sums_over_all_words(spark, trained):
    docs, vocabulary, model = trained
    rows = [(1, "k1 k2 k3 unknown k5"), (2, None), (3, ""), (4, "!?"), (None, "k1"), (6, "k7 " * 30_000), (1, "k1 k2 k3 unknown k5")]
    frame = spark.createDataFrame([(k, t, 0.0) for k, t in rows], "doc_id long, text string, score double")
    got = lm.score(frame.repartition(2), model, vocabulary).collect()
    assert len(got) == len(rows)
    for r in got:
        text = next(t for k, t in rows if k == r.key)
        column = pa.array([text], pa.string())
        hashes, first = word_hashes(column)
        ids = vocabulary.encode(hashes)
        each = lm.log_probability(model, lm.contexts(ids, first, np.arange(len(ids))), ids) if len(ids) else np.zeros(0)
        assert r.n_words == len(words(text)) == len(ids)
        assert r.score == pytest.approx(each.sum(dtype=float), rel=1e-4)
        assert (r.mean_score is None) == (r.n_words == 0)


def test_vocabulary_counts_all_texts(spark, texts, trained):
    _, vocabulary, _ = trained
    assert vocabulary.counts.sum() == pytest.approx(sum(len(words(t)) for t in texts))
    assert len(vocabulary.hashes) == 40 and sorted(vocabulary.ids) == list(range(40))
    unknown = vocabulary.encode(np.array([1, 2, 3], dtype=np.uint64))
    assert (unknown >= lm.VOCABULARY - lm.UNKNOWN).all()


def test_every_position_trains_whatever_the_batches():
    texts = [f"k{i}" for i in range(12)] + ["k1 k2", "k3 k4 k5", "", None, "k6 " * 3000]
    n = sum(len(words(t)) for t in texts)
    vocabulary = lm.Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.ones(lm.VOCABULARY))
    start = lm.initial_parameters(vocabulary.counts)
    column = pa.array(texts, pa.string())
    for cuts in ([0, 17], [0, 1, 2, 9, 17], [*range(18)]):
        batches = [pa.record_batch({"text": column.slice(a, z - a)}) for a, z in zip(cuts, cuts[1:])]
        rows = [r.to_pydict() for r in lm._train_task(start, vocabulary)(batches)]
        assert {r["seen"][0] for r in rows} == {n}


def test_words_of_one_id_are_told_apart_by_their_counts(spark, trained):
    _, vocabulary, model = trained
    few = vocabulary._replace(hashes=vocabulary.hashes[:0], ids=vocabulary.ids[:0])
    at = {}  # three words that share an id
    for i in range(4000):
        hashes, _ = word_hashes(pa.array([f"r{i}"]))
        at.setdefault(int(few.encode(hashes)[0]), []).append(f"r{i}")
    a, b, c = next(x for x in at.values() if len(x) > 2)[:3]
    rows = [(1, f"{a} {a} {b}"), (2, f"{b} {a}"), (None, f"{c}"), (2, f"{b} {a}"), (5, ""), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    counted = lm.count_words(docs)
    counts = few.counts.copy()
    counts[few.encode(word_hashes(pa.array([a]))[0])] = 8
    few = few._replace(counts=counts)
    plain = sorted((r.key or 0, r.score) for r in lm.score(docs, model, few).collect())
    got = sorted((r.key or 0, r.score) for r in lm.score(docs, model, few, counted=counted).collect())
    log = {a: np.log(4 / 8), b: np.log(3 / 8), c: np.log(1 / 8)}
    for (k, before), (key, after) in zip(plain, got, strict=True):
        text = next(t for i, t in rows if (i or 0) == k)
        assert key == k and after - before == pytest.approx(sum(log[w] for w in words(text)), abs=1e-6)


def test_vocabulary_grows_with_the_words(spark):
    docs = spark.createDataFrame([(i, f"w{i} w{i} x") for i in range(20_000)], "doc_id long, text string")
    some, more = lm.build_vocabulary(docs.limit(3000)), lm.build_vocabulary(docs.limit(5000))
    assert len(some.counts) == lm.VOCABULARY and len(some.hashes) == 3001
    assert len(more.counts) == 4 * lm.VOCABULARY and len(more.hashes) == 5001
    all_ = lm.build_vocabulary(docs)
    assert len(all_.counts) == lm.MAX_VOCABULARY == len(all_.hashes) + lm.UNKNOWN
    assert all_.counts.sum() == 60_000
    hashes, _ = word_hashes(pa.array([f"w{i}" for i in range(20_000)]))
    ids = all_.encode(hashes)
    assert (np.bincount(ids, np.full(len(ids), 2), len(all_.counts))[-lm.UNKNOWN :] == all_.counts[-lm.UNKNOWN :]).all()
    small = docs.limit(6000)
    n = [r.n_words for r in lm.pseudo_likelihood(small).collect()]
    assert n == [3] * 6000


def test_average_is_weighted_by_positions():
    def row(n, value):
        weights = np.full(3, value * n, dtype=np.float32).tobytes()
        return pa.record_batch({"block": pa.array([0], pa.int32()), "seen": pa.array([n]), "weights": pa.array([weights])})

    (total,) = lm._sum_blocks([row(1, 4.0), row(3, 8.0)])
    got = total.to_pydict()
    assert got["seen"] == [4] and np.frombuffer(got["weights"][0], np.float32).tolist() == [28.0] * 3


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lm.pseudo_likelihood(empty).collect() == []


def test_a_batch_looks_for_each_neighbour_once():
    draw = np.random.default_rng(4)
    for n in (1, 7, 300):
        around = np.minimum(draw.pareto(0.4, (n, 2 * lm.SIDE)), lm.VOCABULARY).astype(np.int64)
        word = draw.integers(0, lm.VOCABULARY, n)
        batch = lm.Batch(around, word, lm.VOCABULARY + 1)
        assert sorted(batch.ids) == sorted(set(around.ravel().tolist()))
        found = zip(batch.word.tolist(), *batch.ids[batch.steps].tolist())
        assert sorted(found) == sorted(zip(word.tolist(), *around.T.tolist()))
        groups, values = batch.groups, draw.integers(-9, 9, (around.size, 3)).astype(float)
        want = np.zeros((lm.VOCABULARY + 1, 3))
        np.add.at(want, batch.ids[batch.steps].ravel(), values)
        assert (groups.sums(values) == want[batch.ids]).all()


def test_one_large_and_one_small_bias():
    """Against logits in float64, where exponentials or their factors leave float32."""
    draw = np.random.default_rng(5)
    p = lm.initial_parameters(draw.random(lm.VOCABULARY))
    around, word = draw.integers(0, lm.VOCABULARY, (64, 2 * lm.SIDE)), np.arange(64) * 64
    for shift in (-150, -60, 60, 150):
        q = p._replace(class_bias=p.class_bias.copy(), member_bias=p.member_bias.copy())
        q.class_bias[3] += shift
        q.member_bias[5, 0] += shift
        exact = lm.Parameters(*[x.astype(float) for x in q])
        want, slopes = lm.log_probability(exact, around, word), lm.gradient(exact, around, word)
        assert np.allclose(lm.log_probability(q, around, word), want, rtol=1e-5, atol=1e-3)
        for x, g in zip(lm.gradient(q, around, word), slopes):
            assert np.allclose(x, g, atol=1e-5)


def test_ids_are_found_among_hashes_of_one_bucket():
    """Hashes with equal upper bits, words before, between and after them, and no known words."""
    upper = np.repeat(np.array([0, 7, 0xFFFF], dtype=np.uint64) << np.uint64(48), 3)
    hashes = upper + np.tile(np.array([5, 9, 11], dtype=np.uint64), 3)
    vocabulary = lm.Vocabulary(hashes, np.arange(9)[::-1].copy(), np.ones(lm.VOCABULARY))
    assert vocabulary.encode(hashes).tolist() == list(range(9))[::-1]
    strangers = np.concatenate([hashes - np.uint64(1), hashes + np.uint64(1), hashes[:1] + (np.uint64(1) << np.uint64(50))])
    assert (vocabulary.encode(strangers) >= lm.VOCABULARY - lm.UNKNOWN).all()
    none = vocabulary._replace(hashes=hashes[:0], ids=np.arange(0))
    assert (none.encode(hashes) >= lm.VOCABULARY - lm.UNKNOWN).all()
    assert len(vocabulary.encode(hashes[:0])) == 0


@pytest.mark.parametrize("most", [1, 1 << 19])
def test_a_task_counts_its_words_once(monkeypatch, most):
    monkeypatch.setattr(lm, "COUNTED", most)
    texts = ["a b a", "", None, "b c", "a"]
    batches = [pa.record_batch({"text": pa.array(x, pa.string())}) for x in (texts, texts[1:3], texts)]
    rows = [r for b in lm._count_words(batches) for r in b.to_pylist()]
    counts = {}
    for r in rows:
        counts[r["word"]] = counts.get(r["word"], 0) + r["n"]
    assert sorted(counts.values()) == [2, 4, 6]
    assert most == 1 or len(rows) == 3
