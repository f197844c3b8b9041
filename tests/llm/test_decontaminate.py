import random

import numpy as np
import pyarrow as pa
import pytest

from flowverdict.llm import decontaminate as d

from .plain import contaminated_pairs

rng = random.Random(7)
VOCABULARY = [f"w{i}" for i in range(400)]


def sentence(n):
    return " ".join(rng.choices(VOCABULARY, k=n))


ITEMS = [(i, sentence(rng.choice([12, 12, 12, 30, 47]))) for i in range(25)]
ITEMS += [(25, None), (26, ""), (27, "three words only"), (28, ITEMS[3][1]), (29, "a a a a a a a a b")]


def changed(text, n):
    words = text.split()
    for at in rng.sample(range(len(words)), n):
        words[at] = "changed"
    return " ".join(words)


def documents():
    texts = [None, "", "three words only", "Three, WORDS; only!", "a " * 400, sentence(20_000)]
    for i, (_, item) in enumerate(ITEMS[:25]):
        texts.append(sentence(40) + "\n" + item.upper() + ".\n" + sentence(30))
        texts.append(sentence(15) + " " + changed(item, 1) + " " + sentence(5))
        texts.append(changed(item, 3))
        texts.append(item + " " + ITEMS[(i + 1) % 25][1])
    texts += [sentence(60) for _ in range(30)]
    return list(enumerate(texts)) + [(3, "three words only"), (None, ITEMS[0][1])]


DOCS = documents()


@pytest.fixture(scope="module")
def frames(spark):
    docs = spark.createDataFrame(
        [(i, t, "x", 1.5) for i, t in DOCS], "doc_id long, text string, item string, similarity double"
    )
    return docs.repartition(4), spark.createDataFrame(ITEMS, "item_id int, text string")


@pytest.mark.parametrize("block_items", [20_000, 8])
def test_against_plain_search(frames, block_items):
    found = d.contaminated(*frames, block_items=block_items)
    got = {(r.key, r.item): (r.similarity, r.first_word) for r in found.collect()}
    want = contaminated_pairs(DOCS, ITEMS)
    assert len(want) > 60
    assert {k: s for k, (s, _) in got.items()} == pytest.approx({k: s for k, (s, _) in want.items()})
    assert {k: at for k, (_, at) in got.items()} == {k: at for k, (_, at) in want.items()}


def test_clean_rows_stay_with_all_columns(frames):
    docs, items = frames
    kept = d.remove_contaminated(docs, items)
    assert kept.columns == docs.columns
    bad = {text for i, text in DOCS if contaminated_pairs([(i, text)], ITEMS)}
    assert sorted(r.text or "" for r in kept.collect()) == sorted(
        t or "" for _, t in DOCS if t not in bad
    )


@pytest.mark.parametrize("radius", [4, 36])
def test_blocks_find_every_fingerprint_within_the_radius(radius):
    draw = np.random.default_rng(radius)
    bags = [draw.integers(1 << 62, size=9).astype(np.uint64) for _ in range(130)]
    index = d.SizeIndex(list(range(130)), bags, radius)
    asked = np.repeat(index.prints[:40], 3, axis=0)
    flips = draw.integers(0, 2 * radius, len(asked))
    for row, n in enumerate(flips):
        asked[row, draw.choice(128, n, replace=False)] ^= True
    window, item = index.near(asked)
    apart = (asked[:, None] != index.prints[None]).sum(axis=2)
    assert set(zip(window.tolist(), item.tolist())) == set(zip(*map(list, np.nonzero(apart <= radius))))


def test_empty_tables(spark, frames):
    docs, items = frames
    assert d.contaminated(docs.limit(0), items).collect() == []
    assert d.contaminated(docs, items.limit(0)).collect() == []
    assert d.remove_contaminated(docs, items.limit(0)).count() == len(DOCS)


def test_index_of_no_items():
    table = pa.table({"item": pa.array([], pa.int32()), "text": pa.array([], pa.string())})
    shingles = np.arange(5, dtype=np.uint64)
    assert list(d.ItemIndex(table).search(shingles, np.array([0, 5]), 0.8)) == []


def test_documents_shorter_than_an_item(spark):
    item = " ".join(f"s{i}" for i in range(37))  # 33 shingles
    cut = {n: " ".join(item.split()[:n]) for n in (4, 30, 31, 33, 36, 37)}
    texts = [*cut.items(), (133, " ".join(item.split()[4:])), (134, cut[33] + "\n"), (135, "x " * 29)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    items = spark.createDataFrame([(1, item)], "item_id int, text string")
    got = {r.key: (r.similarity, r.first_word, r.n_shingles) for r in d.contaminated(docs, items).collect()}
    # 27 of 33 shingles are 0.818, 26 are 0.788.
    want = {n: (k / 33, 0, k) for n, k in ((31, 27), (33, 29), (36, 32), (37, 33), (133, 29), (134, 29))}
    assert got == {n: (pytest.approx(s), a, k) for n, (s, a, k) in want.items()}
    kept = {r.doc_id for r in d.remove_contaminated(docs, items).collect()}
    assert kept == {4, 30, 135}
