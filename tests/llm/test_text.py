import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from flowverdict.llm.tables import whole_groups
from flowverdict.llm.text import HashSet, shingles_of, text_chunks, word_hashes

from .plain import shingles, words

TEXTS = st.lists(
    st.none() | st.text(alphabet="aB1_ é!\n\t|Üß漢", max_size=40), min_size=1, max_size=8
)


def same_partition(hashes, things):
    """Equal things have equal hashes and different ones different hashes."""
    return len(hashes) == len(things) and len(set(zip(hashes, things))) == len(set(things)) == len(
        set(hashes)
    )


@settings(deadline=None, max_examples=100)
@given(TEXTS)
def test_words_and_shingles_are_those_of_the_rule(texts):
    column = pa.array(texts, pa.string())
    hashes, first = word_hashes(column)
    want = [words(t) for t in texts]
    assert list(np.diff(first)) == [len(w) for w in want]
    assert same_partition(hashes.tolist(), [w for ws in want for w in ws])
    grams, begin = shingles_of(column)
    want = [shingles(t) for t in texts]
    assert list(np.diff(begin)) == [len(s) for s in want]
    assert same_partition(grams.tolist(), [s for ss in want for s in ss])


def test_chunks_cover_all_rows_and_long_texts_stand_alone():
    column = pa.array(["a" * 10, None, "b" * 500, "", "c"])
    chunks = list(text_chunks(column, limit=20))
    assert chunks[0] == (0, 2) and (2, 3) not in chunks[:1]
    assert [i for a, z in chunks for i in range(a, z)] == [0, 1, 2, 3, 4]


def test_sliced_columns():
    column = pa.array(["one two", "three four five six seven", None, "eight"])
    whole, first = word_hashes(column)
    part, _ = word_hashes(column.slice(1, 3))
    assert (part == whole[first[1] :]).all()


def test_hash_set():
    members = np.random.default_rng(1).integers(1 << 63, size=500).astype(np.uint64)
    others = np.random.default_rng(2).integers(1 << 63, size=500).astype(np.uint64)
    found = HashSet(members).has(np.concatenate([members, others]))
    assert found[:500].all() and not found[500:].any()
    assert not HashSet(np.zeros(0, np.uint64)).has(others).any()


def test_groups_are_not_cut():
    keys = np.repeat(np.arange(50), np.random.default_rng(3).integers(1, 40, 50))
    table = pa.table({"k": keys})
    got = list(whole_groups(table.to_batches(max_chunksize=7), "k", least_rows=20))
    assert pa.concat_tables(got)["k"].to_pylist() == keys.tolist()
    seen = [set(t["k"].to_pylist()) for t in got]
    assert sum(map(len, seen)) == 50 and all(len(s) for s in seen)
