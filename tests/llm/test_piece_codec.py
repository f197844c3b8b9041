import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from flowverdict.llm import piece_codec
from flowverdict.llm.queries import LLM_QUERIES

PATH = str(public_tokenizers.path("piece_bpe_32k.model"))
PARTS = list("abcdefghijklmnop  \n\t▁́é́あ😀ABC<>019.,'\"()-_/{}=中文русский한국") + ["the ", " ing", "    ", "\0"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return piece_codec.pieces(PATH)


@pytest.mark.parametrize("seed", range(4))
def test_encodes_as_the_library(model, library, seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(1, 40))) for _ in range(1500)]
    texts += [" " * n + "x" * (n % 3) for n in range(100)]
    want = library.encode(texts, add_eos=True)
    assert [model.encode(t) for t in texts] == want
    assert [model.decode(ids) for ids in want] == library.decode(want)


def test_whole_long_words(model, library):
    for text in (" " * 60_000 + "y", "a" * 60_000, "ab" * 30_000, "\n" * 50_000, "é😀" * 9_000):
        assert model.encode(text) == library.encode(text, add_eos=True)


def test_texts_are_cut_where_no_piece_spans():
    fine = piece_codec._splitter({n: i for i, n in enumerate(["▁", "▁a", "ab", "▁(", "));", "²)", "é"])})
    assert fine.findall("▁▁ab,(x)▁12_²)é\n\n▁\n") == ["▁▁ab", ",(", "x", ")", "▁", "1", "2", "_²)", "é", "\n\n", "▁", "\n"]
    for name in ("a)", ")a", "12", "▁1"):
        assert "".join(piece_codec._splitter({name: 0}).findall("a)▁12")) == "a)▁12"
        assert piece_codec._splitter({name: 0}).findall("x▁a)▁12") == ["x", "▁a)", "▁12"]
    assert piece_codec._splitter({"a\n": 0}).findall("x▁a\nb") == ["x", "▁a\nb"]
    assert piece_codec._splitter({"a▁": 0}).findall("x▁a\nb") == ["x▁a\nb"]


def test_pairs_are_compatible_as_merging_says(model):
    rng = random.Random(5)
    ids = [i for i in model.text if len(model.text[i]) == 1 or model._left[i] >= 0]
    pairs = [(rng.choice(ids), rng.choice(ids)) for _ in range(3000)]
    # Neighbours of real merges, so that many pairs are not compatible.
    pairs += [(model._left[i], model._right[i]) for i in ids if model._left[i] >= 0][:3000]
    found = [model.compatible(a, b) for a, b in pairs]
    assert found == [model.merge(model.text[a] + model.text[b])[0] == [a, b] for a, b in pairs]
    assert 100 < sum(found) < len(found) - 100


def test_failed_positions_bound_the_search(model):
    """Shortening goes back over several pieces, and no position is tried twice."""
    tried = []
    real = model.compatible
    model.compatible = lambda a, b: tried.append((a, b)) or real(a, b)
    model._pairs.clear()
    try:
        text = "▁" + "abababcabcdabcde" * 200
        longest = [-1] * len(text)
        for end, piece in model._matches(text):
            longest[end + 1 - model._size[piece]] = piece
        out = model._known(longest)
    finally:
        model.compatible = real
    assert "".join(model.text[i] for i in out) == text and len(tried) < 30 * len(text)


def test_decodes_any_ids_as_the_library(model, library):
    rng = random.Random(7)
    for _ in range(4000):
        ids = [
            rng.choice([0, 1, 2, 28705, *range(3, 259)]) if rng.random() < 0.5 else rng.randrange(32_000)
            for _ in range(rng.randrange(8))
        ]
        assert model.decode(ids) == library.decode(ids), ids
    assert model.decode([model.byte_ids[0xCB], 1, model.byte_ids[0x85]]) == "��"


def test_the_cache_is_bounded(model, monkeypatch, library):
    monkeypatch.setattr(piece_codec, "CACHED_WORDS", 50)
    monkeypatch.setattr(piece_codec, "CACHED_PAIRS", 20)
    small = piece_codec.Pieces(PATH)
    text = " ".join(f"w{i % 300}" for i in range(3000))
    assert small.encode(text) == library.encode(text, add_eos=True)
    assert len(small._cache) <= 50 and len(small._older) <= 50


def test_rows(spark, library):
    texts = [None, "", "a b", "a b", "x▁y", "퟿\U0001f600", "word " * 30_000]
    rows = [(None if n == 3 else n, t, n, "c") for n, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int, key string")
    found = piece_codec.decode(piece_codec.encode(docs.repartition(3), PATH), PATH).collect()
    got = {r.key: (r.ids, r.text) for r in found}
    want = {r[0]: library.encode(r[1] or "", add_eos=True) for r in rows}
    assert got == {k: (ids, library.decode(ids)) for k, ids in want.items()}
    bare = piece_codec.encode(docs, PATH, end=False)
    assert {r.key: r.ids for r in bare.collect()} == {k: ids[:-1] for k, ids in want.items()}
    assert piece_codec.encode(docs.filter("false"), PATH).count() == 0
    named = docs.selectExpr("concat('d', doc_id) AS doc_id", "text")
    assert dict(piece_codec.encode(named, PATH).dtypes)["key"] == "string"


def test_another_kind_of_model_is_refused(tmp_path):
    with pytest.raises((ValueError, RuntimeError, OSError)):
        piece_codec.Pieces(str(tmp_path / "none.model"))


def test_query(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in LLM_QUERIES["op13_piece_codec"](spark, "/root/testdata/sf0.001").collect()}
    want = {}
    for key, text in docs:
        ids = library.encode(text or "", add_eos=True)
        texts = " ".join(map(str, ids)), library.decode(ids)
        want[key] = (len(ids), *(hashlib.sha256(t.encode()).hexdigest() for t in texts))
    assert got == want and len(docs) > 100
