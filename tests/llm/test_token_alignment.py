import hashlib
import json
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from flowverdict.llm import token_alignment as ta
from flowverdict.llm.queries import LLM_QUERIES, tokenizer_path

A, B = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


class Plain:
    """The two libraries, and token bytes spelled out from their files."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in plain}
        byte |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        vocabulary = json.load(open(A, encoding="utf-8"))["model"]["vocab"]
        self.bytes_a = {i: bytes(byte[c] for c in t) for t, i in vocabulary.items() if t != "<|endoftext|>"}

    def bytes_b(self, i):
        name = self.b.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace("▁", " ").encode()

    def tokens(self, text):
        """[(id, start, end)] of both sides."""
        if not text:
            return [], []
        whole = (" " + text).encode()
        sides = []
        for ids, of in (
            (self.a.encode(" " + text, add_special_tokens=False).ids, self.bytes_a.__getitem__),
            (self.b.encode(text), self.bytes_b),
        ):
            at, out = 0, []
            for i in ids:
                out.append((i, at, at + len(of(i))))
                at += len(of(i))
            if b"".join(map(of, ids)) != whole:
                return [], []
            sides.append(out)
        return tuple(sides)

    def rows(self, docs):
        texts = [self.tokens(t) for _, t in docs]
        linked = [overlaps(a, b) for a, b in texts]
        counts = Counter(pair for one in linked for pair in set(one))
        best = {}
        for (x, _), n in counts.items():
            best[x] = max(best.get(x, 0), n)
        out = []
        for (key, _), (a, b), own in zip(docs, texts, linked, strict=True):
            shared = sorted({t[2] for t in a} & {t[2] for t in b})
            groups = ["|".join(",".join(side) for side in group) for group in zip(parts(a, shared), parts(b, shared), strict=True)]
            out.append(
                (
                    key, len(a), len(b), len(groups), len(own),
                    sum(counts[p] == best[p[0]] for p in own), sum(counts[p] for p in own), ";".join(groups),
                )
            )
        return out


def parts(side, shared):
    """The ids up to each shared end."""
    out, ends = [[]], set(shared)
    for token, _, end in side:
        out[-1].append(str(token))
        if end in ends:
            out.append([])
    return out[:-1]


def overlaps(a, b):
    """Pairs of ids whose byte ranges overlap."""
    out, j = [], 0
    for x in a:
        while b[j][2] <= x[1]:
            j += 1
        k = j
        while k < len(b) and b[k][1] < x[2]:
            out.append((x[0], b[k][0]))
            k += 1
    return out


@pytest.fixture(scope="module")
def plain():
    return Plain()


def corpus():
    rng = random.Random(3)
    parts = ["the", " and", "  ", "\n", "é", "あ", "😀", "<|endoftext|>", "</s>", "12345", "_x_", "'ll", "Wörter", "\t", "ing"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(1, 40))) for _ in range(60)]
    texts += [None, "", "a", "has ▁ inside", " ", "same text here", "same text here", "x" * 999, "ab " * 900]
    return [(None if n == 5 else n, t) for n, t in enumerate(texts)]


@pytest.mark.parametrize("table_pairs", [1 << 20, 40, 0])
def test_against_plain(spark, plain, table_pairs):
    """The shuffle join of pairs beyond the table changes nothing."""
    docs = corpus()
    frame = spark.createDataFrame([(k, t, 1, "r") for k, t in docs], "doc_id long, text string, a int, row string")
    got = ta.alignment_counts(frame.repartition(3), A, B, table_pairs=table_pairs).collect()
    by_key = lambda rows: sorted(map(tuple, rows), key=lambda r: (r[0] is None, r))
    assert by_key(got) == by_key(plain.rows(docs))


def test_query(spark, plain):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = LLM_QUERIES["op12_token_alignment"](spark, SF).select(*columns).collect()
    want = []
    for row in plain.rows([(i, t) for i, t in docs]):
        digest = hashlib.sha256(row[-1].encode()).hexdigest() if row[1] else ""
        want.append((*row[:-1], digest))
    assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("seed", range(30))
def test_cuts(seed):
    rng = np.random.default_rng(seed)
    firsts, ends, base = ([0], [0]), ([], []), 0
    for _ in range(rng.integers(1, 5)):
        size = int(rng.integers(1, 200))
        for side, share in enumerate(rng.uniform(0.02, 0.9, 2)):
            inner = np.flatnonzero(rng.random(size - 1) < share) + 1
            ends[side].extend((base + np.append(inner, size)).tolist())
            firsts[side].append(len(ends[side]))
        base += size
    a, b = (np.array(e) for e in ends)
    shared = np.intersect1d(a, b)
    got = ta.shared_cuts(a, b, *(np.array(f) for f in firsts))
    assert got[0].tolist() == (np.searchsorted(a, shared) + 1).tolist()
    assert got[1].tolist() == (np.searchsorted(b, shared) + 1).tolist()


def test_pair_counts_leave_tasks_in_parts(spark, monkeypatch, plain):
    docs = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    aligned = ta.aligned_blobs(frame, A, B, "text", "doc_id")
    want = {r.pair: (r["count"], r.best) for r in ta.pair_counts(aligned, A, B).collect()}
    counter = ta._pair_counter(A, B)
    monkeypatch.setattr(ta, "HELD_PAIRS", 64)
    parts = [b for b in counter(aligned.select("a", "b").toArrow().to_batches(7))]
    sums = Counter()
    for batch in parts:
        for pair, n in zip(batch["pair"].to_pylist(), batch["count"].to_pylist(), strict=True):
            sums[pair] += n
    assert len(parts) > 1 and sums == {p: n for p, (n, _) in want.items()}


def test_aligned_ids(spark, plain):
    docs = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.key: r for r in ta.align(frame, A, B).collect()}
    for key, text in docs:
        a, b = plain.tokens(text)
        assert (got[key].a, got[key].b) == ([t[0] for t in a], [t[0] for t in b])
        assert sum(got[key].group_a) == len(a) and sum(got[key].group_b) == len(b)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id string, text string")
    assert ta.alignment_counts(docs, A, B).collect() == []
    only = spark.createDataFrame([("k", None)], "doc_id string, text string")
    assert [tuple(r) for r in ta.alignment_counts(only, A, B).collect()] == [("k", 0, 0, 0, 0, 0, 0, "")]


def test_tokenizers_are_public_files():
    assert A == str(public_tokenizers.path("byte_bpe_50k.json"))
