"""Alignment of two tokenizers by divide and conquer, and corpus counts of linked ids.

A text is encoded twice: a blank and the text by a byte-level BPE (A), the text by a merge-type
piece model (B), which puts the blank itself.  Both cut the same bytes into tokens.

1. ``shared_cuts`` finds the ends that both sides share.  An interval of tokens starts as a
   whole text; the shared end nearest after its middle (else before it) is located by
   bisecting the ends of the two sides in turn, and both halves are cut again.  An interval
   without a shared end inside is a leaf group.  All intervals of a batch of texts are cut at
   once, level by level, so the depth is logarithmic and the work is in numpy.
2. Tokens of a group are linked where their bytes overlap; a group of n and m tokens has
   n + m - 1 links, one for each stretch between neighbouring ends.
3. The count of a pair of ids is the number of documents that hold it linked.  Distinct pairs
   of a text are counted in the tasks and added up by a grouped sum.
4. Each text is held against the counts: how many of its links are the best of their A id, and
   the sum over its links.  The ``table_pairs`` most frequent pairs go to the tasks as two sorted
   arrays (24 MB at the default); links of other pairs are joined by a shuffle and
   added.  The result does not depend on that bound.

Null and empty texts have no tokens, nor have texts whose joined tokens are not the blank and
the text (those that hold U+2581).  They get zeros and empty lists.  Whole texts are read;
repeated rows are documents of their own, null keys are kept, extra columns are ignored.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowverdict.llm import bpe
from flowverdict.llm.piece_codec import BLANK, id_lists
from flowverdict.llm.text import text_chunks
from flowverdict.sources.scratch import stored

TABLE_PAIRS = 1 << 20
# Pairs held in a task before they are added up, and before the sums leave it.
HELD_PAIRS = 1 << 20
# An A id and a B id in one number.
B_BITS = 24
CHUNK_BYTES = 1 << 20


# -- cuts ----------------------------------------------------------------------------------

def _next_shared(ends_a, ends_b, at, last):
    """For each interval the first A index from ``at`` on, before ``last``, whose end B shares.

    ``last`` where there is none.  A step bisects the ends of B, then those of A.
    """
    at = np.minimum(at, last)
    out = last.copy()
    alive = np.flatnonzero(at < last)
    here = at[alive]
    while len(alive):
        end = ends_a[here]
        met = ends_b[np.searchsorted(ends_b, end)]
        shared = met == end
        out[alive[shared]] = here[shared]
        alive, met = alive[~shared], met[~shared]
        here = np.searchsorted(ends_a, met)
        inside = here < last[alive]
        alive, here = alive[inside], here[inside]
    return out


def _previous_shared(ends_a, ends_b, at, first):
    """The last A index from ``at`` down to ``first`` whose end B shares, else ``first - 1``."""
    out = first - 1
    alive = np.flatnonzero(at >= first)
    here = at[alive]
    while len(alive):
        end = ends_a[here]
        low = np.searchsorted(ends_b, end, side="right") - 1
        met = np.where(low >= 0, ends_b[low], -1)
        shared = met == end
        out[alive[shared]] = here[shared]
        alive, met = alive[~shared], met[~shared]
        here = np.searchsorted(ends_a, met, side="right") - 1
        inside = here >= first[alive]
        alive, here = alive[inside], here[inside]
    return out


def shared_cuts(
    ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of A and of B tokens up to each shared end, in order.

    ``ends_a`` and ``ends_b`` are the byte ends of the tokens of texts one after the other,
    ``first_a`` and ``first_b`` say where the tokens of each text begin (n + 1).  The end of a
    text is always shared.
    """
    found_a, found_b = [first_a[1:]], [first_b[1:]]
    low_a, high_a, low_b, high_b = first_a[:-1], first_a[1:], first_b[:-1], first_b[1:]
    while len(low_a):
        # A side of one token is a leaf.
        open_ = (high_a - low_a > 1) & (high_b - low_b > 1)
        low_a, high_a, low_b, high_b = (x[open_] for x in (low_a, high_a, low_b, high_b))
        middle, last = (low_a + high_a - 1) // 2, high_a - 1
        cut = _next_shared(ends_a, ends_b, middle, last)
        back = np.flatnonzero(cut == last)
        before = _previous_shared(ends_a, ends_b, middle[back] - 1, low_a[back])
        cut[back] = before
        whole = np.ones(len(cut), dtype=bool)
        whole[back] = before >= low_a[back]
        low_a, high_a, low_b, high_b, cut = (
            x[whole] for x in (low_a, high_a, low_b, high_b, cut)
        )
        cut_b = np.searchsorted(ends_b, ends_a[cut]) + 1
        cut_a = cut + 1
        found_a.append(cut_a)
        found_b.append(cut_b)
        # In order, so that the next bisections go through memory in order.
        low_a, high_a = (np.column_stack(x).ravel() for x in ((low_a, cut_a), (cut_a, high_a)))
        low_b, high_b = (np.column_stack(x).ravel() for x in ((low_b, cut_b), (cut_b, high_b)))
    return np.sort(np.concatenate(found_a)), np.sort(np.concatenate(found_b))


def links(
    ends_a: np.ndarray, ends_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the A and B tokens over each stretch between neighbouring ends."""
    both = np.concatenate([ends_a, ends_b])
    # Two sorted runs are merged; of equal ends that of A comes first.
    order = np.argsort(both, kind="stable")
    both, is_a = both[order], order < len(ends_a)
    last = np.ones(len(both), dtype=bool)
    last[:-1] = both[1:] != both[:-1]
    until_a = np.cumsum(is_a)
    until_b = np.arange(1, len(both) + 1) - until_a
    with_a, with_b = is_a.copy(), ~is_a
    with_a[1:] |= (both[1:] == both[:-1]) & is_a[:-1]
    # Tokens that end before the end of the stretch.
    return (until_a - with_a)[last], (until_b - with_b)[last]


# -- encoding ------------------------------------------------------------------------------

class _Tables:
    def __init__(self, path_a: str, path_b: str):
        as_bytes = bpe.token_bytes(path_a)
        self.size_a = np.array([len(b) for b in as_bytes], dtype=np.int64)
        self.model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        names = [self.model.id_to_piece(i) for i in range(len(self.model))]
        # A byte piece stands for one byte, a blank's mark for one blank.
        self.size_b = np.array(
            [
                1 if self.model.is_byte(i) else len(name.replace(BLANK, " ").encode())
                for i, name in enumerate(names)
            ],
            dtype=np.int64,
        )
        self.text_a = self._with_marks(len(as_bytes), "|")
        self.text_b = self._with_marks(len(names), ";")

    @staticmethod
    def _with_marks(n: int, last: str) -> np.ndarray:
        """Ids as text, before another of the group and as the last of it."""
        return np.array([[f"{i}," for i in range(n)], [f"{i}{last}" for i in range(n)]], dtype=object)


@cache
def tables(path_a: str, path_b: str) -> _Tables:
    return _Tables(path_a, path_b)


def blobs(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """One binary value for each row: its numbers, little-endian."""
    offsets = (first * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(first) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)]
    )


def unblob(column: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows, and where each row's begin (n + 1)."""
    column = column.cast(pa.binary())
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    ends = ends.astype(np.int64)
    width = np.dtype(dtype).itemsize
    count = int(ends[-1] - ends[0]) // width
    if not count:
        return np.zeros(0, dtype), np.zeros(len(ends), np.int64)
    return np.frombuffer(data, dtype, count, int(ends[0])), (ends - ends[0]) // width


# Ids and group sizes as they are stored.
ID, SIZE = np.dtype("<u4"), np.dtype("<u4")
SMALL_ID = np.dtype("<u2")


def _id_types(t: _Tables) -> tuple[np.dtype, np.dtype]:
    return tuple(SMALL_ID if len(size) <= 1 << 16 else ID for size in (t.size_a, t.size_b))


def _encoded(texts: list[str | None], path_a: str, t: _Tables) -> list[tuple[list, list]]:
    """Ids of both sides of some texts.

    All pieces are parts of the normalised text, so joined they can differ from the blank and
    the text only where the text holds the mark of a blank itself, which is longer than a blank.
    """
    out = []
    for text, b in zip(texts, t.model.encode([x or "" for x in texts], num_threads=1), strict=True):
        if not text or int(t.size_b[b].sum()) != 1 + len(text.encode()):
            out.append(([], []))
        else:
            out.append((bpe.encode_plain(path_a, " " + text), b))
    return out


def _counts(first: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """How many cuts lie in each text; an empty text has none."""
    place = np.searchsorted(first, cuts, side="left") - 1
    return np.bincount(place, minlength=len(first) - 1)


def _aligner(path_a: str, path_b: str):
    def run(batches):
        t = tables(path_a, path_b)
        type_a, type_b = _id_types(t)
        for batch in batches:
            texts = batch.column("text")
            for low, high in text_chunks(texts, CHUNK_BYTES):
                rows = _encoded(texts.slice(low, high - low).to_pylist(), path_a, t)
                a, b = id_lists([r[0] for r in rows]), id_lists([r[1] for r in rows])
                ids_a, first_a = a.values.to_numpy(), a.offsets.to_numpy().astype(np.int64)
                ids_b, first_b = b.values.to_numpy(), b.offsets.to_numpy().astype(np.int64)
                ends_a, ends_b = np.cumsum(t.size_a[ids_a]), np.cumsum(t.size_b[ids_b])
                some = np.flatnonzero(np.diff(first_a))
                own_a, own_b = np.append(first_a[some], len(ids_a)), np.append(first_b[some], len(ids_b))
                cut_a, cut_b = shared_cuts(ends_a, ends_b, own_a, own_b)
                groups = np.zeros(high - low, dtype=np.int64)
                groups[some] = _counts(own_a, cut_a)
                first = np.concatenate([[0], np.cumsum(groups)])
                yield pa.record_batch(
                    {
                        "row": batch.column("row").slice(low, high - low),
                        "key": batch.column("key").slice(low, high - low),
                        "a": blobs(ids_a.astype(type_a), first_a),
                        "b": blobs(ids_b.astype(type_b), first_b),
                        "group_a": blobs(np.diff(cut_a, prepend=0).astype(SIZE), first),
                        "group_b": blobs(np.diff(cut_b, prepend=0).astype(SIZE), first),
                    }
                )

    return run


def aligned_blobs(docs: DataFrame, path_a: str, path_b: str, text: str, key: str) -> DataFrame:
    """Stored: row, key, and numbers in binary form: ids, and tokens of each group."""
    narrow = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("key"),
        F.col(text).alias("text"),
    )
    schema = (
        f"row long, key {dict(docs.dtypes)[key]}, a binary, b binary, "
        "group_a binary, group_b binary"
    )
    return stored(narrow.mapInArrow(_aligner(path_a, path_b), schema), "aligned")


def align(
    docs: DataFrame, path_a: str, path_b: str, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """One row per document: key, ids ``a`` and ``b``, and the tokens of each group of either
    side (group_a, group_b)."""
    names = ["a", "b", "group_a", "group_b"]

    def run(batches):
        t = tables(path_a, path_b)
        types = dict(zip(names, [*_id_types(t), SIZE, SIZE], strict=True))
        for batch in batches:
            lists = {}
            for name, dtype in types.items():
                values, first = unblob(batch.column(name), dtype)
                lists[name] = pa.ListArray.from_arrays(
                    pa.array(first.astype(np.int32)), pa.array(values.astype(np.int32))
                )
            yield pa.record_batch({"key": batch.column("key")} | lists)

    found = aligned_blobs(docs, path_a, path_b, text, key)
    schema = f"key {dict(docs.dtypes)[key]}, " + ", ".join(f"{n} array<int>" for n in names)
    return found.select("key", *names).mapInArrow(run, schema)


# -- counts --------------------------------------------------------------------------------

def _sides(batch: pa.RecordBatch, t: _Tables):
    """Ids of A, where rows begin in them, and the same of B."""
    type_a, type_b = _id_types(t)
    return *unblob(batch.column("a"), type_a), *unblob(batch.column("b"), type_b)


def _links_of(batch: pa.RecordBatch, t: _Tables):
    """Codes of the pairs of all links of the rows, and the row of each."""
    ids_a, first_a, ids_b, _ = _sides(batch, t)
    at_a, at_b = links(np.cumsum(t.size_a[ids_a]), np.cumsum(t.size_b[ids_b]))
    codes = ids_a[at_a].astype(np.int64) << B_BITS | ids_b[at_b].astype(np.int64)
    return codes, np.searchsorted(first_a, at_a, side="right") - 1


def _distinct(codes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of each row with their links: row, code, links; in order."""
    order = np.lexsort((codes, rows))
    codes, rows = codes[order], rows[order]
    new = np.flatnonzero(np.append(True, (codes[1:] != codes[:-1]) | (rows[1:] != rows[:-1])))
    if not len(codes):
        return rows, codes, rows
    return rows[new], codes[new], np.diff(np.append(new, len(codes)))


def _slices(batches, rows: int = 256):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _pair_counter(path_a: str, path_b: str):
    def run(batches):
        t = tables(path_a, path_b)
        codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        new: list[np.ndarray] = []
        held = 0

        def added():
            every = np.concatenate([codes, *new])
            weight = np.concatenate([counts, np.ones(len(every) - len(codes), np.int64)])
            found, place = np.unique(every, return_inverse=True)
            return found, np.bincount(place, weights=weight, minlength=len(found)).astype(np.int64)

        for batch in _slices(batches):
            own = _distinct(*_links_of(batch, t))[1]
            new.append(own)
            held += len(own)
            if held >= HELD_PAIRS:
                codes, counts = added()
                new, held = [], 0
                if len(codes) >= HELD_PAIRS // 2:
                    yield pa.record_batch({"pair": codes, "count": counts})
                    codes, counts = codes[:0], counts[:0]
        codes, counts = added()
        yield pa.record_batch({"pair": codes, "count": counts})

    return run


def pair_counts(aligned: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Stored: pair (code), count of documents, best (the count is its A id's highest).

    An A id has at most as many pairs as B has ids.
    """
    partial = aligned.select("a", "b").mapInArrow(_pair_counter(path_a, path_b), "pair long, count long")
    summed = partial.groupBy("pair").agg(F.sum("count").alias("count"))
    own = Window.partitionBy(F.shiftright("pair", B_BITS))
    return stored(summed.withColumn("best", F.col("count") == F.max("count").over(own)), "pairs")


# -- results -------------------------------------------------------------------------------

def group_texts(batch: pa.RecordBatch, t: _Tables) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of each row: groups in order, ids in decimal."""
    ids_a, first_a, ids_b, first_b = _sides(batch, t)
    in_a, in_b = (unblob(batch.column(f"group_{x}"), SIZE)[0].astype(np.int64) for x in "ab")
    out = np.empty(len(ids_a) + len(ids_b), dtype=object)
    for ids, sizes, before, marks in (
        (ids_a, in_a, np.cumsum(in_b) - in_b, t.text_a),
        (ids_b, in_b, np.cumsum(in_a), t.text_b),
    ):
        # How many tokens of the other side stand before a token.
        shift = np.repeat(before, sizes)
        is_last = np.zeros(len(ids), dtype=np.int64)
        is_last[np.cumsum(sizes) - 1] = 1
        out[np.arange(len(ids)) + shift] = marks[is_last, ids]
    ends = first_a + first_b
    return ["".join(out[x:y].tolist())[:-1] for x, y in zip(ends[:-1], ends[1:], strict=True)]


def _result(path_a: str, path_b: str, table: tuple[np.ndarray, np.ndarray], whole: bool):
    """Rows of results; ``whole`` says that the table holds all pairs."""
    known, values = table

    def run(batches):
        t = tables(path_a, path_b)
        for batch in _slices(batches):
            n = batch.num_rows
            codes, rows = _links_of(batch, t)
            _, first_a, _, first_b = _sides(batch, t)
            at = np.minimum(np.searchsorted(known, codes), max(0, len(known) - 1))
            hit = known[at] == codes if len(known) else np.zeros(len(codes), dtype=bool)
            value = values[at[hit]]
            # The lowest bit of a value says best.
            total = np.zeros(n, dtype=np.int64)
            np.add.at(total, rows[hit], value >> 1)  # 64-bit integers
            best = np.bincount(rows[hit], weights=value & 1, minlength=n).astype(np.int64)
            out = {
                "row": batch.column("row"),
                "key": batch.column("key"),
                "n_a": np.diff(first_a),
                "n_b": np.diff(first_b),
                "n_groups": np.diff(unblob(batch.column("group_a"), SIZE)[1]),
                "n_links": np.bincount(rows, minlength=n),
                "n_best": best,
                "count_sum": total,
                "groups": pa.array(group_texts(batch, t), pa.string()),
            }
            if not whole:
                left, pair, n_links = _distinct(codes[~hit], rows[~hit])
                bounds = pa.array(np.searchsorted(left, np.arange(n + 1)).astype(np.int32))
                both = pa.StructArray.from_arrays([pa.array(pair), pa.array(n_links.astype(np.int64))], ["pair", "links"])
                out["rest"] = pa.ListArray.from_arrays(bounds, both)
            yield pa.record_batch(out)

    return run


def alignment_counts(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    text: str = "text",
    key: str = "doc_id",
    table_pairs: int = TABLE_PAIRS,
) -> DataFrame:
    """One row per document: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups."""
    aligned = aligned_blobs(docs, path_a, path_b, text, key)
    pairs = pair_counts(aligned, path_a, path_b)
    whole = pairs.count() <= table_pairs
    top = pairs if whole else pairs.orderBy(F.desc("count"), "pair").limit(table_pairs)
    got = top.select("pair", (F.col("count") * 2 + F.col("best").cast("long")).alias("value")).toArrow()
    known, values = got["pair"].to_numpy(), got["value"].to_numpy()
    order = np.argsort(known)
    table = known[order], values[order]
    schema = (
        f"row long, key {dict(docs.dtypes)[key]}, n_a long, n_b long, n_groups long, "
        "n_links long, n_best long, count_sum long, groups string"
    )
    if whole:
        return aligned.mapInArrow(_result(path_a, path_b, table, True), schema).drop("row")
    schema += ", rest array<struct<pair:long,links:long>>"
    found = stored(aligned.mapInArrow(_result(path_a, path_b, table, False), schema), "found")
    rest = found.select("row", F.inline("rest")).join(pairs, "pair")
    rest = rest.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("more_best"),
        F.sum(F.col("links") * F.col("count")).alias("more_sum"),
    )
    return found.join(rest, "row", "left").select(
        "key",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        "groups",
    )
