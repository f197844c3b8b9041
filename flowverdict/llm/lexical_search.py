"""Ranked lexical search by norm buckets over impact vectors, exact in integers.

A document is a vector of impacts, one for each term that some query holds; a query is the
vector of its terms' weights.  The score is their product.  With N documents that have terms,
L terms in all of them, n terms in a document, df documents of a term and tf occurrences:

    weight = floor(1000 * ln((2N + 2) / (2df + 1)))
    m      = 100 - 90 + (90 * n * N) div L          (percent of the average length, damped)
    impact = (1000000000 * tf) div (1000 * tf + 8 * m)

Queries are taken in blocks of bounded total length.  For a block:

1. one pass over the documents writes sparse vectors (terms of the block only, with tf) and
   counts N, L and df by grouped sums;
2. impacts follow, and each task orders its vectors by length (norm).  The longest of every
   task are scored first, which gives a lower bound of each query's k-th best score;
3. every task then walks through its vectors in buckets of falling norm.  A bucket is
   left out for a query if (norm of query) * (longest norm) is below the query's bound
   (Cauchy-Schwarz); so are then all later ones.  Inside, the coordinates of the query's
   heaviest terms are read from the bucket's inverted lists, and a vector goes if

       exact part on these coordinates + (norm of the rest of the vector) * (norm of the rest
       of the query)

   stays below the bound.  Survivors are scored in 64-bit integers, and the bound rises to
   the k-th best score met so far;
4. the best k of each task are ranked by a window, of which Spark cuts groups before the shuffle.

The bounds are widened by one part in 10^9, far above the error of doubles, so nothing is
lost.  Terms are told apart by 64-bit hashes: with a billion distinct words in the corpus and
100,000 terms in a block a false match somewhere has a chance of five in a million.

Terms are runs of ASCII letters and digits and of non-ASCII characters; only A-Z are lowered.
Null and empty texts have no terms, are never found and find nothing.  Whole texts are read.
Equal scores are ranked by key, null keys last; repeated rows are documents of their own,
repeated query rows queries of their own.  Extra columns are ignored.
"""

from __future__ import annotations

from math import log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowverdict.llm.text import raw_bytes, span_hashes, text_chunks, word_spans
from flowverdict.sources.scratch import stored

# Terms of all queries of a block, repeats between queries counted.
BLOCK_TERMS = 1 << 19
# Vectors ordered at a time, their terms, and vectors of a bucket.
HELD_ROWS, HELD_TERMS = 1 << 15, 1 << 22
BUCKET = 2048
# Vectors of each task that give the first bounds.
LEAD = 1024
FOCUS = 8
SLACK = 1 + 1e-9
TOP = 10

_TERM_BYTE = np.zeros(256, dtype=bool)
_TERM_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def term_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of the rows, and for each row where its terms begin (n + 1)."""
    data, offsets = raw_bytes(pc.fill_null(column.cast(pa.large_string()), ""))
    starts, ends = word_spans(data, offsets, _TERM_BYTE)
    return span_hashes(_LOWER[data], starts, ends), np.searchsorted(starts, offsets)


# -- queries -------------------------------------------------------------------------------

def _query_terms(batches):
    for batch in batches:
        texts = batch.column("text")
        for low, high in text_chunks(texts):
            hashes, first = term_hashes(texts.slice(low, high - low))
            own = [np.unique(hashes[x:y]).view(np.int64) for x, y in zip(first[:-1], first[1:], strict=True)]
            ends = np.cumsum([0, *map(len, own)]).astype(np.int32)
            terms = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(own)))
            yield pa.record_batch(
                {
                    "query": batch.column("query").slice(low, high - low),
                    "item": batch.column("item").slice(low, high - low),
                    "terms": terms,
                }
            )


def query_terms(items: DataFrame, text: str, item_id: str) -> DataFrame:
    """Stored: query (a number of its own), item, distinct term hashes."""
    numbered = items.select(
        F.monotonically_increasing_id().alias("query"),
        F.col(item_id).alias("item"),
        F.col(text).alias("text"),
    )
    schema = f"query long, item {dict(items.dtypes)[item_id]}, terms array<long>"
    found = numbered.mapInArrow(_query_terms, schema)
    return stored(found.filter(F.size("terms") > 0), "queries")


def query_blocks(queries: DataFrame, block_terms: int):
    """Tables (query, terms) of bounded expected size, one at a time."""
    total = queries.agg(F.sum(F.size("terms"))).first()[0] or 0
    n = -(-total // block_terms)
    for block in range(n):
        part = queries.filter(F.pmod(F.xxhash64("query"), F.lit(n)) == block)
        yield part.select("query", "terms").toArrow()


class Vocabulary:
    """The terms of a block of queries: sorted hashes, and each query's terms as numbers."""

    def __init__(self, block: pa.Table):
        block = block.combine_chunks()
        self.queries = block["query"].to_numpy()
        lists = block["terms"].combine_chunks()
        flat = lists.flatten().to_numpy()
        sizes = pc.list_value_length(lists).to_numpy()
        self.hashes, numbers = np.unique(flat.view(np.uint64), return_inverse=True)
        self.terms = np.split(numbers, np.cumsum(sizes)[:-1])

    def number(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are terms of the block, and their numbers."""
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        hit = self.hashes[at] == hashes
        return hit, at[hit]


# -- vectors -------------------------------------------------------------------------------

def _vectorise(vocabulary: Vocabulary):
    def run(batches):
        width = np.int64(len(vocabulary.hashes))
        for batch in batches:
            keys, texts = batch.column("key"), batch.column("text")
            for low, high in text_chunks(texts):
                hashes, first = term_hashes(texts.slice(low, high - low))
                rows = np.repeat(np.arange(high - low), np.diff(first))
                hit, numbers = vocabulary.number(hashes)
                found, tf = np.unique(rows[hit] * width + numbers, return_counts=True)
                bounds = np.searchsorted(found, np.arange(high - low + 1) * width)
                bounds = pa.array(bounds.astype(np.int32))
                yield pa.record_batch(
                    {
                        "key": keys.slice(low, high - low),
                        "n": pa.array(np.diff(first).astype(np.int64)),
                        "terms": pa.ListArray.from_arrays(bounds, pa.array((found % width).astype(np.int32))),
                        "tf": pa.ListArray.from_arrays(bounds, pa.array(tf.astype(np.int32))),
                    }
                )

    return run


def _document_counts(batches):
    """Partial df, with N and L as terms -1 and -2."""
    counts = np.zeros(0, np.int64)
    rows = total = 0
    for batch in batches:
        own = np.bincount(batch.column("terms").flatten().to_numpy()).astype(np.int64)
        n = batch.column("n").to_numpy()
        rows, total = rows + len(n), total + int(n.sum())
        short, counts = sorted((own, counts), key=len)
        counts[: len(short)] += short
    some = np.flatnonzero(counts)
    yield pa.record_batch(
        {
            "term": np.concatenate([[-1, -2], some]).astype(np.int32),
            "count": np.concatenate([[rows, total], counts[some]]).astype(np.int64),
        }
    )


def impacts(n: np.ndarray, sizes: np.ndarray, tf: np.ndarray, documents: int, total: int) -> np.ndarray:
    """Impacts of the terms of documents of ``n`` terms that have ``sizes`` vector entries."""
    lengths, place = np.unique(n, return_inverse=True)
    # Python integers: the product may pass 64 bits in very large corpora.
    m = np.array([100 - 90 + (90 * int(x) * documents) // total for x in lengths], dtype=np.int64)
    m = np.repeat(m[place], sizes)
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class _Queries:
    """What a task needs of a block: weights, norms and focus terms of each query."""

    def __init__(self, vocabulary: Vocabulary, weights: np.ndarray, documents: int, total: int):
        self.queries, self.documents, self.total = vocabulary.queries, documents, total
        self.width, self.bucket = len(weights), BUCKET
        self.terms, self.weights, self.norms, self.rest = [], [], [], []
        for terms in vocabulary.terms:
            own = weights[terms]
            order = np.argsort(-own, kind="stable")
            self.terms.append(terms[order].astype(np.int32))
            self.weights.append(own[order])
            squares = own[order].astype(float) ** 2
            self.norms.append(np.sqrt(squares.sum()))
            self.rest.append(np.sqrt(squares[FOCUS:].sum()))


class _Vectors:
    """Some vectors in order of falling norm: CSR arrays and keys."""

    def __init__(self, batches: list[pa.RecordBatch], queries: _Queries):
        table = pa.Table.from_batches(batches).combine_chunks()
        lists = table["terms"].combine_chunks()
        first = lists.offsets.to_numpy().astype(np.int64)
        terms = lists.values.to_numpy()[first[0] : first[-1]]
        tf = table["tf"].combine_chunks().flatten().to_numpy()
        first = first - first[0]
        sizes = np.diff(first)
        values = impacts(table["n"].to_numpy(), sizes, tf, queries.documents, queries.total)
        # Unsigned sums may wrap; a row's own is far below 2^64, so differences are exact.
        squares = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values.astype(np.uint64) ** np.uint64(2), out=squares[1:])
        norms = np.sqrt((squares[first[1:]] - squares[first[:-1]]).astype(float)) * SLACK
        order = np.argsort(-norms, kind="stable")
        self.norms, sizes = norms[order], sizes[order]
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(first[order] - self.first[:-1], sizes) + np.arange(self.first[-1])
        self.terms, self.values = terms[at], values[at]
        keys = table["key"].combine_chunks().take(pa.array(order))
        self.keys = keys
        ranked = pc.sort_indices(keys, null_placement="at_end").to_numpy()
        self.rank = np.empty(len(ranked), dtype=np.int64)
        self.rank[ranked] = np.arange(len(ranked))


class _Best:
    """The best entries of each query so far, and the score that another must reach."""

    def __init__(self, bounds: np.ndarray, top: int):
        self.bounds, self.top = bounds.copy(), top
        self.entries: list[list[tuple]] = [[] for _ in bounds]

    def add(self, q: int, scores: np.ndarray, rows: np.ndarray, vectors: _Vectors) -> None:
        order = np.lexsort((vectors.rank[rows], -scores))[: self.top]
        keys = [vectors.keys[int(r)].as_py() for r in rows[order]]
        new = [(-int(s), k is None, k) for s, k in zip(scores[order], keys, strict=True)]
        # Null keys are equal, so no null is compared with another.
        held = sorted(self.entries[q] + new, key=lambda e: e[:2] if e[1] else e)[: self.top]
        self.entries[q] = held
        if len(held) == self.top:
            self.bounds[q] = max(self.bounds[q], -held[-1][0])


def _search(vectors: _Vectors, queries: _Queries, best: _Best, alive: np.ndarray) -> None:
    """Hold all buckets of ``vectors`` against the queries."""
    n = len(vectors.norms)
    order = alive
    for low in range(0, n, queries.bucket):
        high = min(n, low + queries.bucket)
        # Cauchy-Schwarz: the longest vector of the bucket cannot reach the bound.
        norms = np.array([queries.norms[q] for q in order]) * vectors.norms[low]
        order = order[norms >= best.bounds[order]] if len(order) else order
        if not len(order):
            return
        at, until = vectors.first[low], vectors.first[high]
        terms, values = vectors.terms[at:until], vectors.values[at:until]
        rows = np.repeat(np.arange(high - low), np.diff(vectors.first[low : high + 1]))
        by_term = np.argsort(terms, kind="stable")
        lists = np.searchsorted(terms[by_term], np.arange(queries.width + 1))
        list_rows, list_values = rows[by_term], values[by_term]
        lengths = vectors.norms[low:high]
        weight_of = np.zeros(queries.width, dtype=np.int64)
        starts = vectors.first[low : high + 1] - at
        for q in order:
            bound = best.bounds[q]
            # Only vectors that are long enough, the first ones of the bucket.
            long_enough = int(np.searchsorted(-lengths, -(bound / queries.norms[q]), side="right"))
            if not long_enough:
                continue
            part = np.zeros(long_enough)
            squares = np.zeros(long_enough)
            for term, weight in zip(queries.terms[q][:FOCUS], queries.weights[q][:FOCUS], strict=True):
                where = slice(lists[term], lists[term + 1])
                hit = list_rows[where]
                stop = np.searchsorted(hit, long_enough)
                hit, value = hit[:stop], list_values[where][:stop].astype(float)
                part[hit] += weight * value
                squares[hit] += value * value
            left = np.sqrt(np.maximum(0.0, lengths[:long_enough] ** 2 - squares * (1 - 1e-9)))
            upper = (part + left * queries.rest[q]) * SLACK
            chosen = np.flatnonzero((upper >= bound) & (upper > 0))
            if not len(chosen):
                continue
            weight_of[queries.terms[q]] = queries.weights[q]
            sizes = starts[chosen + 1] - starts[chosen]
            ends = np.cumsum(sizes)
            entries = np.repeat(starts[chosen] - (ends - sizes), sizes) + np.arange(ends[-1])
            running = np.concatenate([[0], np.cumsum(weight_of[terms[entries]] * values[entries])])
            scores = running[ends] - running[ends - sizes]
            weight_of[queries.terms[q]] = 0
            good = (scores > 0) & (scores >= bound)
            if good.any():
                best.add(q, scores[good], low + chosen[good], vectors)


def _searcher(queries: _Queries, bounds: np.ndarray, top: int, lead: int | None):
    """Best entries of a task; with ``lead`` only of its longest vectors of each held part."""

    def run(batches):
        best = _Best(bounds, top)
        key_type = None
        alive = np.flatnonzero(np.array(queries.norms) > 0)

        def search(held):
            vectors = _Vectors(held, queries)
            if lead is not None:
                vectors.norms = vectors.norms[:lead]
            _search(vectors, queries, best, alive)

        held, rows, terms = [], 0, 0
        for batch in batches:
            key_type = batch.schema.field("key").type
            held.append(batch)
            rows += batch.num_rows
            terms += len(batch.column("terms").flatten())
            if rows >= HELD_ROWS or terms >= HELD_TERMS:
                search(held)
                held, rows, terms = [], 0, 0
        if held:
            search(held)
        flat = [(q, -e[0], e[2]) for q, entries in enumerate(best.entries) for e in entries]
        if flat:
            number, scores, keys = zip(*flat, strict=True)
            yield pa.record_batch(
                {
                    "query": pa.array(queries.queries[list(number)]),
                    "score": pa.array(scores, pa.int64()),
                    "key": pa.array(keys, key_type),
                }
            )

    return run


def _search_block(docs: DataFrame, block: pa.Table, key_type: str, top: int) -> DataFrame:
    """Stored: query, score, key, rank of the best documents of a block of queries."""
    vocabulary = Vocabulary(block)
    schema = f"key {key_type}, n long, terms array<int>, tf array<int>"
    vectors = docs.mapInArrow(_vectorise(vocabulary), schema).filter("n > 0")
    vectors = stored(vectors, "vectors")
    counted = vectors.select("n", "terms").mapInArrow(_document_counts, "term int, count long")
    # At most as many rows as the block has terms.
    counted = dict(
        tuple(r) for r in counted.groupBy("term").agg(F.sum("count").alias("count")).collect()
    )
    documents, total = counted.get(-1, 0), counted.get(-2, 0)
    weights = np.array(
        [
            int(1000 * log((2 * documents + 2) / (2 * counted.get(t, 0) + 1)))
            for t in range(len(vocabulary.hashes))
        ],
        dtype=np.int64,
    )
    queries = _Queries(vocabulary, weights, documents, max(total, 1))
    vectors = vectors.filter(F.size("terms") > 0)
    schema = f"query long, score long, key {key_type}"
    none = np.zeros(len(queries.queries), dtype=np.int64)
    lead = vectors.mapInArrow(_searcher(queries, none, top, LEAD), schema)
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))
    # One row for each query of the block.
    lead = lead.withColumn("place", place).filter(F.col("place") == top)
    found = {r.query: r.score for r in lead.select("query", "score").collect()}
    bounds = np.array([found.get(int(q), 0) for q in queries.queries], dtype=np.int64)
    best = vectors.mapInArrow(_searcher(queries, bounds, top, None), schema)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return stored(ranked, "ranked")


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    top: int = TOP,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """The ``top`` documents of each item: item, rank (from 1), key, score (above 0)."""
    queries = query_terms(items, item_text, item_id)
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    key_type = dict(docs.dtypes)[key]
    schema = f"query long, score long, key {key_type}, rank int"
    found = docs.sparkSession.createDataFrame([], schema)
    for block in query_blocks(queries, block_terms):
        found = found.unionByName(_search_block(narrow, block, key_type, top))
    return found.join(queries.select("query", "item"), "query").select("item", "rank", "key", "score")
