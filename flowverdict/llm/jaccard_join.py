"""N-gram Jaccard self-join with Bayesian candidate pruning, and near-duplicate classes.

Documents are sets of five-word shingles; two are linked if the Jaccard similarity of their
sets is at least 0.8.

1. One pass over the texts gives each document a digest of its set and 128 MinHash values of
   16 bits.  Documents of equal sets are one node, represented by its first document.
2. Nodes that share one of 20 bands of four values are candidates (a pair at 0.8 shares none
   with probability 3 in 100,000).  Buckets are cut into blocks of bounded size, and a task
   compares two blocks: MinHash values are read 16 at a time, and a pair is dropped as soon
   as the posterior probability (uniform prior) that its similarity reaches the threshold
   falls below ``TOLERANCE``.  What survives is recorded as a spanning forest of each block
   pair, at most one row per member, never as a list of pairs.
3. Connected components of these forests are the clusters to verify.  Only the texts of
   clustered nodes are fetched; blocks of a cluster meet pair by pair, all pairs of a block
   pair are pruned as before, and the rest are verified exactly on the shingle sets.
4. Verified links are counted per node inside the tasks and again kept as spanning forests,
   whose components are the classes.

So no link between different texts is lost to a cap, and the rows between stages stay linear
in the members of a block pair.  Within one cluster the comparisons are those of all its
pairs, made in blocks in numpy.

Null texts count as empty; documents without words have no links, and only those of equal
texts are of one class.  Repeated
rows and equal texts are copies within a node: they get the class of the node and its number
of links, which counts linked nodes, not copies.  Extra columns are ignored by
``near_duplicates`` and kept by ``keep_one_of_each``.  Null keys rank after all others.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowverdict.llm.components import connected_components
from flowverdict.llm.tables import broadcast_if_small, whole_groups
from flowverdict.llm.text import shingles_of, text_chunks
from flowverdict.sources.scratch import stored

THRESHOLD = 0.8
HASHES = 128
BANDS, BAND_ROWS = 20, 4
STEP = 16
TOLERANCE = 1e-6
# Members of a block; a task compares two blocks at a time.
BUCKET_BLOCK = 256
VERIFY_BLOCK = 128
# Pairs compared at a time.
PAIRS = 1 << 16
# Columns of an incidence matrix.
COLUMNS = 1 << 13
_FACTORS = np.random.default_rng(20_240_502).integers(
    1 << 62, size=HASHES, dtype=np.uint64
) * np.uint64(2) + np.uint64(1)


# -- sketches ------------------------------------------------------------------------------

def minhash(shingles: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """(rows, 128) values of 16 bits; rows without shingles get zeros."""
    out = np.zeros((len(begin) - 1, HASHES), dtype=np.uint16)
    some = np.flatnonzero(np.diff(begin))
    if len(some):
        scratch = np.empty_like(shingles)
        for i, factor in enumerate(_FACTORS):
            np.multiply(shingles, factor, out=scratch)
            least = np.minimum.reduceat(scratch, begin[some])
            # High bits of a minimum are small; the middle ones are uniform.
            out[some, i] = (least >> np.uint64(24)) & np.uint64(0xFFFF)
    return out


def set_digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(np.unique(shingles).tobytes())


def _sketch(batches):
    for batch in batches:
        texts = batch.column("text")
        for low, high in text_chunks(texts):
            shingles, begin = shingles_of(texts.slice(low, high - low))
            values = minhash(shingles, begin)
            bounds = list(zip(begin[:-1], begin[1:], strict=True))
            yield pa.record_batch(
                {
                    "key": batch.column("key").slice(low, high - low),
                    "text_hash": batch.column("text_hash").slice(low, high - low),
                    "node": pa.array([set_digest(shingles[a:b]) for a, b in bounds]),
                    "n": pa.array(np.diff(begin), pa.int64()),
                    "values": pa.array([v.tobytes() for v in values]),
                }
            )


def text_hash(text: Column) -> Column:
    """Tells rows of one key apart when texts are fetched."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def sketches(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Stored: key, text_hash, node (digest of the set), n shingles, MinHash values."""
    narrow = docs.select(
        F.col(key).alias("key"), F.col(text).alias("text"), text_hash(F.col(text)).alias("text_hash")
    )
    key_type = dict(docs.dtypes)[key]
    schema = f"key {key_type}, text_hash long, node binary, n long, values binary"
    return stored(narrow.mapInArrow(_sketch, schema), "sketches")


# -- pruning -------------------------------------------------------------------------------

def least_matches(threshold: float, tolerance: float) -> np.ndarray:
    """For each multiple of STEP values: the fewest matches that keep a pair.

    With a uniform prior the posterior after m of n matches is Beta(m + 1, n - m + 1); its
    mass above the threshold is the chance of at most m successes in n + 1 trials.
    """
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        mass, m = 0.0, -1
        while mass < tolerance and m < n:
            m += 1
            mass += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return np.array(out)


def surviving(values: np.ndarray, a: np.ndarray, b: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Which of the pairs the values of rows ``a`` and ``b`` do not rule out."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), dtype=np.int64)
    for i, needed in enumerate(least):
        part = slice(i * STEP, (i + 1) * STEP)
        matches = matches + (values[a[alive], part] == values[b[alive], part]).sum(axis=1)
        keep = matches >= needed
        alive, matches = alive[keep], matches[keep]
        if not len(alive):
            break
    return alive


def group_pairs(starts: np.ndarray, sizes: np.ndarray, side: np.ndarray):
    """Pairs of rows of each group, in slices.

    ``side`` 0 marks a group that is one block; in others rows of side 1 meet those of side 2.
    """
    for size in np.unique(sizes[sizes > 1]):
        i, j = np.triu_indices(size, 1)
        begin = starts[sizes == size]
        per = max(1, PAIRS // len(i))
        for low in range(0, len(begin), per):
            at = begin[low : low + per, None]
            a, b = (at + i).ravel(), (at + j).ravel()
            keep = (side[a] == 0) | (side[a] != side[b])
            yield a[keep], b[keep]


def roots_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least row of each row's component of the pairs."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        for end in (a, b):
            np.minimum.at(root, before[end], low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        if (root == before).all():
            break
    return root


def _with_size(members: DataFrame, group: str) -> DataFrame:
    """Members of groups of at least two, with the number of members."""
    sizes = members.groupBy(group).agg(F.count(F.lit(1)).alias("size"))
    return members.join(sizes.filter("size > 1"), group)


def _block_pairs(members: DataFrame, group: str, block: int, pair) -> DataFrame:
    """Each member once for each pair of blocks of its group that its block takes part in.

    Adds ``pair``, which names group and blocks, and ``side`` (see ``group_pairs``).
    """
    blocks = F.ceil(F.col("size") / F.lit(block))
    out = members.withColumn("own", F.pmod(F.xxhash64("node"), blocks))
    out = out.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1)
    return out.withColumns(
        {
            "pair": pair(F.col(group), F.least("own", "other"), F.greatest("own", "other")),
            "side": side.otherwise(2),
        }
    ).drop(group, "size", "own", "other")


def _arrays(table: pa.Table):
    """Group starts and sizes, sides and MinHash values of sorted rows."""
    pair = table["pair"].combine_chunks()
    codes = pair.dictionary_encode().indices.to_numpy()
    starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    sizes = np.diff(np.append(starts, len(codes)))
    side = table["side"].to_numpy()
    values = np.frombuffer(b"".join(table["values"].to_pylist()), dtype=np.uint16)
    return starts, sizes, side, values.reshape(-1, HASHES)


def _edges_of(nodes: pa.Array, root: np.ndarray) -> dict:
    child = np.flatnonzero(root != np.arange(len(root)))
    return {"a": nodes.take(pa.array(child)), "b": nodes.take(pa.array(root[child]))}


def _candidate_forest(least: np.ndarray):
    def run(batches):
        for table in whole_groups(batches, "pair"):
            starts, sizes, side, values = _arrays(table)
            kept = [(np.zeros(0, np.int64),) * 2]
            for a, b in group_pairs(starts, sizes, side):
                alive = surviving(values, a, b, least)
                kept.append((a[alive], b[alive]))
            a, b = (np.concatenate(x) for x in zip(*kept, strict=True))
            edges = _edges_of(table["node"].combine_chunks(), roots_of(len(values), a, b))
            yield pa.record_batch(edges)

    return run


# -- verification --------------------------------------------------------------------------

def _shared_of_pairs(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections, pair by pair."""
    out = np.zeros(len(a), dtype=np.int64)
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        merged = np.concatenate([sets[x], sets[y]])
        merged.sort(kind="stable")
        out[i] = (merged[1:] == merged[:-1]).sum()
    return out


def _shared_by_matrix(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections for many pairs of few rows, by incidence matrices."""
    rows, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    members = np.concatenate([sets[r] for r in rows])
    owner = np.repeat(np.arange(len(rows)), [len(sets[r]) for r in rows])
    _, column, count = np.unique(members, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(count > 1)
    number = np.full(len(count), -1)
    number[shared] = np.arange(len(shared))
    column = number[column]
    common = np.zeros((len(rows), len(rows)), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for low in range(0, len(shared), COLUMNS):
        part = slice(*np.searchsorted(column, [low, low + COLUMNS]))
        incidence = np.zeros((len(rows), COLUMNS), dtype=np.float32)
        incidence[owner[part], column[part] - low] = 1
        common += incidence @ incidence.T
    return common[at[: len(a)], at[len(a) :]].astype(np.int64)


def exact_links(
    sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, threshold: float
) -> np.ndarray:
    """Which of the pairs of sorted distinct shingle arrays reach the threshold."""
    sizes = np.array([len(s) for s in sets])
    total = sizes[a] + sizes[b]
    out = np.minimum(sizes[a], sizes[b]) >= threshold * np.maximum(sizes[a], sizes[b])
    some = np.flatnonzero(out)
    few_rows = len(sets) <= 4 * VERIFY_BLOCK and len(some) > 4 * len(sets)
    count = _shared_by_matrix if few_rows else _shared_of_pairs
    if len(some):
        shared = count(sets, a[some], b[some])
        out[some] = shared >= threshold * (total[some] - shared)
    return out


def distinct_shingles(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingles of each text."""
    out = []
    for low, high in text_chunks(texts):
        hashes, begin = shingles_of(texts.slice(low, high - low))
        out += [np.unique(hashes[x:y]) for x, y in zip(begin[:-1], begin[1:], strict=True)]
    return out


def _verified(least: np.ndarray, threshold: float):
    def run(batches):
        for table in whole_groups(batches, "pair", least_rows=512):
            starts, sizes, side, values = _arrays(table)
            own = distinct_shingles(table["text"].combine_chunks())
            links = np.zeros(len(values), dtype=np.int64)
            kept = [(np.zeros(0, np.int64),) * 2]
            for a, b in group_pairs(starts, sizes, side):
                alive = surviving(values, a, b, least)
                a, b = a[alive], b[alive]
                linked = exact_links(own, a, b, threshold)
                a, b = a[linked], b[linked]
                np.add.at(links, a, 1)
                np.add.at(links, b, 1)
                kept.append((a, b))
            a, b = (np.concatenate(x) for x in zip(*kept, strict=True))
            root = roots_of(len(values), a, b)
            nodes = table["node"].combine_chunks()
            some = np.flatnonzero(links)
            yield pa.record_batch(
                {
                    "a": nodes.take(pa.array(some)),
                    "b": nodes.take(pa.array(root[some])),
                    "links": pa.array(links[some]),
                }
            )

    return run


def _grouped(members: DataFrame, run, schema: str) -> DataFrame:
    ordered = members.repartition("pair").sortWithinPartitions("pair")
    return ordered.mapInArrow(run, schema)


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """One row per document: key, class_key (its least key), n_links, text_hash, class."""
    least = least_matches(threshold, tolerance)
    rows = sketches(docs, text, key)
    nodes = rows.filter("n > 0").groupBy("node").agg(
        F.min(F.struct(F.col("key").isNull(), "key", "text_hash")).alias("first"),
        F.any_value("values").alias("values"),
    )
    nodes = stored(nodes.select("node", "first.key", "first.text_hash", "values"), "nodes")

    width = 2 * BAND_ROWS  # bytes of a band
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.xxhash64(i, F.substring("values", i * width + 1, F.lit(width))),
    )
    buckets = _with_size(nodes.select("node", F.explode(bands).alias("bucket")), "bucket")
    # Buckets or block pairs of one hash only meet more candidates.
    pairs = _block_pairs(buckets, "bucket", BUCKET_BLOCK, F.xxhash64)
    forest = _grouped(
        pairs.join(nodes.select("node", "values"), "node"),
        _candidate_forest(least),
        "a binary, b binary",
    )
    clusters = connected_components(forest, "a", "b")
    heads = clusters.select(F.col("component").alias("node"), "component").distinct()
    clusters = _with_size(clusters.unionByName(heads), "component")
    wanted = clusters.join(nodes.drop("values"), "node")
    wanted = broadcast_if_small(stored(wanted, "clusters"))
    texts = docs.select(
        F.col(key).alias("__key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        text_hash(F.col(text)).alias("__hash"),
    )
    clustered = texts.join(
        wanted,
        F.col("key").eqNullSafe(F.col("__key")) & (F.col("text_hash") == F.col("__hash")),
    ).dropDuplicates(["node"])
    clustered = clustered.select("node", "component", "size", "text").join(
        nodes.select("node", "values"), "node"
    )
    clustered = stored(clustered, "clustered")

    def named(component: Column, low: Column, high: Column) -> Column:
        return F.concat_ws(":", F.hex(component), low.cast("string"), high.cast("string"))

    verified = _grouped(
        _block_pairs(clustered, "component", VERIFY_BLOCK, named),
        _verified(least, threshold),
        "a binary, b binary, links long",
    )
    verified = stored(verified, "verified")
    links = verified.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("n_links"))
    classes = connected_components(verified, "a", "b")
    found = (
        rows.join(links, "node", "left")
        .join(classes, "node", "left")
        .withColumn("class", F.coalesce("component", "node"))
    )
    # All texts without words have the empty set, but are copies only if they are equal.
    own = F.concat("node", F.unhex(F.hex("text_hash")))
    found = found.withColumn("class", F.when(F.col("n") == 0, own).otherwise(F.col("class")))
    least_key = found.groupBy("class").agg(F.min("key").alias("class_key"))
    return found.join(least_key, "class").select(
        "key", "class_key", F.coalesce("n_links", F.lit(0)).alias("n_links"), "text_hash", "class"
    )


def keep_one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose key is the least of their class, one for each class.

    Only keys and hashes of rows that go, or that are repeated, travel to the documents.
    """
    found = stored(near_duplicates(docs, text, key, **options), "classes")
    rank = F.struct(F.col("key").isNull(), "key", "text_hash")
    best = found.groupBy("class").agg(F.min(rank).alias("best"))
    rows = found.groupBy("class", "key", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.join(best, "class").withColumn("goes", rank != F.col("best"))
    # A row that occurs in several classes has one text, hence one class.
    marked = rows.filter("goes OR copies > 1").select("key", "text_hash", "goes")
    marked = broadcast_if_small(stored(marked, "marked"))
    joined = docs.withColumns({"__hash": text_hash(F.col(text))}).join(
        marked.withColumnsRenamed({"key": "__key", "text_hash": "__text_hash", "goes": "__goes"}),
        F.col(key).eqNullSafe(F.col("__key")) & (F.col("__hash") == F.col("__text_hash")),
        "left",
    )
    once = joined.filter("__goes IS NULL")
    repeated = joined.filter("NOT __goes").dropDuplicates(["__key", "__hash"])
    return once.unionByName(repeated).select(*[F.col(f"`{c}`") for c in docs.columns])
