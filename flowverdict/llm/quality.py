"""Quality classifier with hierarchical empirical Bayes over hosts and paths.

1. Two logistic heads (low quality, toxic) are fitted in numpy on at most ``SAMPLE`` labelled
   documents, those of the smallest key hashes; whole texts are read.  Features are the words
   whose presence differs significantly between the classes (at most ``MOST_SLOTS`` a head,
   chosen by a grouped count, so that only they reach the driver), and quantile bins of shape
   measures (share of capitals, of symbols, of repeated and of distinct words, ...).
2. Evidence of a document is the log-odds of being bad by the heads alone.
3. One grouped aggregate over all documents sums the bad probability by host and path.  A
   host's posterior is shrunk toward the global share, a path's toward its host's, each with
   the prior strength that the method of moments finds in the spread of the groups, so a
   site with few documents says little.
4. A document's score is its evidence plus the log-odds of its path's posterior relative to
   the global share; it is bad from ``THRESHOLD`` on.

Null texts count as empty, null hosts and paths as empty strings.  Labels that are null in a
head are left out of it; repeated label rows count repeatedly, labels without a document and
documents without a label are fine.  A head that sees one class only (or no label) answers
with its smoothed share.  Repeated rows are scored alike.  Extra columns stay in
``keep_good``; its own helper columns are prefixed, and no output name can clash.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowverdict.llm.tables import broadcast_if_small
from flowverdict.llm.text import text_chunks, word_hashes
from flowverdict.sources.scratch import stored

SAMPLE = 16_384
THRESHOLD = 0.5
SLOT_BITS = 18
LEAST_Z, LEAST_ROWS, MOST_SLOTS = 4.5, 3, 4096
BINS = 12
STEPS, RATE, RIDGE = 800, 0.1, 1e-5
SYMBOLS = b"|$%&#*!=~^<>_{}[]@\\+"


# -- features ------------------------------------------------------------------------------

def _share_of(data: np.ndarray, offsets: np.ndarray, members: bytes) -> np.ndarray:
    is_member = np.zeros(256, dtype=bool)
    is_member[list(members)] = True
    running = np.concatenate([[0], np.cumsum(is_member[data])])
    return (running[offsets[1:]] - running[offsets[:-1]]) / np.maximum(1, np.diff(offsets))


def _raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, word slot) pairs as two arrays, and the shape measures of each row."""
    hashes, first = word_hashes(column)
    n_words = np.diff(first)
    rows = np.repeat(np.arange(len(n_words)), n_words)
    slots = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    pairs = np.unique(rows << SLOT_BITS | slots)
    distinct = np.bincount(pairs >> SLOT_BITS, minlength=len(n_words))
    same = np.zeros(len(hashes))
    same[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    repeated = np.bincount(rows, weights=same, minlength=len(n_words))
    data, offsets = _raw_bytes(column)
    length, words = np.diff(offsets), np.maximum(1, n_words)
    shapes = np.stack(
        [
            _share_of(data, offsets, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
            _share_of(data, offsets, SYMBOLS),
            _share_of(data, offsets, b"0123456789"),
            _share_of(data, offsets, b"\n"),
            repeated / words,
            distinct / words,
            np.log1p(length),
            length / words,
        ],
        axis=1,
    )
    return pairs >> SLOT_BITS, pairs & ((1 << SLOT_BITS) - 1), shapes


# -- heads ---------------------------------------------------------------------------------

class Head(NamedTuple):
    """Log-odds: ``bias`` + ``words[slot]`` of the words present + the bins of the shapes."""

    bias: float
    words: np.ndarray
    edges: np.ndarray
    bins: np.ndarray

    def log_odds(self, rows: np.ndarray, slots: np.ndarray, shapes: np.ndarray) -> np.ndarray:
        out = np.bincount(rows, weights=self.words[slots], minlength=len(shapes)) + self.bias
        return out + self.bins[bin_of(shapes, self.edges), np.arange(shapes.shape[1])].sum(axis=1)


def bin_of(shapes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The quantile bin of each measure; ``edges`` has a row of inner bounds per measure."""
    return (shapes[:, :, None] > edges[None]).sum(axis=2)


def fit_head(
    rows: np.ndarray, slots: np.ndarray, chosen: np.ndarray, shapes: np.ndarray, bad: np.ndarray
) -> Head:
    """Logistic regression by Adam on the chosen word slots (sorted) and binned shapes."""
    n, n_bad = len(bad), int(bad.sum())
    measures = shapes.shape[1] if shapes.ndim == 2 else 0
    words = np.zeros(1 << SLOT_BITS)
    bias = float(np.log((n_bad + 0.5) / (n - n_bad + 0.5)))
    edges = np.zeros((measures, BINS - 1))
    bins = np.zeros((BINS, measures))
    if n_bad == 0 or n_bad == n:
        return Head(bias, words, edges, bins)
    edges = np.quantile(shapes, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T.copy()
    number = np.full(len(words), -1, dtype=np.int32)
    number[chosen] = np.arange(len(chosen))
    use = number[slots] >= 0
    rows, columns = rows[use], number[slots[use]]
    # Words first, then one column for each bin of each measure, then the bias.
    binned = bin_of(shapes, edges) + np.arange(measures) * BINS + len(chosen)
    rows = np.concatenate([rows, np.repeat(np.arange(n, dtype=np.int32), measures)])
    columns = np.concatenate([columns, binned.ravel().astype(np.int32)])
    width = len(chosen) + BINS * measures
    weights, first, second = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    weights[-1] = bias
    for step in range(1, STEPS + 1):
        odds = np.bincount(rows, weights=weights[columns], minlength=n) + weights[-1]
        error = 1 / (1 + np.exp(-odds)) - bad
        slope = np.append(np.bincount(columns, weights=error[rows], minlength=width), error.sum())
        slope = slope / n + RIDGE * weights
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        weights -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    words[chosen] = weights[: len(chosen)]
    bins = weights[len(chosen) : -1].reshape(measures, BINS).T
    return Head(float(weights[-1]), words, edges, bins)


def _feature_rows(batches):
    for batch in batches:
        texts = batch.column("text")
        for low, high in text_chunks(texts):
            rows, slots, shapes = features(texts.slice(low, high - low))
            bounds = np.searchsorted(rows, np.arange(high - low + 1)).astype(np.int32)
            yield pa.record_batch(
                {
                    "quality": batch.column("quality").slice(low, high - low),
                    "toxic": batch.column("toxic").slice(low, high - low),
                    "slots": pa.ListArray.from_arrays(bounds, slots.astype(np.int32)),
                    "shapes": pa.array(list(shapes), pa.list_(pa.float64())),
                }
            )


def _only(slots: np.ndarray):
    """Rows of features with the given slots only."""
    member = np.zeros(1 << SLOT_BITS, dtype=bool)
    member[slots] = True

    def run(batches):
        for batch in batches:
            lists = batch.column("slots")
            flat = lists.flatten().to_numpy()
            kept = member[flat]
            running = np.concatenate([[0], np.cumsum(kept)])
            offsets = lists.offsets.to_numpy()
            bounds = pa.array(running[offsets - offsets[0]].astype(np.int32))
            own = pa.ListArray.from_arrays(bounds, pa.array(flat[kept]))
            yield pa.record_batch([*batch.columns[:2], own, batch.column("shapes")], batch.schema.names)

    return run


def significant_slots(features: DataFrame, name: str, bad_value: int) -> np.ndarray:
    """The word slots whose presence differs between the classes of a label, sorted.

    Counted by a grouped aggregate; the driver gets the chosen slots, ``MOST_SLOTS`` at most
    (those of the largest differences).
    """
    known = features.filter(F.col(name).isNotNull())
    bad = (F.col(name) == bad_value).cast("long")
    n, n_bad = known.agg(F.count("*"), F.coalesce(F.sum(bad), F.lit(0))).first()
    if n_bad in (0, n):
        return np.zeros(0, dtype=np.int64)
    counts = known.select(F.explode("slots").alias("slot"), bad.alias("bad")).groupBy("slot")
    counts = counts.agg(F.count("*").alias("in_all"), F.sum("bad").alias("in_bad"))
    share = F.col("in_all") / n
    spread = F.sqrt(share * (1 - share) * (1 / n_bad + 1 / (n - n_bad))) + 1e-12
    z = (F.col("in_bad") / n_bad - (F.col("in_all") - F.col("in_bad")) / (n - n_bad)) / spread
    chosen = counts.select("slot", "in_all", F.abs(z).alias("z"))
    chosen = chosen.filter((F.col("z") >= LEAST_Z) & (F.col("in_all") >= LEAST_ROWS))
    chosen = chosen.orderBy(F.desc("z"), "slot").limit(MOST_SLOTS)
    return np.sort(chosen.select("slot").toArrow()["slot"].to_numpy())


def train_heads(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    sample: int = SAMPLE,
) -> list[Head]:
    """Heads for low quality and toxicity.

    The driver gets no texts: for each labelled row its chosen slots as 32-bit integers and
    eight measures.
    """
    chosen = labels.select(
        F.col(key).alias("key"), F.col("quality").cast("int"), F.col("toxic").cast("int")
    ).filter("key IS NOT NULL")
    chosen = chosen.orderBy(F.xxhash64("key"), "key", "quality", "toxic").limit(sample)
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    # At most ``sample`` label rows; a repeated key brings its documents, up to the same bound.
    joined = texts.join(F.broadcast(chosen), "key").select("text", "quality", "toxic")
    schema = "quality int, toxic int, slots array<int>, shapes array<double>"
    rows = stored(joined.mapInArrow(_feature_rows, schema).limit(sample), "features")
    heads = [("quality", 0), ("toxic", 1)]
    slots_of = {name: significant_slots(rows, name, bad) for name, bad in heads}
    wanted = np.unique(np.concatenate(list(slots_of.values())))
    got = rows.mapInArrow(_only(wanted), schema).toArrow().combine_chunks()
    lists = got["slots"].combine_chunks()
    n = got.num_rows
    flat = lists.flatten().to_numpy().astype(np.int32) if n else np.zeros(0, np.int32)
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy() if n else np.zeros(0, int)
    owner = np.repeat(np.arange(n, dtype=np.int32), sizes)
    shapes = got["shapes"].combine_chunks().flatten().to_numpy() if n else np.zeros(0)
    shapes = shapes.reshape(n, -1 if n else 0)
    labelled = {name: got[name].to_pylist() for name, _ in heads}
    del got, lists
    found = []
    for name, bad_value in heads:
        label = np.array([-1 if v is None else v for v in labelled[name]], dtype=int)
        known = label >= 0
        number = (np.cumsum(known) - 1).astype(np.int32)
        use = known[owner]
        bad = (label[known] == bad_value).astype(float)
        found.append(fit_head(number[owner[use]], flat[use], slots_of[name], shapes[known], bad))
    return found


def evidence_column(heads: list[Head], text: Column) -> Column:
    """Log-odds that a document is bad (low quality or toxic) by its text alone."""

    @F.arrow_udf("double")
    def evidence(texts: pa.Array) -> pa.Array:
        out = []
        for low, high in text_chunks(texts):
            found = features(texts.slice(low, high - low))
            good = np.zeros(high - low)  # log probability that no head objects
            for head in heads:
                odds = head.log_odds(*found) if found[2].shape[1] == len(head.edges) else head.bias
                good = good - np.logaddexp(0, odds)
            bad = np.log(-np.expm1(np.minimum(good, -1e-12)))
            out.append(bad - good)
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return evidence(text)


# -- sites ---------------------------------------------------------------------------------

def _log_odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, share: str) -> Column:
    """Prior strength by the method of moments, from groups (n, bad) around ``share``.

    The weighted spread of the groups' shares beyond what sampling explains is the variance
    of a beta prior with this strength.
    """
    p, n = F.col(share), F.col("n")
    spread = F.sum(n * F.pow(F.col("bad") / n - p, 2)) / F.sum(n)
    sampling = F.sum(p * (1 - p)) / F.sum(n)
    variance = F.greatest(spread - sampling, F.lit(1e-6))
    mean = F.sum(F.col("bad")) / F.sum(n)
    return F.greatest(F.lit(1.0), mean * (1 - mean) / variance - 1)


def site_posteriors(scored: DataFrame) -> DataFrame:
    """Posterior bad shares of rows (host, path, p): host, path, n, global, host and path share.

    Only grouped aggregates; the strengths are two numbers.
    """
    paths = stored(
        scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("bad")),
        "paths",
    )
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    total, bad = paths.agg(F.sum("n"), F.sum("bad")).first()
    share = min(max((bad or 0.0) / (total or 1), 1e-6), 1 - 1e-6)
    hosts = hosts.withColumn("share", F.lit(share))
    strength = hosts.agg(_strength(hosts, "share")).first()[0] or 1.0
    hosts = hosts.select(
        "host",
        ((F.col("bad") + strength * share) / (F.col("n") + strength)).alias("host_share"),
    )
    paths = paths.join(hosts, "host")
    within = paths.agg(_strength(paths, "host_share")).first()[0] or 1.0
    posterior = (F.col("bad") + within * F.col("host_share")) / (F.col("n") + within)
    return paths.select(
        "host", "path", "n", F.lit(share).alias("share"), "host_share", posterior.alias("path_share")
    )


def _with_scores(
    docs: DataFrame, labels: DataFrame, text: str, key: str, host: str, path: str, sample: int
) -> DataFrame:
    heads = train_heads(docs, labels, text, key, sample)
    site = {
        "__host": F.coalesce(F.col(host).cast("string"), F.lit("")),
        "__path": F.coalesce(F.col(path).cast("string"), F.lit("")),
        "__evidence": evidence_column(heads, F.col(text)),
    }
    marked = docs.withColumns(site)
    p = 1 / (1 + F.exp(-F.col("__evidence")))
    sites = site_posteriors(
        marked.select(F.col("__host").alias("host"), F.col("__path").alias("path"), p.alias("p"))
    )
    sites = stored(sites, "sites").select(*[F.col(c).alias(f"__{c}") for c in sites.columns])
    shift = _log_odds(F.col("__path_share")) - _log_odds(F.col("__share"))
    scored = marked.join(broadcast_if_small(sites), ["__host", "__path"])
    return scored.withColumn("__score", 1 / (1 + F.exp(-(F.col("__evidence") + shift))))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    host: str = "source",
    path: str = "lang",
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per document: key, host, path, evidence, posteriors, score (bad), kept."""
    scored = _with_scores(docs, labels, text, key, host, path, sample)
    return scored.select(
        F.col(key).alias("key"),
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        F.col("__evidence").alias("evidence"),
        F.col("__host_share").alias("host_share"),
        F.col("__path_share").alias("path_share"),
        F.col("__score").alias("score"),
        (F.col("__score") < threshold).alias("kept"),
    )


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    host: str = "source",
    path: str = "lang",
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
) -> DataFrame:
    """The rows of ``docs`` that are not bad, all columns."""
    scored = _with_scores(docs, labels, text, key, host, path, sample)
    kept = scored.filter(F.col("__score") < threshold)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
