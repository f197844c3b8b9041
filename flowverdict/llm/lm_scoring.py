"""Masked pseudo-likelihood: every word is predicted from both sides, the sum scores a text.

1. Vocabulary: the words of the whole corpus are counted (per task, then by a shuffle on the
   word hash).  The vocabulary has room for all of them up to ``MAX_VOCABULARY`` ids (from
   ``VOCABULARY`` up, four times as many each time); the most frequent get ids in order of
   frequency, others share ``UNKNOWN`` ids by hash.  Ids are split into a class and a member,
   64 by 64 (128 by 128), so a softmax over the vocabulary is two softmaxes of 64 (128).
   The bound keeps a task's model and its squares below 10 MB.
2. Network: the ``SIDE`` words before and after a position are embedded, each weighted by a
   vector for its place, and summed; a tanh layer gives the state that predicts the class
   and, together with an embedding of the class, the member.  The word itself is masked: it
   is no part of its own context.  Numpy only.
3. Training: every task trains a copy, starting from the same parameters, on every position
   of all its texts (in drawn order); copies are averaged, weighted by positions, in two
   grouped steps over parameter blocks, so what is gathered grows with the input and no task
   holds more than running sums.  The result is a model of fixed size.
4. Scoring is a map over whole texts: log-probabilities of all words are summed.  A word that
   shares its id has the probability of the id times its share of the id's occurrences, from
   the corpus-wide counts: such words leave the map as (row, word, times), are joined with the
   stored counts and summed by row, so no task holds all words.

``score`` without word counts gives a shared id's words the probability of the id, and so does
a word without a count.  Null and empty texts have no words and the score 0 (mean null).  Repeated rows are scored
alike, null keys are kept, extra columns ignored.  An empty corpus leaves the starting model.
A lost task is retrained from the same start on the same rows.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowverdict.llm.text import mix, text_chunks, word_hashes
from flowverdict.sources.scratch import stored

VOCABULARY, MAX_VOCABULARY = 4096, 1 << 14  # squares of the number of classes
UNKNOWN = 512
SIDE, WIDTH = 3, 32
STEPS = np.array([*range(-SIDE, 0), *range(1, SIDE + 1)])  # from a word to its neighbours
BATCH, RATE = 1024, 0.1
SEED = 20_240_503
BLOCK = 4096  # parameters in a row while copies are averaged
SALTS = 16
BUCKETS, UPPER = 1 << 16, np.uint64(48)  # of word hashes, by their upper bits
SCORED = 1024  # words scored at a time
COUNTED = 1 << 19  # rows of counts that a task merges
FEW = 12  # rows of a group that are summed together with those of other groups
LANES = 8  # rows side by side in elementwise loops
PAD = VOCABULARY  # stands before and after a text; the id after the last one
SQUARES = 1e-3  # sums of squared gradients start here
BY_ROW = "embedding", "class_state", "member_bias"  # of which a batch changes some rows


class Parameters(NamedTuple):
    embedding: np.ndarray  # (vocabulary + 1, width)
    places: np.ndarray  # (2 * side, width)
    layer: np.ndarray  # (width, width)
    layer_bias: np.ndarray
    to_class: np.ndarray  # (width, classes)
    class_bias: np.ndarray
    class_state: np.ndarray  # (classes, width)
    to_member: np.ndarray  # (width, members)
    member_bias: np.ndarray  # (classes, members)

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self])

    def from_flat(self, flat: np.ndarray) -> Parameters:
        cuts = np.cumsum([p.size for p in self])[:-1]
        return Parameters(
            *[f.reshape(p.shape).astype(p.dtype) for f, p in zip(np.split(flat, cuts), self, strict=True)]
        )


def initial_parameters(counts: np.ndarray) -> Parameters:
    """Small random weights; the biases start at the smoothed word frequencies."""
    draw = np.random.default_rng(SEED)

    def small(*shape: int) -> np.ndarray:
        return draw.normal(0, 0.1, shape).astype(np.float32)

    classes = members = round(len(counts) ** 0.5)
    table = counts.reshape(classes, members) + 1.0
    of_class = table.sum(axis=1)
    return Parameters(
        small(len(counts) + 1, WIDTH),
        np.ones((2 * SIDE, WIDTH), dtype=np.float32),
        (np.eye(WIDTH) + 0.1 * draw.normal(size=(WIDTH, WIDTH))).astype(np.float32),
        np.zeros(WIDTH, dtype=np.float32),
        small(WIDTH, classes),
        np.log(of_class / of_class.sum()).astype(np.float32),
        small(classes, WIDTH),
        small(WIDTH, members),
        np.log(table / of_class[:, None]).astype(np.float32),
    )


# -- words ---------------------------------------------------------------------------------

class Vocabulary(NamedTuple):
    """Hashes of the known words in order, and their ids."""

    hashes: np.ndarray
    ids: np.ndarray
    counts: np.ndarray

    def encode(self, words: np.ndarray) -> np.ndarray:
        out = len(self.counts) - UNKNOWN + (mix(words) % np.uint64(UNKNOWN)).astype(np.int64)
        # The first hash with the same upper bits, then the ones after it.
        first = np.cumsum(np.bincount(self.hashes >> UPPER, minlength=BUCKETS + 1))
        first = np.concatenate([[0], first])
        bucket = words >> UPPER
        at, end = first.take(bucket), first[1:].take(bucket)
        left = np.flatnonzero(at < end)
        while len(left):
            here = at.take(left)
            same = self.hashes.take(here) == words.take(left)
            out[left[same]] = self.ids.take(here[same])
            at[left] += 1
            left = left[~same]
            left = left[at.take(left) < end.take(left)]
        return out


def _count_words(batches):
    kept: list[tuple] = []
    for batch in batches:
        texts = batch.column("text")
        for low, high in text_chunks(texts):
            hashes, _ = word_hashes(texts.slice(low, high - low))
            kept.append(np.unique(hashes, return_counts=True))
            if sum(len(words) for words, _ in kept) >= COUNTED:
                yield _merged(kept)
                kept = []
    if kept:
        yield _merged(kept)


def _merged(kept: list[tuple]) -> pa.RecordBatch:
    """Rows (word, n) of several lists of words and their counts."""
    words, n = (np.concatenate(x) for x in zip(*kept, strict=True))
    order = np.argsort(words)
    words = words[order]
    begin = np.flatnonzero(np.append(True, words[1:] != words[:-1])[: len(words)])
    n = np.add.reduceat(n[order], begin) if len(words) else n
    return pa.record_batch({"word": pa.array(words[begin].view(np.int64)), "n": pa.array(n)})


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """Stored rows (word, n) of all words of the corpus."""
    narrow = docs.select(F.col(text).alias("text"))
    counted = narrow.mapInArrow(_count_words, "word long, n long").groupBy("word")
    return stored(counted.agg(F.sum("n").alias("n")), "words")


def build_vocabulary(
    docs: DataFrame, text: str = "text", counted: DataFrame | None = None
) -> Vocabulary:
    """Counts over all texts; the driver gets the most frequent words only."""
    counted = count_words(docs, text) if counted is None else counted
    distinct, total = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    size = VOCABULARY
    while size < MAX_VOCABULARY and size - UNKNOWN < distinct:
        size *= 4
    known = size - UNKNOWN
    top = counted.orderBy(F.desc("n"), "word").limit(known).toArrow()
    words = top["word"].to_numpy().view(np.uint64)
    counts = np.zeros(size)
    counts[: len(words)] = top["n"].to_numpy()
    order = np.argsort(words)
    vocabulary = Vocabulary(words[order], np.arange(len(words))[order], counts)
    shared = shared_ids(counted, vocabulary).groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    counts[shared["id"].to_numpy()] = shared["n"].to_numpy()
    return vocabulary


def shared_ids(counted: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(word, n, id) of the words that share an id."""
    least = len(vocabulary.counts) - UNKNOWN

    def run(batches):
        for batch in batches:
            ids = vocabulary.encode(batch.column("word").to_numpy().view(np.uint64))
            yield batch.append_column("id", pa.array(ids, pa.int64())).filter(pa.array(ids >= least))

    return counted.mapInArrow(run, "word long, n long, id long")


def contexts(ids: np.ndarray, first: np.ndarray, at: np.ndarray, pad: int = PAD) -> np.ndarray:
    """(positions, 2 * side) ids around the positions, padded at the ends of their texts."""
    padded, place = _padded(ids, first, pad)
    return padded[place[at][:, None] + STEPS]


def _padded(ids: np.ndarray, first: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``SIDE`` pads before, between and after texts with words; their places."""
    n = np.diff(first)
    place = np.arange(len(ids)) + SIDE * np.repeat(np.cumsum(n > 0), n)
    padded = np.full(len(ids) + SIDE * (int((n > 0).sum()) + 1), pad, dtype=np.int64)
    padded[place] = ids
    return padded, place


# -- the network ---------------------------------------------------------------------------

def _exponentials(
    state: np.ndarray, weights: np.ndarray, bias: np.ndarray, which: np.ndarray | None = None
) -> tuple[np.ndarray | None, np.ndarray, np.ndarray]:
    """The chosen logits, the exponentials of all and their sums, computed in one array.

    The largest logit is taken off all three only where the sums need it.
    """
    out = state @ weights
    if bias.ndim == 1:
        wide = _side_by_side(bias, len(out))
        out.reshape(-1, len(wide))[:] += wide
    else:
        out += bias
    own = None if which is None else _own(out, which)
    ones = np.ones(out.shape[1], dtype=out.dtype)
    with np.errstate(over="ignore"):
        total = np.exp(out, out=out) @ ones
    if not (np.isfinite(total).all() and total.min(initial=1) > 1e-30):
        out = state @ weights + bias
        out -= out.max(axis=1, keepdims=True)
        own = None if which is None else _own(out, which)
        total = np.exp(out, out=out) @ ones
    return own, out, total


def _at(x: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Where the chosen of each row stand in the flat array."""
    return np.arange(0, x.size, x.shape[1]) + which


def _own(x: np.ndarray, which: np.ndarray) -> np.ndarray:
    return x.reshape(-1).take(_at(x, which))


def _d_logits(state, weights, bias, which: np.ndarray) -> np.ndarray:
    """Gradient of the mean negative log-probability of the chosen by the logits."""
    _, out, total = _exponentials(state, weights, bias)
    out *= (1 / (len(out) * total))[:, None]
    out.reshape(-1)[_at(out, which)] -= 1 / len(out)
    return out


def _side_by_side(vectors: np.ndarray, n: int) -> np.ndarray:
    """Vectors repeated for some of ``n`` rows at a time: numpy's loops are longer."""
    return np.concatenate([vectors] * math.gcd(n, LANES), axis=-1)


def _mix(looked: list[np.ndarray], wide: np.ndarray) -> np.ndarray:
    """Weighted sums of the neighbours' embeddings."""
    mixed = looked[0].reshape(-1, wide.shape[1]) * wide[0]
    part = np.empty_like(mixed)
    for rows, place in zip(looked[1:], wide[1:], strict=True):
        mixed += np.multiply(rows.reshape(part.shape), place, out=part)
    return mixed.reshape(looked[0].shape)


def _state(p: Parameters, mixed: np.ndarray) -> np.ndarray:
    state = mixed @ p.layer
    state += p.layer_bias
    return np.tanh(state, out=state)


def _below(p: Parameters, state: np.ndarray, kind: np.ndarray) -> np.ndarray:
    below = p.class_state.take(kind, axis=0)
    below += state
    return np.tanh(below, out=below)


def log_probability(p: Parameters, around: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The log-probability of each word given its context."""
    looked = [p.embedding.take(ids, axis=0) for ids in around.T]
    return _log_probability(p, _state(p, _mix(looked, _side_by_side(p.places, len(word)))), word)


def _log_probability(p: Parameters, state: np.ndarray, word: np.ndarray) -> np.ndarray:
    kind, member = np.divmod(word, p.to_member.shape[1])

    def chosen(state, weights, bias, which) -> np.ndarray:
        own, _, total = _exponentials(state, weights, bias, which)
        return own - np.log(total)

    of_class = chosen(state, p.to_class, p.class_bias, kind)
    below = _below(p, state, kind)
    return of_class + chosen(below, p.to_member, p.member_bias.take(kind, axis=0), member)


class Groups:
    """Rows with the same id, large groups first; ``order`` are the rows by ascending id.

    ``reduceat`` takes a call for each column of each group, and most groups are words that
    stand once or twice in a batch: their first rows are summed together, then the second ones.
    """

    def __init__(self, ids: np.ndarray, order: np.ndarray | None = None):
        begin = np.concatenate([[0], np.flatnonzero(ids[1:] != ids[:-1]) + 1])
        sizes = np.append(begin[1:], len(ids)) - begin
        by_size = np.argsort((len(ids) - sizes).astype(np.min_scalar_type(len(ids))), kind="stable")
        self.begin, self.sizes = begin.take(by_size), sizes.take(by_size)
        self.ids = ids.take(self.begin)
        # How many groups have more than 1, 2, ... rows.
        ends = np.searchsorted(-self.sizes, -np.arange(1, FEW + 1)).tolist()
        self.large = ends[-1]
        self.at = [self.begin[self.large : n] for n in [len(begin), *ends[:-1]]]
        for k, at in enumerate(self.at[1:], 1):
            self.at[k] = at + k
        self.order, self.large_rows = order, None
        if order is not None:
            number = np.empty_like(by_size)
            number[by_size] = np.arange(len(by_size))
            self.place = np.empty_like(order)  # for every row, the number of its group
            self.place[order] = np.repeat(number, sizes)
            self.at = [order.take(at) for at in self.at]
            parts = zip(self.begin[: self.large].tolist(), self.sizes[: self.large].tolist(), strict=True)
            self.large_rows = np.concatenate([order[:0], *[order[a : a + n] for a, n in parts]])

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sums of the groups' rows."""
        large = self.large
        out = np.empty((len(self.begin), values.shape[1]), dtype=values.dtype)
        for k, at in enumerate(self.at):
            rows = values.take(at, axis=0)
            if k:
                out[large : large + len(at)] += rows
            else:
                out[large:] = rows
        if not large:
            return out
        begin, sizes = self.begin[:large], self.sizes[:large]
        if self.large_rows is not None:
            values = values.take(self.large_rows, axis=0)
            begin = np.cumsum(sizes) - sizes
        ones = np.ones(sizes[0], dtype=values.dtype)
        for i, a, n in zip(range(large), begin.tolist(), sizes.tolist(), strict=True):
            np.matmul(ones[:n], values[a : a + n], out=out[i])
        return out


class Batch:
    """Positions by ascending word, and the distinct ids of their neighbours."""

    def __init__(self, around: np.ndarray, word: np.ndarray, ids: int):
        small = np.min_scalar_type(ids)  # quick to sort
        order = np.argsort(word.astype(small), kind="stable")
        self.word = word.take(order)
        around = around.take(order, axis=0).T.astype(small).ravel()
        order = np.argsort(around, kind="stable")
        self.groups = Groups(around.take(order), order)
        self.ids = self.groups.ids.astype(np.intp)
        self.steps = self.groups.place.reshape(-1, len(word))  # as numbers of ``ids``


def _gradient(p: Parameters, batch: Batch) -> tuple[Parameters, np.ndarray]:
    """Gradient of the mean negative log-probability, and the classes that have one.

    The embeddings are those of the batch's ids only.
    """
    kind, member = np.divmod(batch.word, p.to_member.shape[1])
    looked = [p.embedding.take(ids, axis=0) for ids in batch.steps]
    wide = _side_by_side(p.places, len(kind))
    mixed = _mix(looked, wide)
    state = _state(p, mixed)
    ones = np.ones(len(kind), dtype=state.dtype)
    d_class = _d_logits(state, p.to_class, p.class_bias, kind)
    d_state, d_to_class, d_class_bias = d_class @ p.to_class.T, state.T @ d_class, ones @ d_class
    del d_class
    below = _below(p, state, kind)
    d_member = _d_logits(below, p.to_member, p.member_bias.take(kind, axis=0), member)
    d_below, d_to_member = d_member @ p.to_member.T, below.T @ d_member
    d_below *= np.subtract(1, np.square(below, out=below), out=below)
    kinds = Groups(kind)
    d_state += d_below
    slope = np.square(state)
    d_state *= np.subtract(1, slope, out=slope)
    d_mixed = d_state @ p.layer.T
    d_looked = np.empty((len(looked), *d_mixed.shape), dtype=d_mixed.dtype)
    for j in range(len(looked)):
        np.multiply(d_mixed.reshape(-1, wide.shape[1]), wide[j], out=d_looked[j].reshape(-1, wide.shape[1]))
    return Parameters(
        batch.groups.sums(d_looked.reshape(-1, d_mixed.shape[1])),
        np.stack([np.einsum("nd,nd->d", x, d_mixed) for x in looked]),
        mixed.T @ d_state,
        ones @ d_state,
        d_to_class,
        d_class_bias,
        kinds.sums(d_below),
        d_to_member,
        kinds.sums(d_member),
    ), kinds.ids


def gradient(p: Parameters, around: np.ndarray, word: np.ndarray) -> Parameters:
    """Gradient of the mean negative log-probability."""
    batch = Batch(around, word, len(p.embedding))
    parts, kinds = _gradient(p._replace(embedding=p.embedding.take(batch.ids, axis=0)), batch)
    rows = {"embedding": batch.ids, "class_state": kinds, "member_bias": kinds}
    out = Parameters(*[np.zeros_like(x) for x in p])
    for name, x, g in zip(p._fields, out, parts, strict=True):
        x[rows.get(name, slice(None))] = g
    return out


class Trainer:
    """Adagrad on batches of positions."""

    def __init__(self, start: Parameters):
        # What every batch changes whole lies in one array.
        self.rest = [name for name in start._fields if name not in BY_ROW]
        self.whole = np.concatenate([getattr(start, name).ravel() for name in self.rest])
        parts = np.split(self.whole, np.cumsum([getattr(start, name).size for name in self.rest])[:-1])
        own = {name: x.reshape(getattr(start, name).shape) for name, x in zip(self.rest, parts, strict=True)}
        self.p = start._replace(**own, **{name: getattr(start, name).copy() for name in BY_ROW})
        self.squares = {name: np.full_like(getattr(start, name), SQUARES) for name in BY_ROW}
        self.whole_squares = np.full_like(self.whole, SQUARES)
        self.seen = 0

    def step(self, around: np.ndarray, word: np.ndarray) -> None:
        batch = Batch(around, word, len(self.p.embedding))
        # Most embeddings take no part in a batch.
        looked = self.p._replace(embedding=self.p.embedding.take(batch.ids, axis=0))
        gradient, kinds = _gradient(looked, batch)
        for name, rows in zip(BY_ROW, (batch.ids, kinds, kinds), strict=True):
            x, squares, g = getattr(self.p, name), self.squares[name], getattr(gradient, name)
            now = squares.take(rows, axis=0)
            now += np.square(g)
            squares[rows] = now
            old = looked.embedding if name == "embedding" else x.take(rows, axis=0)
            x[rows] = np.subtract(old, _change(g, now), out=g)
        g = np.concatenate([getattr(gradient, name).ravel() for name in self.rest])
        self.whole_squares += np.square(g)
        self.whole -= _change(g, self.whole_squares.copy())
        self.seen += len(word)


def _change(g: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """The step against the gradient, in its array; ``squares`` are used up."""
    g *= np.float32(RATE)
    g /= np.sqrt(squares, out=squares)
    return g


# -- training and scoring ------------------------------------------------------------------

def _train_task(start: Parameters, vocabulary: Vocabulary):
    def run(batches):
        trainer, draw = Trainer(start), np.random.default_rng(SEED)
        kept: list[tuple] = []
        waiting = 0
        for batch in batches:
            texts = batch.column("text")
            for low, high in text_chunks(texts):
                words, first = word_hashes(texts.slice(low, high - low))
                ids = vocabulary.encode(words)
                # Neighbours share their context, so a batch takes positions from all over.
                at = draw.permutation(len(ids))
                kept.append((contexts(ids, first, at, len(vocabulary.counts)), ids[at]))
                waiting += len(at)
                if waiting >= BATCH:
                    around, word = (np.concatenate(x) for x in zip(*kept, strict=True))
                    for a in range(0, len(word) - BATCH + 1, BATCH):
                        trainer.step(around[a : a + BATCH], word[a : a + BATCH])
                    done = len(word) // BATCH * BATCH
                    kept, waiting = [(around[done:], word[done:])], len(word) - done
        if waiting:
            trainer.step(*(np.concatenate(x) for x in zip(*kept, strict=True)))
        if trainer.seen:
            flat = trainer.p.flat()
            for block, a in enumerate(range(0, len(flat), BLOCK)):
                part = flat[a : a + BLOCK].astype(np.float32) * np.float32(trainer.seen)
                yield pa.record_batch(
                    {
                        "block": pa.array([block], pa.int32()),
                        "seen": pa.array([trainer.seen], pa.int64()),
                        "weights": pa.array([part.tobytes()], pa.binary()),
                    }
                )

    return run


def _sum_blocks(batches):
    sums: dict[int, list] = {}
    for batch in batches:
        columns = batch.to_pydict()
        for block, seen, weights in zip(*columns.values(), strict=True):
            values = np.frombuffer(weights, dtype=np.float32).astype(np.float64)
            own = sums.setdefault(block, [0, np.zeros_like(values)])
            own[0] += seen
            own[1] += values
    if sums:
        yield pa.record_batch(
            {
                "block": pa.array(list(sums), pa.int32()),
                "seen": pa.array([s for s, _ in sums.values()], pa.int64()),
                "weights": pa.array([w.astype(np.float32).tobytes() for _, w in sums.values()]),
            }
        )


_BLOCK_ROWS = "block int, seen long, weights binary"


def train(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> Parameters:
    """The average of the copies that the tasks trained."""
    start = initial_parameters(vocabulary.counts)
    copies = docs.select(F.col(text).alias("text")).mapInArrow(
        _train_task(start, vocabulary), _BLOCK_ROWS
    )
    salted = copies.withColumn("salt", F.pmod(F.xxhash64("seen", "weights"), F.lit(SALTS)))
    partial = salted.repartition("block", "salt").drop("salt").mapInArrow(_sum_blocks, _BLOCK_ROWS)
    total = partial.repartition("block").mapInArrow(_sum_blocks, _BLOCK_ROWS).toArrow().to_pydict()
    if not total["block"]:
        return start
    flat = np.zeros(sum(p.size for p in start))
    for block, seen, weights in zip(*total.values(), strict=True):
        part = np.frombuffer(weights, dtype=np.float32)
        flat[block * BLOCK : block * BLOCK + len(part)] = part / seen
    return start.from_flat(flat)


class Scorer:
    """The model applied to whole texts: neighbours are shifts of the same embeddings."""

    def __init__(self, model: Parameters, vocabulary: Vocabulary):
        self.p, self.vocabulary = model, vocabulary
        self.wide = _side_by_side(model.places, LANES)

    def log_probabilities(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Of all words of the texts; the same as ``log_probability`` of their contexts."""
        padded, place = _padded(ids, first, len(self.vocabulary.counts))
        padded = np.append(padded, np.full(LANES, len(self.vocabulary.counts)))
        out = np.empty(len(ids))
        for a in range(0, len(ids), SCORED):
            here, word = place[a : a + SCORED], ids[a : a + SCORED]
            low = here[0]
            high = low + -(-(here[-1] + 1 - low) // LANES) * LANES
            looked = self.p.embedding.take(padded[low - SIDE : high + SIDE], axis=0)
            shifted = [looked[SIDE + step : SIDE + step + high - low] for step in STEPS]
            mixed = _mix(shifted, self.wide)
            if len(mixed) > len(word):  # there are pads between texts
                mixed = mixed.take(here - low, axis=0)
            out[a : a + SCORED] = _log_probability(self.p, _state(self.p, mixed), word)
        return out

    def score(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Words and summed log-probability of each text."""
        return self.score_words(*word_hashes(texts))[:2]

    def score_words(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """The same, and whether a word shares its id."""
        ids = self.vocabulary.encode(words)
        running = np.concatenate([[0.0], np.cumsum(self.log_probabilities(ids, first))])
        shares = ids >= len(self.vocabulary.counts) - UNKNOWN
        return np.diff(first), running[first[1:]] - running[first[:-1]], shares


def _times(words: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, words and how often a word stands in the row, ordered by row."""
    order = np.lexsort((words, row))
    words, row = words[order], row[order]
    new = np.ones(len(words), dtype=bool)
    new[1:] = (words[1:] != words[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    return row[begin], words[begin], np.diff(np.append(begin, len(words)))


def score(
    docs: DataFrame,
    model: Parameters,
    vocabulary: Vocabulary,
    text: str = "text",
    key: str = "doc_id",
    counted: DataFrame | None = None,
) -> DataFrame:
    """One row per document: key, n_words, score (summed log-probability), mean_score."""
    scorer = Scorer(model, vocabulary)
    listed = counted is not None

    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            for low, high in text_chunks(texts):
                words, first = word_hashes(texts.slice(low, high - low))
                n, total, shares = scorer.score_words(words, first)
                out = {
                    "key": batch.column("key").slice(low, high - low),
                    "n_words": pa.array(n, pa.int64()),
                    "score": pa.array(total),
                }
                if listed:
                    row = np.repeat(np.arange(len(n)), n)[shares]
                    row, word, times = _times(words[shares].view(np.int64), row)
                    begin = pa.array(np.searchsorted(row, np.arange(len(n) + 1)), pa.int32())
                    out["word"] = pa.ListArray.from_arrays(begin, pa.array(word))
                    out["times"] = pa.ListArray.from_arrays(begin, pa.array(times, pa.int64()))
                yield pa.record_batch(out)

    key_type = dict(docs.dtypes)[key]
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {key_type}, n_words long, score double"
    if listed:
        lists = narrow.mapInArrow(run, schema + ", word array<long>, times array<long>")
        # Stored, so that the numbers of the rows stay what they are.
        rows = stored(lists.withColumn("row", F.monotonically_increasing_id()), "scored")
        scored = _with_shares(rows, counted, vocabulary)
    else:
        scored = narrow.mapInArrow(run, schema)
    mean = F.when(F.col("n_words") > 0, F.col("score") / F.col("n_words"))
    return scored.withColumn("mean_score", mean)


def _with_shares(rows: DataFrame, counted: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Key, n_words and score with the log-share of every word that shares its id."""
    ids = len(vocabulary.counts)
    of_id = F.array(*[F.lit(float(n)) for n in vocabulary.counts[ids - UNKNOWN :]])
    share = F.log(F.col("n") / F.get(of_id, (F.col("id") - (ids - UNKNOWN)).cast("int")))
    shares = shared_ids(counted, vocabulary).select("word", share.alias("share"))
    pairs = rows.select("row", F.explode(F.arrays_zip("word", "times")).alias("w"))
    pairs = pairs.select("row", F.col("w.word").alias("word"), F.col("w.times").alias("times"))
    added = (
        pairs.join(shares, "word")
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.col("share")).alias("added"))
    )
    score = F.col("score") + F.coalesce("added", F.lit(0.0))
    return rows.drop("word", "times").join(added, "row", "left").select(
        "key", "n_words", score.alias("score")
    )


def pseudo_likelihood(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Train on ``docs`` and score them."""
    counted = count_words(docs, text)
    vocabulary = build_vocabulary(docs, text, counted)
    return score(docs, train(docs, vocabulary, text), vocabulary, text, key, counted)
