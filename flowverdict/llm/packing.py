"""Packing of tokenised documents into sequences by a configuration linear program.

1. ``tokenise`` writes the pieces once: ids, length, and the piece's number among those of
   its length in its task.  Only documents over the capacity are cut.
2. ``plan_packing`` works on the histogram of lengths alone (at most ``capacity`` numbers,
   so it fits the driver whatever the input size).  A configuration is a multiset of lengths
   that fits a sequence; the linear program asks for the fewest configurations that use up
   the histogram.  It is solved by multiplicative weights: a length's price is its worth
   (size, and up to twice that for long ones, which are hard to place late) times a weight
   that shrinks as the length gets covered, a knapsack dynamic program finds
   the most valuable configuration at these prices, and as much of it is taken as the
   remaining demand allows.  Amounts are then rounded down to whole sequences, and what
   rounding (or the last round) leaves over is packed by best fit in falling length.
   Together the plan uses exactly the histogram.
3. ``place`` looks every piece up: its number within its length over all tasks names its
   slot in the plan.  Ids are neither shuffled nor tokenised again.

Null texts count as empty, an empty document is the end id alone, repeated rows and keys are
documents of their own, extra columns are ignored.  An empty table gives no pieces.
"""

from __future__ import annotations

from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowverdict.llm.bpe import encode
from flowverdict.llm.tables import broadcast_if_small
from flowverdict.llm.text import text_chunks
from flowverdict.sources.scratch import stored

CAPACITY = 2048
END_ID = 0
# Rounds of multiplicative weights; each prices all lengths by one dynamic program.
ROUNDS = 1000
# The share of the total length at which the rounds stop.
ENOUGH = 0.001
OUT_ROWS = 4096


# -- pieces --------------------------------------------------------------------------------

def _cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document of ``n`` ids; the first may be shorter."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def _numbers_within(lengths: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The number of each piece among those of its length; ``seen`` goes on counting."""
    order = np.argsort(lengths, kind="stable")
    ranked = lengths[order]
    begin = np.searchsorted(ranked, ranked)
    out = np.empty(len(lengths), dtype=np.int64)
    out[order] = np.arange(len(lengths)) - begin + seen[ranked]
    np.add.at(seen, lengths, 1)
    return out


def tokenise(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    key: str = "doc_id",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """The pieces: key, piece, start, length, ids, and task, number within task and length."""

    def pieces(batches):
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            texts = batch.column("text")
            for low, high in text_chunks(texts):
                owners, nth, starts, lengths, ids = [], [], [], [], []
                for row in range(low, high):
                    own = encode(tokenizer, texts[row].as_py() or "")
                    own.append(end_id)
                    for i, (start, length) in enumerate(_cut(len(own), capacity)):
                        owners.append(row)
                        nth.append(i)
                        starts.append(start)
                        lengths.append(length)
                    ids.append(np.array(own, dtype=np.int32))
                bounds = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                lengths = np.array(lengths, dtype=np.int64)
                table = pa.table(
                    {
                        "key": batch.column("key").take(pa.array(owners)),
                        "piece": pa.array(nth, pa.int32()),
                        "start": pa.array(starts, pa.int64()),
                        "length": pa.array(lengths),
                        "ids": pa.ListArray.from_arrays(bounds, np.concatenate(ids)),
                        "task": pa.array(np.full(len(lengths), task), pa.int32()),
                        "number": pa.array(_numbers_within(lengths, seen)),
                    }
                )
                yield from table.to_batches(max_chunksize=OUT_ROWS)

    key_type = dict(docs.dtypes)[key]
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = (
        f"key {key_type}, piece int, start long, length long, ids array<int>, "
        "task int, number long"
    )
    return stored(narrow.mapInArrow(pieces, schema), "pieces")


# -- the plan ------------------------------------------------------------------------------

class Plan(NamedTuple):
    """Slots by length: from piece number ``low`` on, ``per`` slots in each copy of a
    configuration, whose sequences begin at ``base``, the first slot at ``offset``."""

    length: np.ndarray
    low: np.ndarray
    per: np.ndarray
    base: np.ndarray
    offset: np.ndarray
    sequences: int


def best_configuration(value: np.ndarray) -> list[int]:
    """The multiset of lengths of at most ``len(value) - 1`` in all that is worth most.

    An unbounded knapsack; ``value[n]`` is the price of one piece of length n.
    """
    capacity = len(value) - 1
    best = np.zeros(capacity + 1)
    reversed_best = np.zeros(capacity + 1)  # at capacity - n: best[n]
    taken = [0] * (capacity + 1)
    for room in range(1, capacity + 1):
        options = reversed_best[capacity - room + 1 :] + value[1 : room + 1]
        i = int(options.argmax())
        if options[i] > best[room - 1]:
            best[room], taken[room] = options[i], i + 1
        else:
            best[room] = best[room - 1]
        reversed_best[capacity - room] = best[room]
    out, room = [], capacity
    while room:
        if taken[room]:
            out.append(taken[room])
            room -= taken[room]
        else:
            room -= 1
    return out


def solve_fractional(demand: np.ndarray, rounds: int = ROUNDS) -> Counter:
    """Amounts of configurations (sorted lengths) that together stay within the demand."""
    sizes = np.arange(len(demand))
    wanted = demand.astype(float)
    left = wanted.copy()
    amounts: Counter = Counter()
    total = (sizes * wanted).sum()
    for _ in range(rounds):
        if (sizes * left).sum() <= ENOUGH * total:
            break
        uncovered = np.divide(left, wanted, out=np.zeros_like(left), where=wanted > 0)
        worth = sizes * (1 + sizes / (len(demand) - 1))
        price = np.where(left > 0, worth * np.exp(uncovered - 1), -np.inf)
        configuration = best_configuration(price)
        parts, times = np.unique(configuration, return_counts=True)
        amount = (left[parts] / times).min()
        left[parts] -= amount * times
        left[left < 1e-9] = 0
        amounts[tuple(sorted(configuration, reverse=True))] += amount
    return amounts


def best_fit(demand: np.ndarray) -> Counter:
    """Whole sequences for the demand by best fit in falling length, in bulk."""
    capacity = len(demand) - 1
    open_with: list[Counter] = [Counter() for _ in range(capacity + 1)]  # by room left
    n_open = np.zeros(capacity + 1, dtype=np.int64)

    def put(room: int, parts: tuple[int, ...], n: int) -> None:
        open_with[room][parts] += n
        n_open[room] += n

    for length in range(capacity, 0, -1):
        left = int(demand[length])
        while left:
            fitting = np.flatnonzero(n_open[length:])
            if len(fitting):
                room = length + int(fitting[0])
                parts = next(iter(open_with[room]))
                n = min(left, open_with[room][parts])
                open_with[room][parts] -= n
                n_open[room] -= n
                if not open_with[room][parts]:
                    del open_with[room][parts]
                put(room - length, (*parts, length), n)
            else:
                times = min(left, capacity // length)
                n = left // times
                put(capacity - times * length, (length,) * times, n)
                n *= times
            left -= n
    out: Counter = Counter()
    for group in open_with:
        out.update(group)
    return out


def plan_packing(demand: np.ndarray, rounds: int = ROUNDS) -> Plan:
    """The plan for ``demand[n]`` pieces of length n, for n up to the capacity."""
    capacity = len(demand) - 1
    rest = demand.astype(np.int64).copy()
    whole: Counter = Counter()
    if rest[capacity]:
        whole[(capacity,)] = int(rest[capacity])
        rest[capacity] = 0
    for parts, amount in solve_fractional(rest, rounds).items():
        if n := int(amount + 1e-6):
            whole[parts] += n
            for length, times in Counter(parts).items():
                rest[length] -= n * times
    whole.update(best_fit(rest))
    used = np.zeros(capacity + 1, dtype=np.int64)
    slots, base = [], 0
    for parts, copies in sorted(whole.items()):
        offset = 0
        for length, times in sorted(Counter(parts).items(), reverse=True):
            slots.append((length, used[length], times, base, offset))
            used[length] += copies * times
            offset += length * times
        base += copies
    if (used != demand).any():
        raise AssertionError("the plan does not use exactly the histogram")
    columns = np.array(sorted(slots), dtype=np.int64).reshape(-1, 5).T
    return Plan(*columns, base)


# -- placing -------------------------------------------------------------------------------

def histogram(pieces: DataFrame, capacity: int = CAPACITY) -> np.ndarray:
    """Pieces by length: at most ``capacity`` numbers."""
    demand = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in pieces.groupBy("length").count().collect():
        demand[length] = n
    return demand


def place(pieces: DataFrame, plan: Plan) -> DataFrame:
    """Add ``sequence_id`` and ``offset``; ``pieces`` needs length, task and number."""
    counts = pieces.groupBy("task", "length").count()
    # One row per task and length, so a length has as many rows as there were tasks.
    before = Window.partitionBy("length").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1
    )
    first = counts.select(
        "task", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first")
    )
    first = stored(first, "firsts")
    shift = 1 + (int(plan.low.max()) if len(plan.low) else 0)
    keys = plan.length * shift + plan.low

    @F.arrow_udf("sequence_id long, offset long")
    def slot(length: pa.Array, number: pa.Array) -> pa.Array:
        length, number = (np.asarray(x, dtype=np.int64) for x in (length, number))
        key = length * shift + np.minimum(number, shift - 1)
        at = np.searchsorted(keys, key, side="right") - 1
        copy, nth = np.divmod(number - plan.low[at], plan.per[at])
        return pa.StructArray.from_arrays(
            [pa.array(plan.base[at] + copy), pa.array(plan.offset[at] + nth * length)],
            ["sequence_id", "offset"],
        )

    numbered = pieces.join(broadcast_if_small(first), ["task", "length"])
    placed = numbered.withColumn("slot", slot("length", F.col("first") + F.col("number")))
    return placed.select(*pieces.columns, "slot.sequence_id", "slot.offset")


def pack_documents(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """The pieces of ``docs`` with ids, sequence and place."""
    pieces = tokenise(docs, tokenizer, **options)
    return place(pieces, plan_packing(histogram(pieces, options.get("capacity", CAPACITY))))


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, ids.  A group holds at most the capacity."""
    parts = placed.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts")
    )
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))


def with_crc32(pieces: DataFrame) -> DataFrame:
    """``ids`` replaced by ``ids_crc32`` of their little-endian 32-bit values."""
    import zlib

    @F.arrow_udf("long")
    def crc32(ids: pa.Array) -> pa.Array:
        values = np.asarray(ids.values, dtype="<u4")
        bounds = np.asarray(ids.offsets)
        return pa.array(
            [zlib.crc32(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)],
            pa.int64(),
        )

    return pieces.withColumn("ids_crc32", crc32("ids")).drop("ids")
