"""Many fixed patterns in one pass over texts: an Aho-Corasick automaton on Arrow buffers.

The UTF-8 bytes of the texts of a batch are lowered (A-Z only) and read once, as one
text, by the automaton of all patterns; matches that cross from one row into the next are discarded.
All occurrences are found, overlapping ones too.  Positions count characters from 0.

Patterns are data: (group, pattern) rows, at most ``MOST_PATTERNS`` distinct ones, which are part of
the task's function.  Null texts hold nothing, empty patterns are refused, repeated patterns
count once; the cost does not depend on the number of patterns, but for the matches.
"""

from __future__ import annotations

import json
from functools import cache
from importlib import resources

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_PATTERNS = 100_000
# Bytes of a batch that are read at a time, at least one row.
SPAN = 1 << 22

Patterns = list[tuple[str, str]]


@cache
def shipped_patterns() -> tuple[tuple[str, str], ...]:
    text = resources.files("flowverdict.sources").joinpath("attack_patterns.json").read_text("utf-8")
    return tuple((group, p) for group, ps in json.loads(text).items() for p in ps)


def lowered(pattern: str) -> bytes:
    """Bytes have only A-Z lowered by ``bytes.lower``."""
    return pattern.encode().lower()


@cache
def _automaton(patterns: tuple[bytes, ...]):
    built = ahocorasick.Automaton()
    for number, pattern in enumerate(patterns):
        # One character for each byte.
        built.add_word(pattern.decode("latin-1"), (number, len(pattern)))
    built.make_automaton()
    return built


def _occurrences(texts: pa.Array, patterns: tuple[bytes, ...]):
    """Arrays (row, pattern number, byte position in the row) and the bytes, by spans of rows."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + SPAN, side="right")) - 1)
        start, stop = int(offsets[low]), int(offsets[high])
        raw = bytes(data[start:stop]) if data is not None else b""
        found = [(end + 1 - size, size, number) for end, (number, size) in _automaton(patterns).iter(raw.lower().decode("latin-1"))]
        begin, size, number = np.array(found, dtype=np.int64).reshape(-1, 3).T
        own = offsets[low : high + 1] - start
        row = np.searchsorted(own, begin, side="right") - 1
        inside = begin + size <= own[row + 1]
        row, begin, number = row[inside], begin[inside], number[inside]
        # Continuation bytes are no characters of their own.
        as_bytes = np.frombuffer(raw, dtype=np.uint8)
        characters = np.concatenate([[0], np.cumsum((as_bytes & 0xC0) != 0x80)])
        yield low + row, number, characters[begin] - characters[own[row]]
        low = high


def _distinct(patterns: Patterns) -> tuple[bytes, ...]:
    known = tuple(sorted({lowered(p) for _, p in patterns}))
    if b"" in known or len(known) > MOST_PATTERNS:
        raise ValueError(f"patterns must not be empty, and at most {MOST_PATTERNS}")
    return known


def find_patterns(df: DataFrame, key: str, text: str, patterns: Patterns) -> DataFrame:
    """One row for each text row, group and pattern found: key, group, pattern, positions.

    Repeated rows give repeated results; extra columns are ignored.
    """
    known = _distinct(patterns)
    spelled = [p.decode() for p in known]
    groups = [sorted({g for g, p in patterns if lowered(p) == own}) for own in known]

    def run(batches):
        for batch in batches:
            keys = batch.column("key")
            for rows, numbers, positions in _occurrences(batch.column("text"), known):
                order = np.lexsort((positions, numbers, rows))
                rows, numbers, positions = rows[order], numbers[order], positions[order]
                new = np.ones(len(rows), dtype=bool)
                new[1:] = (rows[1:] != rows[:-1]) | (numbers[1:] != numbers[:-1])
                new = np.flatnonzero(new)
                bounds = np.append(new, len(rows)).astype(np.int32)
                yield pa.record_batch(
                    {
                        "key": keys.take(pa.array(rows[new])),
                        "groups": pa.array([groups[n] for n in numbers[new]], pa.list_(pa.string())),
                        "pattern": pa.array([spelled[n] for n in numbers[new]], pa.string()),
                        "positions": pa.ListArray.from_arrays(pa.array(bounds), pa.array(positions)),
                    }
                )

    schema = f"key {dict(df.dtypes)[key]}, groups array<string>, pattern string, positions array<long>"
    narrow = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    found = narrow.mapInArrow(run, schema)
    return found.select("key", F.explode("groups").alias("group"), "pattern", "positions")


def groups_found(texts: Column, patterns: Patterns) -> Column:
    """For each text of an array the groups of which a pattern occurs: sorted, without repeats.

    One Arrow function for all texts of a row; other columns do not travel to Python.
    """
    known = _distinct(patterns)
    groups = sorted({g for g, _ in patterns})
    number = {p: n for n, p in enumerate(known)}
    # Which groups a pattern belongs to.
    member = np.zeros((len(known), len(groups)), dtype=bool)
    for g, p in patterns:
        member[number[lowered(p)], groups.index(g)] = True

    @F.arrow_udf("array<array<string>>")
    def find(column: pa.Array) -> pa.Array:
        flat = column.flatten()
        hits = np.zeros((len(flat), len(groups)), dtype=bool)
        for rows, numbers, _ in _occurrences(flat, known):
            np.logical_or.at(hits, rows, member[numbers])
        row, group = np.nonzero(hits)
        bounds = np.searchsorted(row, np.arange(len(flat) + 1)).astype(np.int32)
        names = pa.array(groups, pa.string()).take(pa.array(group))
        sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        inner = pa.ListArray.from_arrays(pa.array(bounds), names)
        return pa.ListArray.from_arrays(pa.array(ends), inner)

    return find(texts)
