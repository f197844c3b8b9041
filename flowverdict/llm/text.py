"""Words and word shingles of Arrow text columns as 64-bit hashes, without Python strings.

A word is a run of ASCII letters, digits, ``_`` and non-ASCII characters, in lower case;
everything else separates words.  ``WORD`` is the same rule as a regular expression.  Null
texts count as empty.  A text of one to four words has one shingle, made of all its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD = r"[0-9a-z_\u0080-\U0010ffff]+"
SHINGLE = 5
CHUNK_BYTES = 1 << 20
BLOCK_BYTES = 1 << 17  # hashed at a time: the 64-bit copies stay in a core's cache

_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(48, 58), *range(97, 123), 95, *range(128, 256)]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_ROLL = np.array(
    [pow(0xD6E8FEB86659FD93, i + 1, 1 << 64) for i in range(SHINGLE)], dtype=np.uint64
)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the rolling base and of its inverse, kept for the longest chunk so far."""

    up = _powers(_BASE, 1024)
    down = _powers(_INVERSE, 1024)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(_BASE, n), _powers(_INVERSE, n)
        return cls.up, cls.down


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text, at least one row each."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield start, stop
        start = stop


def lower_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The lower-case UTF-8 bytes of a column and the offsets of its rows."""
    return raw_bytes(pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), "")))


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a large string column without nulls and the offsets of its rows."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(
    data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = _IS_WORD
) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the words; a word ends where its row ends."""
    inside = is_word[data]
    breaks = np.zeros(len(data) + 1, dtype=bool)
    breaks[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | breaks[1:-1]
    ends = inside
    ends[:-1] &= ~inside[1:] | breaks[1:-1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the rows, and for each row where its words begin (n + 1)."""
    data, offsets = lower_bytes(column)
    starts, ends = word_spans(data, offsets)
    return span_hashes(data, starts, ends), np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte spans that follow one another."""
    hashes = np.empty(len(starts), dtype=np.uint64)
    low = 0
    while low < len(starts):
        # A block of whole words, so that 64-bit copies of the bytes stay small.
        base = starts[low]
        high = max(low + 1, int(np.searchsorted(ends, base + BLOCK_BYTES, side="right")))
        block = data[base : ends[high - 1]].astype(np.uint64) + np.uint64(1)
        up, down = _Powers.upto(len(block) + 1)
        block *= up[: len(block)]
        running = np.zeros(len(block) + 1, dtype=np.uint64)
        np.cumsum(block, out=running[1:])
        begin, end = starts[low:high] - base, ends[low:high] - base
        hashes[low:high] = (running[end] - running[begin]) * down[begin]
        low = high
    hashes += (ends - starts).astype(np.uint64)
    return mix(hashes)


def shingle_hashes(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the five-word shingles of the rows, and for each row where they begin."""
    n_words = np.diff(first)
    n_shingles = np.where(n_words >= SHINGLE, n_words - SHINGLE + 1, np.minimum(n_words, 1))
    begin = np.concatenate([[0], np.cumsum(n_shingles)])
    padded = np.concatenate([hashes, np.zeros(SHINGLE, dtype=np.uint64)])
    rolled = padded[: len(hashes)] * _ROLL[0]
    for i in range(1, SHINGLE):
        rolled += padded[i : i + len(hashes)] * _ROLL[i]
    rows = np.repeat(np.arange(len(n_words)), n_shingles)
    at = np.arange(begin[-1]) - begin[rows] + first[rows]
    out = rolled[at]
    for row in np.flatnonzero((n_words > 0) & (n_words < SHINGLE)):
        own = hashes[first[row] : first[row + 1]]
        out[begin[row]] = (own * _ROLL[: len(own)]).sum(dtype=np.uint64)
    return mix(out), begin


def shingles_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return shingle_hashes(*word_hashes(column))


class HashSet:
    """A fixed set of 64-bit hashes; most strangers are told by one table look-up."""

    BITS = 20

    def __init__(self, members: np.ndarray):
        self.members = np.unique(members)
        self.table = np.zeros(1 << self.BITS, dtype=bool)
        self.table[self._slot(self.members)] = True

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.BITS)).astype(np.int64)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = self.table[self._slot(hashes)]
        maybe = np.flatnonzero(found)
        if len(maybe):
            at = np.searchsorted(self.members, hashes[maybe])
            at = np.minimum(at, len(self.members) - 1)
            found[maybe] = self.members[at] == hashes[maybe]
        return found


def row_of(begin: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """The row that holds each shingle position."""
    return np.searchsorted(begin, positions, side="right") - 1
