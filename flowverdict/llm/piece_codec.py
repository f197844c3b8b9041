"""Exact SentencePiece BPE encoding by backtracking, and decoding.

A merge-type model joins, again and again, the adjacent symbols whose concatenation is the
piece of the highest score, the leftmost of equal ones.  A sequence of pieces is the result of
that exactly if every two neighbours are what merging their joint text alone gives: the first
merge across a border would also happen in the pair of pieces that meet there.  So a text is
encoded from left to right:

1. an Aho-Corasick automaton gives the longest piece that starts at each position;
2. a piece is appended if it is compatible with the one before.  ``Pieces.compatible`` undoes
   the merges of both, latest first, and asks at each step whether an earlier merge would have
   crossed the border.  Pieces of equal score are checked by merging their text again;
3. otherwise the next shorter piece at the position is tried, and where none is left the
   position is marked in a field of failed positions, so that no end is tried twice, and the
   last piece is shortened.

Texts are cut where no piece can span the cut, between letters, signs and digits and before
blanks (that every piece stays whole is verified when a model is loaded); the pieces of
such words are kept in a bounded cache.  Characters without a piece become byte pieces.

Null texts count as empty, and an empty text has no pieces but the end id, if wanted.  Whole
texts are read whatever their length; repeated rows are encoded alike, null keys are kept,
extra columns are ignored.  Encoding and decoding are map-only.
"""

from __future__ import annotations

import re
from functools import cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowverdict.llm.text import text_chunks

BLANK = "▁"
# Bounds of the word cache of a worker: words in each of its two halves, characters of a word.
CACHED_WORDS, CACHED_LENGTH = 220_000, 48
# Pairs of pieces whose compatibility a worker remembers.
CACHED_PAIRS = 400_000
# The library's text of an unknown id.
UNKNOWN = " ⁇ "
PROBES = ["", " ", "  a  b ", "a\nb\tc", "x▁▁y", "ﬁ ① İ é", " " * 99, "\0\r\n"]


def _splitter(names: dict[str, int]) -> re.Pattern:
    """The finest of some patterns that leaves every piece whole.

    All of them cut between two characters by their kinds alone, so where no piece is cut, no
    piece can span a cut in a text either, and the parts can be encoded one by one.
    """
    inside = set(chain.from_iterable(names))
    # Numerals such as a raised two pass as letters in patterns.
    odd = "".join(c for c in sorted(inside) if re.match(r"[^\W\d_]", c) and not c.isalpha())
    letter, other = rf"[^\W\d_{re.escape(odd)}]", rf"(?:[^\w{BLANK}\n]|[_{re.escape(odd)}])"
    for pattern in (
        rf"{BLANK}*{letter}+|{BLANK}*{other}+|{BLANK}+|\d|\n+",
        rf"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n+",
        rf"{BLANK}*[^{BLANK}]+|{BLANK}+",
    ):
        found = re.compile(pattern)
        if all(found.findall(name) == [name] for name in names):
            return found
    return re.compile("(?s:.+)")


class Pieces:
    """A merge-type model with byte fallback, dummy prefix and identity normalisation."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.end = model.eos_id()
        names = [model.id_to_piece(i) for i in range(len(model))]
        self.byte_ids = [0] * 256
        self.surface: list[bytes] = []
        self.is_byte = np.zeros(len(names), dtype=bool)
        self.text: dict[int, str] = {}
        for i, name in enumerate(names):
            if model.is_byte(i):
                self.byte_ids[int(name[1:-1], 16)] = i
                self.surface.append(bytes([int(name[1:-1], 16)]))
                self.is_byte[i] = True
            elif model.is_unknown(i):
                self.surface.append(UNKNOWN.encode())
            elif model.is_control(i):
                self.surface.append(b"")
            else:
                self.text[i] = name
                self.surface.append(name.replace(BLANK, " ").encode())
        self._id = {name: i for i, name in self.text.items()}
        self._score = {i: model.get_score(i) for i in self.text}
        self._prepare()
        # Words met lately, and those met before; the older half goes when the newer is full.
        self._cache: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}
        for probe in PROBES:
            if self.encode(probe) != model.encode(probe, add_eos=True):
                raise ValueError(f"{path} is no merge-type model with identity normalisation")

    def _prepare(self) -> None:
        single = {name for name in self._id if len(name) == 1}
        if not single.issuperset(chain.from_iterable(self._id)):
            raise ValueError("a piece has a character that is no piece")
        self._words = _splitter(self._id).findall
        # Later merges have larger ranks.
        order = sorted(self.text, key=lambda i: (-self._score[i], i))
        n = len(self.surface)
        self._rank = [0] * n
        for rank, i in enumerate(order):
            self._rank[i] = rank
        scores = [self._score[i] for i in order]
        shared = {a for a, b in zip(scores, scores[1:], strict=False) if a == b}
        self._size = [len(self.text.get(i, "")) for i in range(n)]
        # The last merge of each piece; single characters have none.
        self._left, self._right = [-1] * n, [-1] * n
        self._tied = [False] * n
        automaton = ahocorasick.Automaton()
        reachable = set()
        for i in order:
            name = self.text[i]
            if len(name) > 1:
                parts, last = self.merge(name)
                if parts != [i]:
                    continue  # never the result of merging
                self._left[i], self._right[i] = last
            reachable.add(i)
            automaton.add_word(name, i)
        automaton.make_automaton()
        self._matches = automaton.iter
        for i in sorted(reachable, key=self._size.__getitem__):
            # A piece is tied if any merge in its history is.
            if self._left[i] >= 0:
                parts = self._tied[self._left[i]] or self._tied[self._right[i]]
                self._tied[i] = self._score[i] in shared or parts
        self._shorter = [-1] * n
        for i in reachable:
            name = self.text[i]
            shorter = (self._id.get(name[:k]) for k in range(len(name) - 1, 0, -1))
            self._shorter[i] = next((p for p in shorter if p in reachable), -1)
        self._pairs: dict[int, bool] = {}

    def merge(self, text: str) -> tuple[list[int], tuple[int, int]]:
        """Plain merging of a short text of known characters; also the last merge made."""
        parts, last = [self._id[c] for c in text], (-1, -1)
        while True:
            joined = [self._id.get(self.text[a] + self.text[b]) for a, b in zip(parts, parts[1:], strict=False)]
            found = [(-self._score[p], at) for at, p in enumerate(joined) if p is not None]
            if not found:
                return parts, last
            at = min(found)[1]
            last = parts[at], parts[at + 1]
            parts[at : at + 2] = [joined[at]]

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the joint text of two pieces gives these two pieces."""
        if self._tied[a] or self._tied[b]:
            return self.merge(self.text[a] + self.text[b])[0] == [a, b]
        known, text, rank = self._id.get, self.text, self._rank
        # A merge across the border counts if it comes before the merge undone last.
        limit = len(rank)
        while True:
            across = known(text[a] + text[b])
            if across is not None and rank[across] < limit:
                return False
            # Of the two pieces the one that was made later is undone.
            if self._left[a] >= 0 and (self._left[b] < 0 or rank[a] > rank[b]):
                limit, a = rank[a], self._right[a]
            elif self._left[b] >= 0:
                # Of equal merges the left one comes first, hence at the piece itself.
                limit, b = rank[b] + 1, self._left[b]
            else:
                return True

    def _known(self, longest: list[int]) -> list[int]:
        """Pieces of a text from the longest match at each position; all characters known."""
        size, shorter, pairs = self._size, self._shorter, self._pairs
        n, at, out, last = len(longest), 0, [], -1
        failed = bytearray(n + 1)
        piece = longest[0]
        if len(pairs) > CACHED_PAIRS:
            pairs.clear()
        while True:
            if piece < 0:
                failed[at] = 1
                piece = out.pop()
                last = out[-1] if out else -1
                at -= size[piece]
                piece = shorter[piece]
                continue
            end = at + size[piece]
            if failed[end]:
                piece = shorter[piece]
                continue
            if last >= 0:
                pair = last << 32 | piece
                fits = pairs.get(pair)
                if fits is None:
                    fits = pairs[pair] = self.compatible(last, piece)
                if not fits:
                    piece = shorter[piece]
                    continue
            out.append(piece)
            last = piece
            at = end
            if at == n:
                return out
            piece = longest[at]

    def _word(self, word: str) -> tuple[int, ...]:
        """The pieces of a word that is not in the newer half of the cache."""
        ids = self._older.get(word) or self._encode_word(word)
        if len(word) <= CACHED_LENGTH:
            if len(self._cache) >= CACHED_WORDS:
                self._older, self._cache = self._cache, {}
            self._cache[word] = ids
        return ids

    def _encode_word(self, word: str) -> tuple[int, ...]:
        longest = [-1] * len(word)
        for end, piece in self._matches(word):
            # Matches come by their ends, so the last one of a start is the longest.
            longest[end + 1 - self._size[piece]] = piece
        if -1 not in longest:
            return tuple(self._known(longest))
        out: list[int] = []
        start = 0
        for at in [i for i, piece in enumerate(longest) if piece < 0]:
            if at > start:
                out += self._known(longest[start:at])
            out += [self.byte_ids[b] for b in word[at].encode()]
            start = at + 1
        if start < len(word):
            out += self._known(longest[start:])
        return tuple(out)

    def encode(self, text: str, end: bool = True) -> list[int]:
        known, word_ids = self._cache.get, self._word
        words = self._words(BLANK + text.replace(" ", BLANK)) if text else ()
        out = list(chain.from_iterable([known(w) or word_ids(w) for w in words]))
        if end:
            out.append(self.end)
        return out

    def decode(self, ids: list[int]) -> str:
        """The library's text of any ids; invalid bytes become U+FFFD one by one."""
        surface = self.surface
        skip = next((n for n, i in enumerate(ids) if surface[i]), len(ids))
        parts = [surface[i] for i in ids]
        joined = b"".join(parts)
        # The blank that encoding puts before a text.
        lead = skip < len(ids) and ids[skip] in self.text and joined[:1] == b" "
        try:
            # A control id between bytes parts them.
            out = None if b"" in parts[:-1] else joined.decode()
        except UnicodeDecodeError:
            out = None
        if out is None:
            out = _patched(surface, self.is_byte, ids)
        return out[1:] if lead else out


def _patched(surface: list[bytes], is_byte: np.ndarray, ids: list[int]) -> str:
    out, run = [], b""
    for i in [*ids, -1]:
        if i >= 0 and is_byte[i]:
            run += surface[i]
            continue
        while run:
            for k in range(1, min(4, len(run)) + 1):
                try:
                    out.append(run[:k].decode())
                    run = run[k:]
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                run = run[1:]
        if i >= 0:
            out.append(surface[i].decode())
    return "".join(out)


@cache
def pieces(path: str) -> Pieces:
    """The model of a file; built once per Python worker."""
    return Pieces(path)


def id_lists(rows: list) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)])
    if ends[-1] >= 1 << 31:
        raise ValueError("a batch has more than 2^31 ids")
    flat = np.fromiter(chain.from_iterable(rows), dtype=np.int32, count=int(ends[-1]))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))


def encode(
    docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", end: bool = True
) -> DataFrame:
    """One row per document: key, ids."""
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches):
        model = pieces(path)
        for batch in batches:
            keys, texts = batch.column("key"), batch.column("text")
            for low, high in text_chunks(texts):
                part = texts.slice(low, high - low).to_pylist()
                rows = [model.encode(t or "", end) for t in part]
                yield pa.record_batch({"key": keys.slice(low, high - low), "ids": id_lists(rows)})

    return narrow.mapInArrow(run, f"key {dict(docs.dtypes)[key]}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of ``encode`` with the text of their ids: key, ids, text; null ids count as none."""
    narrow = encoded.select("key", "ids")

    def run(batches):
        model = pieces(path)
        for batch in batches:
            texts = [model.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.record_batch(
                {"key": batch.column("key"), "ids": batch.column("ids"), "text": pa.array(texts, pa.string())}
            )

    return narrow.mapInArrow(run, f"key {dict(encoded.dtypes)['key']}, ids array<int>, text string")
