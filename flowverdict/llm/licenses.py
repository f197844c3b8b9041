"""License scan: MinHash bands over overlapping windows, then exact containment.

A template of n five-word shingles is found in a document if some window of 2n shingles,
wherever it starts, holds a share of at least ``threshold`` of the template's distinct shingles.
For retrieval a document is cut into windows of ``2n + n / DENSITY`` shingles, one every
``n / DENSITY``, so every window of 2n lies inside one of them.  Its Jaccard similarity with the
template is at least ``threshold / (3.25 - threshold)`` (0.33 for 0.8).  With bands of two
values, one of 64 bands then agrees with probability above 0.999 (``collision_probability``
with the window's length); a match at the threshold mostly lies in several windows.  Windows
without any template shingle cannot agree in a band and are not hashed.  Templates met in a
band are verified exactly at every start in their row: the share of the template's distinct
shingles in 2n shingles.

One row per document row and template, with the best window (the first of equally good
ones) and the words from its first to its last shared shingle.  Null and empty texts and
templates match nothing; a template of one to four words is one shingle of all its words and
so matches only a text of just these words
(``end_word`` counts shingles as five words there, too).  Repeated rows give repeated results, null keys
are kept, extra columns are ignored.  Documents are only mapped over; the templates are held
to ``MAX_TEMPLATES`` rows, which go to every task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowverdict.llm.text import SHINGLE, HashSet, mix, row_of, shingles_of, text_chunks

THRESHOLD = 0.8
BANDS = 64
BAND_ROWS = 2
MAX_TEMPLATES = 10_000
DENSITY = 4
SLICE = 1 << 19  # shingles in the windows hashed at a time
_KEYS = np.random.default_rng(20_240_501).integers(
    1 << 62, size=BANDS * BAND_ROWS, dtype=np.uint64
) * np.uint64(2) + np.uint64(1)


def collision_probability(
    threshold: float = THRESHOLD, bands: int = BANDS, rows: int = BAND_ROWS, length: float = 2
) -> float:
    """The least probability that a window with the threshold's containment is retrieved.

    ``length``: shingles in the window for each one of the template.
    """
    return 1 - (1 - (threshold / (1 + length - threshold)) ** rows) ** bands


def best_window(at: np.ndarray, shingles: np.ndarray, size: int) -> tuple[int, int, int]:
    """(distinct shingles, first, last) of the first best window over hits in order.

    ``at``: positions of the hits; a best window may start at a hit, as moving on to its first
    hit loses none.
    """
    stop = np.searchsorted(at, at + size)
    counts: dict[int, int] = {}
    best, high = (0, 0, 0), 0
    values = shingles.tolist()
    for low, end in enumerate(stop.tolist()):
        for value in values[high:end]:
            counts[value] = counts.get(value, 0) + 1
        high = end
        if len(counts) > best[0]:
            best = len(counts), int(at[low]), int(at[end - 1])
        counts[values[low]] -= 1
        if not counts[values[low]]:
            del counts[values[low]]
    return best


def band_keys(windows: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """(windows, bands) keys of the MinHash values of shingle rows; not ``valid`` is padding."""
    out = np.zeros((len(windows), BANDS), dtype=np.uint64)
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    for i, factor in enumerate(_KEYS):
        least = np.where(valid, windows * factor, top).min(axis=1)
        out[:, i // BAND_ROWS] = mix(out[:, i // BAND_ROWS] ^ mix(least + np.uint64(i)))
    return out


class TemplateIndex:
    """Band keys of all templates by size."""

    def __init__(self, templates: pa.Table):
        self.templates = templates["template"].combine_chunks()
        shingles, begin = shingles_of(templates["text"].combine_chunks())
        self.shingles = HashSet(shingles)
        self.sets = [np.unique(shingles[a:b]) for a, b in zip(begin[:-1], begin[1:], strict=True)]
        sizes = np.diff(begin)
        self.sizes = {}
        for n in np.unique(sizes[sizes > 0]):
            members = np.flatnonzero(sizes == n)
            rows = np.stack([shingles[begin[m] : begin[m + 1]] for m in members])
            keys = band_keys(rows, np.ones(rows.shape, dtype=bool)).ravel()
            order = np.argsort(keys, kind="stable")
            self.sizes[int(n)] = keys[order], np.repeat(members, BANDS)[order]

    def retrieve(self, n: int, windows: np.ndarray, valid: np.ndarray) -> np.ndarray:
        """Distinct pairs (window, template) that agree in a band."""
        keys, owners = self.sizes[n]
        asked = band_keys(windows, valid).ravel()
        low = np.searchsorted(keys, asked)
        count = np.searchsorted(keys, asked, side="right") - low
        met = np.flatnonzero(count)
        window = np.repeat(met // BANDS, count[met])
        nth = np.arange(count[met].sum()) - np.repeat(np.cumsum(count[met]) - count[met], count[met])
        template = owners[np.repeat(low[met], count[met]) + nth]
        return np.unique(np.stack([window, template], axis=1), axis=0)

    def search(self, shingles: np.ndarray, begin: np.ndarray, threshold: float) -> list[tuple]:
        """(row, template number, containment, first word, end word) of the best windows."""
        hits = self.shingles.has(shingles)
        if not hits.any():
            return []
        rows = np.unique(row_of(begin, np.flatnonzero(hits)))
        hit_sum = np.concatenate([[0], np.cumsum(hits)])
        best: dict[tuple[int, int], tuple] = {}
        for n in self.sizes:
            step = max(1, n // DENSITY)
            width = 2 * n + step
            start = np.concatenate([np.arange(begin[r], begin[r + 1], step) for r in rows])
            end = np.minimum(start + width, begin[row_of(begin, start) + 1])
            some = hit_sum[end] > hit_sum[start]
            start, end = start[some], end[some]
            met: set[tuple[int, int]] = set()
            many = max(1, SLICE // width)
            for low in range(0, len(start), many):
                a, z = start[low : low + many], end[low : low + many]
                at = a[:, None] + np.arange(width)
                valid = at < z[:, None]
                windows = shingles[np.minimum(at, len(shingles) - 1)]
                pairs = self.retrieve(n, windows, valid)
                met.update(zip(row_of(begin, a[pairs[:, 0]]).tolist(), pairs[:, 1].tolist(), strict=True))
            for row, t in sorted(met):
                own = np.flatnonzero(hits[begin[row] : begin[row + 1]])
                own = own[np.isin(shingles[begin[row] + own], self.sets[t])]
                shared, first, last = best_window(own, shingles[begin[row] + own], 2 * n)
                held = shared / len(self.sets[t])
                if shared and held >= threshold:
                    best[row, t] = held, first, last + SHINGLE
        return [(row, int(t), *found) for (row, t), found in best.items()]


def scan_licenses(
    docs: DataFrame,
    templates: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    template_text: str = "text",
    template_id: str = "template_id",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Pairs of document and template: key, template, containment, first_word, end_word."""
    asked = templates.select(
        F.col(template_id).alias("template"), F.col(template_text).alias("text")
    )
    held = asked.limit(MAX_TEMPLATES + 1).toArrow()
    if held.num_rows > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    index = TemplateIndex(held)
    types = dict(docs.dtypes)[key], dict(templates.dtypes)[template_id]

    def search(batches):
        for batch in batches:
            keys, texts = batch.column("key"), batch.column("text")
            for low, high in text_chunks(texts):
                shingles, begin = shingles_of(texts.slice(low, high - low))
                found = index.search(shingles, begin, threshold)
                if found:
                    row, template, containment, first, end = zip(*found, strict=True)
                    yield pa.record_batch(
                        {
                            "key": keys.take(pa.array([low + r for r in row])),
                            "template": index.templates.take(pa.array(template)),
                            "containment": pa.array(containment, pa.float64()),
                            "first_word": pa.array(first, pa.int64()),
                            "end_word": pa.array(end, pa.int64()),
                        }
                    )

    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = (
        f"key {types[0]}, template {types[1]}, containment double, "
        "first_word long, end_word long"
    )
    return narrow.mapInArrow(search, schema)
