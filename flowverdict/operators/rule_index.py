"""Large catalogs through an index: a flow costs what it nearly matches, not all rules.

Conditions are grouped by field.  For a batch of flows the values of each field are sorted
once; a numeric condition then holds for one slice of that order (two for ``!=``), found by
bisection, and a text condition for the flows of one text.  So the number of flows that satisfy
each condition is known before any rule is tested, and each rule starts from the flows of its most
selective condition; the rest of its conditions is tested on those only.

The results are those of ``rules_relational.matched_by_data``: catalog order, the same
comparator (numbers where both sides read as numbers, else texts without case), an absent
field counts as 0, a rule without conditions matches everything.  A batch with more than
``PAIRS`` pairs to test is cut by rows, and a row with more by rules, so what a task holds
beside its batch is bounded by ``PAIRS`` and the catalog's own size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowverdict.functions import sqltext as sql
from flowverdict.operators.compare import as_number
from flowverdict.operators.rules_relational import field_reading
from flowverdict.sources.catalog import Rule

PAIRS = 1 << 18
OPS = [">", ">=", "<", "<=", "==", "!="]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class RuleIndex:
    """The conditions of a catalog as arrays, rule by rule."""

    def __init__(self, rules: list[Rule]):
        conditions = [c for r in rules for c in r.conditions]
        self.fields = sorted({str(c.field) for c in conditions})
        number = {f: i for i, f in enumerate(self.fields)}
        sizes = [len(r.conditions) for r in rules]
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.field = np.array([number[str(c.field)] for c in conditions], dtype=np.int64)
        self.op = np.array([OPS.index(c.op) if c.op in OPS else -1 for c in conditions], dtype=np.int64)
        values = [as_number(c.value) for c in conditions]
        self.numeric = np.array([v is not None for v in values], dtype=bool)
        self.value = np.array([0.0 if v is None else v for v in values])
        texts = [str(c.value).upper() for c in conditions]
        self.texts = sorted(set(texts))
        code = {t: i for i, t in enumerate(self.texts)}
        self.text = np.array([code[t] for t in texts], dtype=np.int64)
        self.pairs = PAIRS
        self.by_field = [np.flatnonzero(self.field == f) for f in range(len(self.fields))]

    # -- one batch -------------------------------------------------------------------------

    def read(self, numbers: pa.Array, shown: pa.Array):
        """Values, which of them are numbers, and codes of the texts (-1: in no condition)."""
        width = len(self.fields)
        flat = numbers.flatten()
        known = ~np.asarray(flat.is_null()).reshape(-1, width)
        values = flat.fill_null(0.0).to_numpy(zero_copy_only=False).reshape(-1, width)
        coded = shown.flatten().dictionary_encode()
        codes = {t: i for i, t in enumerate(self.texts)}
        table = np.array([codes.get(t, -1) for t in coded.dictionary.to_pylist()] + [-1], dtype=np.int64)
        at = coded.indices.fill_null(len(table) - 1).to_numpy(zero_copy_only=False)
        return values, known, table[at].reshape(-1, width)

    def holds(self, conditions: np.ndarray, value, known, text) -> np.ndarray:
        """Whether each condition holds for the reading beside it."""
        limit, op = self.value[conditions], self.op[conditions]
        by_number = np.select(
            [op == 0, op == 1, op == 2, op == 3, op == 4, op == 5],
            [value > limit, value >= limit, value < limit, value <= limit, value == limit, value != limit],
            False,
        )
        return np.where(known & self.numeric[conditions], by_number, text == self.text[conditions])

    def _slices(self, values, known, text):
        """For each condition two slices of a list of rows: starts, sizes; and the lists."""
        n, c = len(values), len(self.field)
        lists, base = [], 0
        starts, sizes = np.zeros((2, c), np.int64), np.zeros((2, c), np.int64)
        for f, own in enumerate(self.by_field):
            good = known[:, f] & ~np.isnan(values[:, f])
            rows = np.flatnonzero(good)
            order = rows[np.argsort(values[rows, f], kind="stable")]
            held = values[order, f]
            odd = np.flatnonzero(known[:, f] & ~good)
            # In text order: rows by the code of their text, those without a number apart.
            bare, every = np.flatnonzero(~known[:, f]), np.arange(n)
            by_text = [r[np.argsort(text[r, f], kind="stable")] for r in (bare, every)]
            lists += [order, odd, *by_text]
            at_odd = base + len(order)
            at_text = [at_odd + len(odd), at_odd + len(odd) + len(bare)]
            numeric = own[self.numeric[own] & ~np.isnan(self.value[own])]
            left = np.searchsorted(held, self.value[numeric], side="left")
            right = np.searchsorted(held, self.value[numeric], side="right")
            op, size = self.op[numeric], len(held)
            low = np.select([op == 0, op == 1, op == 4], [right, left, left], 0)
            high = np.select([op == 2, op == 3, op == 4, op == 5, op == -1], [left, right, right, left, 0], size)
            starts[0, numeric], sizes[0, numeric] = base + low, high - low
            unequal = numeric[op == 5]
            # Above the value, and the rows that are no number in order.
            starts[1, unequal] = base + right[op == 5]
            sizes[1, unequal] = size - right[op == 5] + len(odd)
            never_equal = own[self.numeric[own] & np.isnan(self.value[own]) & (self.op[own] == 5)]
            starts[1, never_equal], sizes[1, never_equal] = base, size + len(odd)
            base = at_text[1] + n
            for which, chosen in ((0, own[self.numeric[own]]), (1, own[~self.numeric[own]])):
                codes = text[by_text[which], f]
                begin = np.searchsorted(codes, self.text[chosen], side="left")
                count = np.searchsorted(codes, self.text[chosen], side="right") - begin
                if which:
                    starts[0, chosen], sizes[0, chosen] = at_text[1] + begin, count
                else:
                    # Rows without a number; only where slice 1 is free, else as a pair to test.
                    free = sizes[1, chosen] == 0
                    starts[1, chosen[free]], sizes[1, chosen[free]] = at_text[0] + begin[free], count[free]
                    both = chosen[~free & (count > 0)]
                    # Rare: != against numbers and texts at once; every row is tested.
                    starts[0, both], sizes[0, both] = at_text[1], n
                    sizes[1, both] = 0
        return starts, sizes, np.concatenate(lists) if lists else np.zeros(0, np.int64)

    def matches(self, numbers: pa.Array, shown: pa.Array) -> Iterator[pa.Array]:
        """Lists of the matched rules: arrays for some rows each, in the order of the rows."""
        if self.fields:
            yield from self._matches(*self.read(numbers, shown))
        else:
            none = np.zeros((len(numbers), 0))
            yield from self._matches(none, none.astype(bool), none.astype(np.int64))

    def _matches(self, values, known, text) -> Iterator[pa.Array]:
        n = len(values)
        count = np.diff(self.first)
        starts, sizes, lists = self._slices(values, known, text)
        every = np.flatnonzero(count == 0)
        ruled = np.flatnonzero(count)
        total = sizes.sum(axis=0)
        # The most selective condition of each rule.
        least = np.minimum.reduceat(total, self.first[ruled]) if len(ruled) else total
        pairs = int(least.sum()) + n * len(every)
        if n > 1 and pairs > self.pairs:
            step = -(-n // min(n, -(-pairs // self.pairs)))
            for a in range(0, n, step):
                yield from self._matches(*(x[a : a + step] for x in (values, known, text)))
            return
        found_rows = [np.repeat(np.arange(n), len(every))]
        found_rules = [np.tile(every, n)]
        if len(ruled):
            owner = np.repeat(np.arange(len(ruled)), count[ruled])
            is_least = np.flatnonzero(total == least[owner])
            chosen = np.full(len(ruled), -1)
            chosen[owner[is_least][::-1]] = is_least[::-1]
            block = np.cumsum(least) // self.pairs
            for b in np.unique(block[least > 0]):
                mine = np.flatnonzero((block == b) & (least > 0))
                own = chosen[mine]
                both = np.concatenate([starts[0, own], starts[1, own]])
                widths = np.concatenate([sizes[0, own], sizes[1, own]])
                rows = lists[_ranges(both, widths)]
                rules = np.repeat(np.concatenate([ruled[mine], ruled[mine]]), widths)
                for k in range(int(count[ruled[mine]].max())):
                    has = count[rules] > k
                    at = self.first[rules[has]] + k
                    f = self.field[at]
                    keep = np.ones(len(rows), dtype=bool)
                    r = rows[has]
                    keep[has] = self.holds(at, values[r, f], known[r, f], text[r, f])
                    rows, rules = rows[keep], rules[keep]
                found_rows.append(rows)
                found_rules.append(rules)
        rows, rules = np.concatenate(found_rows), np.concatenate(found_rules)
        pairs = rows * len(count) + rules
        pairs = np.sort(pairs.astype(np.min_scalar_type(n * len(count))))
        bounds = np.searchsorted(pairs, np.arange(n + 1) * len(count)).astype(np.int32)
        rules = pairs - np.repeat(np.arange(n) * len(count), np.diff(bounds))
        yield pa.ListArray.from_arrays(pa.array(bounds), pa.array(rules.astype(np.int32)))


def matched_by_index(df: DataFrame, rules: list[Rule]) -> Column:
    """The indices of the matched rules in catalog order."""
    types = {f.name: f.dataType for f in df.schema.fields}
    index = RuleIndex(rules)
    readings = [field_reading(f, types) for f in index.fields]
    numbers = F.expr(sql.array([n for n, _ in readings] or ["0D"]))
    shown = F.expr(sql.array([t for _, t in readings] or ["'0'"]))

    @F.arrow_udf("array<int>")
    def find(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for numbers, shown in batches:
            yield from index.matches(numbers, shown)

    return find(numbers, shown)
