"""Decoding of request texts to a fixpoint: percent signs, character references, overlong UTF-8.

A round undoes one layer:

1. ``%uXXXX``, ``\\uXXXX`` and ``\\xXX`` become character references, overlong spellings of ASCII
   (two bytes from C0 / C1, three bytes from E0 80 / E0 81) become plain percent signs;
2. ``%XX`` becomes its byte; bytes that are no UTF-8 become U+FFFD;
3. ``&#N;`` and ``&#xN;`` become their character, and five named references theirs.

Rounds go on until nothing changes, ``rounds`` at most; ``depth`` says how many rounds changed
the text, ``once`` is the text after the first round, and ``settled`` tells whether nothing was
left to undo.  What is malformed (a percent sign without two hex digits, a number beyond
Unicode or of a surrogate, an unknown name) is kept as it is, so every text has a result;
decoding makes a text shorter, so rounds come to an end.  Null stays null.  All is one JVM
expression, without shuffles or Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 8
# Named references that matter in markup.
NAMED = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")]
ESCAPES = [
    (r"(?i)(?:%u|\\u)([0-9a-f]{4})", "&#x$1;"),
    (r"(?i)\\x([0-9a-f]{2})", "&#x$1;"),
]
# An overlong spelling holds the two high bits of the ASCII code's first digit in its lead.
OVERLONG = [
    (f"(?i)(?:%c{lead}|%e0%8{lead})%{'89ab'[quarter]}([0-9a-f])", f"%{4 * lead + quarter}$1")
    for lead in (0, 1)
    for quarter in range(4)
]


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value evaluated once."""
    return F.transform(F.array(value), use)[0]


def _percent_parts(parts: Column) -> Column:
    def as_hex(part: Column) -> Column:
        digits = F.substring(part, 1, 2)
        rest = F.substring(part, F.lit(3), F.length(part))
        good = part.rlike("^[0-9A-Fa-f]{2}")
        return F.when(good, F.concat(digits, F.hex(rest))).otherwise(F.concat(F.lit("25"), F.hex(part)))

    tail = F.transform(F.slice(parts, F.lit(2), F.size(parts)), as_hex)
    return F.make_valid_utf8(
        F.unhex(F.concat(F.hex(parts[0]), F.array_join(tail, ""))).cast("string")
    )


def percent_decoded(text: Column) -> Column:
    return F.when(text.contains("%"), bound(F.split(text, "%", -1), _percent_parts)).otherwise(text)


def _reference(part: Column) -> Column:
    """A text that stood behind ``&#``."""
    number = F.regexp_extract(part, "^([xX][0-9A-Fa-f]{1,6}|[0-9]{1,7});", 1)

    def replaced(number: Column) -> Column:
        hexadecimal = F.conv(F.substring(number, F.lit(2), F.length(number)), 16, 10)
        code = F.when(F.lower(F.substring(number, 1, 1)) == "x", hexadecimal).otherwise(number)
        code = F.when(number != "", code).try_cast("long")
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        wide = F.unhex(F.lpad(F.hex(F.when(valid, code)), 8, "0"))
        rest = F.substring(part, F.length(number) + 2, F.length(part))
        return F.when(valid, F.concat(F.decode(wide, "UTF-32"), rest)).otherwise(
            F.concat(F.lit("&#"), part)
        )

    return bound(number, replaced)


def references_decoded(text: Column) -> Column:
    def numeric(parts: Column) -> Column:
        tail = F.transform(F.slice(parts, F.lit(2), F.size(parts)), _reference)
        return F.concat(parts[0], F.array_join(tail, ""))

    def named(text: Column) -> Column:
        for name, character in NAMED:
            text = F.replace(text, F.lit(name), F.lit(character))
        return text

    numbers = F.when(text.contains("&#"), bound(F.split(text, "&#", -1), numeric)).otherwise(text)
    return F.when(text.contains("&"), bound(numbers, named)).otherwise(text)


def one_round(text: Column) -> Column:
    def plain(text: Column) -> Column:
        for pattern, spelled in ESCAPES + OVERLONG:
            text = F.regexp_replace(text, pattern, spelled)
        return text

    special = text.rlike(r"(?i)\\[ux]|%u|%c[01]%|%e0%8[01]%")
    first = F.when(special, plain(text)).otherwise(text)
    return bound(bound(first, percent_decoded), references_decoded)


def decoded(text: Column, rounds: int = ROUNDS) -> Column:
    """struct(text, once, depth, settled)."""

    def state(text: Column, once: Column, depth: Column, settled: Column) -> Column:
        return F.struct(
            text.alias("text"), once.alias("once"), depth.alias("depth"), settled.alias("settled")
        )

    def again(held: Column, _: Column) -> Column:
        def compared(after: Column) -> Column:
            changed = after != held["text"]
            once = F.when(held["depth"] == 0, after).otherwise(held["once"])
            return state(after, once, held["depth"] + changed.cast("int"), ~changed)

        going = ~held["settled"] & held["text"].rlike(r"[%&\\]")
        stopped = state(held["text"], held["once"], held["depth"], F.lit(True))
        return F.when(going, bound(one_round(held["text"]), compared)).otherwise(stopped)

    start = state(text, text, F.lit(0), F.lit(False))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, again)
    return F.when(text.isNotNull(), found)
