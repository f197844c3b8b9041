"""Reproducible uniform draws that depend only on a seed and tags.

MD5 is used because every SQL engine has it: a sample drawn here can be drawn again,
row for row, anywhere else, under any partitioning and after any task retry.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAW_BITS = 52  # 13 hexadecimal digits


def uniform(seed: int, *tags: Column | str | int) -> Column:
    """A double in [0, 1) from the text ``seed:tag:tag...``."""
    parts = [F.lit(str(seed))]
    parts += [t.cast("string") if isinstance(t, Column) else F.lit(str(t)) for t in tags]
    digits = F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, DRAW_BITS // 4)
    return F.conv(digits, 16, 10).cast("double") / float(2**DRAW_BITS)
