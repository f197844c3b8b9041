"""Decimal rounding of doubles, correct to the last binary digit.

``round`` looks at the printed digits of a double and rounds ties up, so it can differ by
one unit from a correctly rounded result (0.00005 is stored slightly above or below the
tie).  The expression below recovers the exact error of ``value * 10^digits`` from a
two-part product and only then decides.
"""

from __future__ import annotations

from flowverdict.functions.sqltext import double


def round_exact(value: str, digits: int) -> str:
    """SQL for column ``value`` (a double) rounded half-to-even at ``digits`` decimals.

    ``value`` appears many times, so it should be a column and not a computation.
    """
    scale = double(10.0**digits)
    scaled = f"({value} * {scale})"
    # A float holds 24 bits, the rest at most 29: both partial products are exact.
    head = f"CAST(CAST({value} AS FLOAT) AS DOUBLE)"
    error = f"(({head} * {scale} - {scaled}) + ({value} - {head}) * {scale})"
    return (
        f"(CASE WHEN {scaled} - floor({scaled}) = 0.5D AND {error} <> 0D "
        f"THEN floor({scaled}) + IF({error} > 0D, 1, 0) ELSE rint({scaled}) END / {scale})"
    )
