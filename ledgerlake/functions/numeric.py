"""Exact money arithmetic.

Rounding is half away from zero (``F.round`` on decimals, never ``bround``).  The cents
allocation works on integers so the result is exact and engine independent:
``round_half_up(n / d) = sign(n*d) * ((2*|n| + |d|) div (2*|d|))``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.functions.util import to_col


def round_half_up(c, scale: int = 2) -> Column:
    return F.round(to_col(c), scale)


def safe_ratio(x, s) -> Column:
    """``CASE WHEN s = 0 THEN 0 ELSE x / s END``."""
    s = to_col(s)
    return F.when(s == 0, F.lit(0)).otherwise(to_col(x) / s)


def ratio_or_null(x, s) -> Column:
    """``x / NULLIF(s, 0)``."""
    return F.try_divide(to_col(x), F.nullif(to_col(s), F.lit(0)))


def div_round_half_up(n, d) -> Column:
    """Integer quotient n/d rounded half away from zero; NULL when d = 0.

    Works on integral and ``decimal(p,0)`` operands: ``div`` is an integral division
    whose result is a long, so no double or capped-scale quotient is involved.  The
    operands may be wider than a long; the quotient must fit in one (cents do).
    """
    n, d = to_col(n), to_col(d)
    an, ad = F.abs(n), F.abs(d)
    mag = F.call_function("div", F.lit(2) * an + ad, F.lit(2) * ad)
    negative = (n < 0) != (d < 0)
    return F.when(d == 0, F.lit(None).cast("long")) \
        .when(negative, -mag).otherwise(mag).cast("long")


def to_cents(c) -> Column:
    """Decimal/double money -> integer cents, half up."""
    return F.round(to_col(c).cast("decimal(38,6)") * 100, 0).cast("long")


def allocate_cents(line_cents, sum_cents, header_cents) -> Column:
    """Proportional share of ``header - sum`` added to one line, in whole cents:
    ``cents + round_half_up(cents * (header - sum) / sum)``; NULL when sum = 0."""
    line, s, h = to_col(line_cents), to_col(sum_cents), to_col(header_cents)
    return line + div_round_half_up(line * (h - s), s)
