"""Exact percentage rates with half-even rounding, as Catalyst expressions.

Floating-point ``round`` is half-up in Spark and engine-dependent on binary
fractions, so rates are computed on integers: with ``n = num * 10^(2+digits)``,
``q = n div den`` and ``r = n - q * den``; ``q`` is bumped by one when ``2r > den``
or when ``2r == den`` and ``q`` is odd; the result is ``q / 10^digits``.
Everything stays JVM-side inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_even_percent(num, den, digits: int = 2) -> Column:
    """``round_half_even(num / den * 100, digits)`` computed exactly.

    Null when either side is null; ``0.0`` when ``den`` is 0 (no division by zero
    under ANSI mode).
    """
    num, den = _col(num).cast("long"), _col(den).cast("long")
    scale = 10 ** (2 + digits)
    n = num * F.lit(scale)
    q = F.call_function("div", n, den)
    r = n - q * den
    bump = F.when((r * 2 > den) | ((r * 2 == den) & (F.pmod(q, F.lit(2)) == 1)), 1).otherwise(0)
    value = (q + bump).cast("double") / F.lit(float(10 ** digits))
    return F.when(den.isNull() | num.isNull(), F.lit(None).cast("double")) \
        .when(den == 0, F.lit(0.0)) \
        .otherwise(value)


def rate_or_zero(num, den, digits: int = 2) -> Column:
    """Rate in percent; 0.0 when the divisor is 0 or missing (the '7.5' convention)."""
    return F.coalesce(half_even_percent(F.coalesce(_col(num), F.lit(0)),
                                        F.coalesce(_col(den), F.lit(0)), digits), F.lit(0.0))

