"""Exact decimal money arithmetic.

Money is decimal(18,2), FX rates decimal(18,4). Every USD measure is rounded
to cents once per line (half away from zero), sums are decimal(38,2), and a
ratio is the exact quotient of its operands rounded once.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
RATE = "decimal(18,4)"
TOTAL = "decimal(38,2)"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def money(x) -> Column:
    return _c(x).cast(MONEY)


def round_money(x) -> Column:
    return F.round(_c(x), 2).cast(MONEY)


def total(x) -> Column:
    """Sum of a money/int column as decimal(38,2)."""
    return F.sum(_c(x)).cast(TOTAL)


def ratio(num, den, scale: int = 2, times: int = 1, zero=None) -> Column:
    """round(num / den * times, scale), half away from zero: the exact quotient
    rounded once, by one rule for operands of any size.

    Long division in whole cents: the integer part, then `scale` digits of
    the remainder, each an exact multiple of the divisor, then half up on what is
    left. A zero or NULL denominator gives NULL (NULLIF form) unless `zero` is
    set, which gives that value instead (DIVIDE(a, b, 0) form).
    """
    out_type = f"decimal(38,{scale})"
    num_c, den_c = _c(num).cast(TOTAL), _c(den).cast(TOTAL)

    def whole(x: Column) -> Column:
        return x.cast("decimal(38,0)")

    shift = F.lit(times * 10 ** scale).cast("decimal(9,0)")
    a, b = whole(F.abs(num_c) * 100), whole(F.nullif(F.abs(den_c), F.lit(0)) * 100)
    rest = whole(a % b)
    digits = whole(rest * shift)
    last = whole(digits % b)
    up = F.when(last * 2 >= b, 1).otherwise(0).cast("decimal(1,0)")
    q = whole(whole((a - rest) / b) * shift) + whole((digits - last) / b) + up
    q = F.when((num_c < 0) != (den_c < 0), -q).otherwise(q)
    q = (whole(q) * F.lit(Decimal(1).scaleb(-scale))).cast(out_type)
    if zero is not None:
        q = F.coalesce(q, F.lit(zero).cast(out_type))
    return q


def pct(num, den, scale: int = 2, zero=None) -> Column:
    """Percentage num / den * 100 rounded to `scale` decimals."""
    return ratio(num, den, scale=scale, times=100, zero=zero)
