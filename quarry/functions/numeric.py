"""Lossless sums, averages and rounding.

Floating-point sums depend on the order rows arrive in, which changes with
partitioning.  A value with at most two decimals (ratings in halves, money in
cents) is therefore summed as a decimal; every other value -- more decimals,
very large, NaN or infinite -- is summed as the double it is, in a second
column.  Both sums are added once, at the end: clean data gives the same result
on any cluster layout, and no value is rounded, lost or refused.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def lossless(value: Column | str, dtype: T.DataType | None = None, scale: int = 2) -> tuple[Column, Column]:
    """(exact, rest): the value as decimal(18, scale) where that is the same
    number, and as a double where it is not; one of them is null.  A column
    that is decimal already (``dtype``) is exact as it is; 18 digits keep the
    Long-backed fast path."""
    v = _col(value)
    if isinstance(dtype, T.DecimalType):
        return v, F.lit(None).cast("double")
    exact = v.try_cast(f"decimal(18,{scale})")
    same = F.coalesce(exact.cast("double") == v.cast("double"), F.lit(False))
    return F.when(same, exact), F.when(~same, v.cast("double"))


def total(exact: Column | str, rest: Column | str) -> Column:
    """The sum of both parts as a double; null when both are."""
    e, r = _col(exact).cast("double"), _col(rest)
    return F.when(e.isNotNull() & r.isNotNull(), e + r).otherwise(F.coalesce(e, r))


def ratio(total: Column | str, count: Column | str) -> Column:
    """double(total) / count, null when count is 0."""
    n = _col(count)
    return F.when(n > 0, _col(total).cast("double") / n.cast("double"))


def round_half_up(value: Column | str, digits: int = 2) -> Column:
    """HALF_UP rounding of the double, in one step."""
    return F.round(_col(value).cast("double"), digits)


def round_ratio(exact: Column | str, rest: Column | str | None, count: Column | str) -> Column:
    """sum / count at two decimals, HALF_UP: of the true quotient by whole-number
    arithmetic where the sum is exact, else of the double.  Null when count is 0."""
    e, n = _col(exact), _col(count).cast("decimal(20,0)")
    cents = F.call_function("div", e * 200 + F.when(e < 0, -n).otherwise(n), n * 2)
    quotient = F.when(n > 0, cents.cast("double") / 100.0)
    if rest is None:
        return quotient
    return F.when(_col(rest).isNull(), quotient).otherwise(round_half_up(ratio(total(e, rest), count)))


def round_python(value: Column | str) -> Column:
    """Two decimals as Python's ``format(x, '.2f')`` rounds: by the exact binary
    value, and to even only where that lies exactly in the middle.

    A double whose shortest text ends in a 5 at the third decimal is the one
    nearest to that tie t / 1000.  The sign of x * 1000 - t is exact when x is
    split into two halves whose products with 1000 are exact.
    """
    x = _col(value).cast("double")
    t = F.round(x * 1000.0, 0)
    spread = x * 134217729.0  # 2**27 + 1
    high = spread - (spread - x)
    above = (high * 1000.0 - t) + (x - high) * 1000.0
    tie = (F.abs(x) < 1e12) & (t / 1000.0 == x) & (F.abs(t) % 10.0 == 5.0)
    up, down = (t + 5.0) / 1000.0, (t - 5.0) / 1000.0
    even = F.when(F.abs((t + 5.0) / 10.0) % 2.0 == 0.0, up).otherwise(down)
    return F.when(tie, F.when(above > 0, up).when(above < 0, down).otherwise(even)).otherwise(F.round(x, 2))
