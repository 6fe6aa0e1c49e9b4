"""Numeric helpers as built-in Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even(c, scale: int = 0) -> Column:
    """Banker's rounding (``bround``); ``round`` would round half up."""
    return F.bround(_c(c), scale)


def log1p(c) -> Column:
    """ln(1+x); x ≤ −1 gives NULL."""
    return F.log1p(_c(c))


def clip(c, lo, hi) -> Column:
    """Clip to [lo, hi] keeping NULL (``least(5, NULL)`` would be 5)."""
    c = _c(c)
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(
        F.greatest(F.lit(lo), F.least(F.lit(hi), c)))


def nullif_zero(c) -> Column:
    return F.nullif(_c(c), F.lit(0.0))


def safe_div(a, b) -> Column:
    """a / b with a zero denominator treated as missing."""
    return F.try_divide(_c(a), nullif_zero(b))


def floor_one_div(a, b) -> Column:
    """a / max(b, 1) (scoring form); NULL stays NULL."""
    b = _c(b)
    return _c(a) / F.when(b.isNull(), F.lit(None).cast("double")).otherwise(
        F.greatest(b, F.lit(1.0)))


def row_sum(cols) -> Column:
    """Row-wise sum where a missing value counts as 0."""
    out = F.lit(0.0)
    for c in cols:
        out = out + F.coalesce(_c(c), F.lit(0.0))
    return out


def nullify_nonfinite(c) -> Column:
    """NaN, +inf and −inf become NULL."""
    c = _c(c)
    return F.when(F.abs(c) < F.lit(float("inf")), c)      # NaN is above infinity in Spark


def clamp_amount(c) -> Column:
    """max(0, round(x, 2)) with NaN/NULL → 0 (as Python's max(0, nan))."""
    c = _c(c)
    r = F.bround(c, 2)
    return F.when(c.isNull() | F.isnan(c) | (r < 0), F.lit(0.0)).otherwise(r)
