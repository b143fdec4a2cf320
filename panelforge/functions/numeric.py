"""Null-safe scalar helpers (semantics contract T4-T6 in the README)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_div(num, den) -> Column:
    """x / y with NULL for a zero divisor (ANSI mode would raise)."""
    return F.try_divide(_c(num), _c(den))


def finite_or_null(x) -> Column:
    """NaN and infinities become NULL (a NaN compares above every number)."""
    x = _c(x)
    return F.when((x > float("-inf")) & (x < float("inf")), x)


def log1p_or_null(x) -> Column:
    """log(1 + x); NULL for x <= -1 and for non-finite x (the reference yields
    -inf / NaN there)."""
    x = _c(x)
    return F.when((x > -1) & (x < float("inf")), F.log1p(x))


def clip_keep_null(x, lower: float | None = None, upper: float | None = None) -> Column:
    """Clip into [lower, upper]; NULL stays NULL (greatest/least would skip it)."""
    x = _c(x)
    out = x
    if upper is not None:
        out = F.least(out, F.lit(float(upper)))
    if lower is not None:
        out = F.greatest(out, F.lit(float(lower)))
    return F.when(x.isNotNull(), out)
