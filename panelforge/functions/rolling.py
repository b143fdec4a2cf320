"""Per-series window Column builders.

All builders take the series key(s) and order column(s) explicitly, so a
window is always partitioned (no global single-task windows).  Frames are
row-based, as in the reference: a rolling window of ``n`` counts rows of the
frame it is applied to, not calendar days.

Full-window rule (contract T2): an ``n``-row aggregate is NULL unless the frame
holds at least ``min_samples`` non-null values of the same expression
(default ``min_samples = n``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _list(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, (str, Column)) else list(x)


def asset_window(by: str | Sequence[str] = "barrid", order: str | Sequence[str] = "date") -> WindowSpec:
    """W(k) = partitionBy(k).orderBy(date)."""
    return Window.partitionBy(*_list(by)).orderBy(*_list(order))


_AGGS = {
    "sum": F.sum,
    "mean": F.avg,
    "avg": F.avg,
    "std": F.stddev_samp,
    "var": F.var_samp,
    "min": F.min,
    "max": F.max,
    "count": F.count,
}


def rolling(
    agg: str,
    x,
    n: int,
    by="barrid",
    order="date",
    min_samples: int | None = None,
) -> Column:
    """Aggregate over the last ``n`` rows (current row included) of each series; long
    windows are the business of ``functions.windows.rolling_columns``.

    A sliding frame at every ``n``: each window is summed on its own rows, so a
    value leaves no trace (no cancellation, no poisoning by a non-finite value)
    once it has left the window, and equal values have a deviation of exactly 0."""
    if n < 1:
        raise ValueError("window size must be >= 1")
    x = _c(x)
    need = n if min_samples is None else min_samples
    frame = asset_window(by, order).rowsBetween(-(n - 1), Window.currentRow)
    value = _AGGS[agg](x).over(frame)
    return F.when(F.count(x).over(frame) >= need, value)


def rolling_sum(x, n: int, by="barrid", order="date", min_samples: int | None = None) -> Column:
    return rolling("sum", x, n, by, order, min_samples)


def rolling_mean(x, n: int, by="barrid", order="date", min_samples: int | None = None) -> Column:
    return rolling("mean", x, n, by, order, min_samples)


def rolling_std(x, n: int, by="barrid", order="date", min_samples: int | None = None) -> Column:
    """Sample standard deviation (ddof = 1, contract T1); exactly 0 over a flat
    window (all values equal), whatever rounding the running update leaves."""
    frame = asset_window(by, order).rowsBetween(-(n - 1), Window.currentRow)
    flat = F.min(_c(x)).over(frame) == F.max(_c(x)).over(frame)
    value = F.stddev_samp(_c(x)).over(frame)
    need = n if min_samples is None else min_samples
    return F.when(F.count(_c(x)).over(frame) >= need, F.when(flat & value.isNotNull(), F.lit(0.0)).otherwise(value))


def lag(x, k: int = 1, by="barrid", order="date") -> Column:
    """Value ``k`` rows earlier in the series (the reference's ``shift(k)``)."""
    return F.lag(_c(x), k).over(asset_window(by, order))


def lead(x, k: int = 1, by="barrid", order="date") -> Column:
    """Value ``k`` rows later in the series (``shift(-k)``)."""
    return F.lead(_c(x), k).over(asset_window(by, order))


def forward_fill(x, by="barrid", order="date") -> Column:
    """Last non-null value up to the current row."""
    frame = asset_window(by, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.last(_c(x), ignorenulls=True).over(frame)
