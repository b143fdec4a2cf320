"""Long rolling windows in linear time, from mergeable parts.

A series is cut into blocks of as many rows as the window.  A window is then the end
of one block and the beginning of the next: the aggregate of the rows from its first
row to its block's end, and that of the rows from the next block's first row to its
last.  Both are running aggregates (one backwards, one forwards), so a row costs the
same whatever the window, and the two parts are merged, never subtracted: a value
that has left the window, an outlier, a gap or a NaN, leaves no trace.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.rolling import _c, _list, asset_window, rolling, rolling_std

#: Rows up to which a plain sliding frame is used.
SHORT = 32

_STATES = {
    "count": F.count,
    "sum": F.sum,
    "avg": F.avg,
    "var": F.var_pop,
    "min": F.min,
    "max": F.max,
}
#: The states that an aggregate's parts need.
_NEEDS = {
    "count": ("count",),
    "sum": ("count", "sum"),
    "mean": ("count", "sum"),
    "avg": ("count", "sum"),
    "min": ("count", "min"),
    "max": ("count", "max"),
    "var": ("count", "avg", "var", "max"),
    "std": ("count", "avg", "var", "max"),
}


@dataclass(frozen=True)
class Rolled:
    """An aggregate over the last rows of a series; NULL unless the window holds
    ``min_samples`` (default: as many as it has rows) non-null values of ``x``."""

    agg: str
    x: str | Column
    min_samples: int | None = None


def merged_moments(n1: Column, m1: Column, c1: Column, n2: Column, m2: Column, c2: Column) -> Column:
    """Sum of squared (or cross) deviations of two parts together, from their counts,
    mean differences' factors and own sums; a part without rows adds nothing.

    ``m1`` and ``m2`` are the differences of the parts' means, one for each variable
    (the same twice for a variance)."""
    both = c1 + c2 + m1 * m2 * (n1 * n2 / (n1 + n2))
    return F.when(n1 == 0, c2).when(n2 == 0, c1).otherwise(both)


def _merge(agg: str, n: int, need: int, left: dict[str, Column], right: dict[str, Column]) -> Column:
    zero = F.lit(0)
    n1, n2 = F.coalesce(left["count"], zero), F.coalesce(right["count"], zero)
    enough = lambda value: F.when(n1 + n2 >= need, value)
    if agg == "count":
        return enough(n1 + n2)
    if agg in ("min", "max"):
        return enough((F.least if agg == "min" else F.greatest)(left[agg], right[agg]))
    if agg in ("sum", "mean", "avg"):
        total = F.when(n1 == 0, right["sum"]).when(n2 == 0, left["sum"]).otherwise(left["sum"] + right["sum"])
        return enough(total if agg == "sum" else F.try_divide(total, n1 + n2))
    # a part of equal values has exactly their mean, so a flat window's deviation is exactly 0
    mean = lambda s: F.when(s["var"] == 0, s["max"]).otherwise(s["avg"])
    own = lambda s, k: F.coalesce(s["var"], F.lit(0.0)) * k
    gap = mean(right) - mean(left)
    var = merged_moments(n1, gap, own(left, n1), n2, gap, own(right, n2)) / (n1 + n2 - 1)
    return enough(F.when(n1 + n2 > 1, F.sqrt(var) if agg == "std" else var))


def rolling_columns(df: DataFrame, n: int, rolled: dict[str, Rolled], by: str | Sequence[str] = "barrid",
                    order: str | Sequence[str] = "date") -> DataFrame:
    """``df`` with a column for each of ``rolled``, aggregated over the last ``n`` rows
    (current row included) of each series.  All share one pass."""
    if n < 1:
        raise ValueError("window size must be >= 1")
    by = _list(by)
    if n <= SHORT:
        short = lambda r: rolling_std if r.agg == "std" else lambda *a, **k: rolling(r.agg, *a, **k)
        return df.withColumns({out: short(r)(r.x, n, by=by, order=order, min_samples=r.min_samples) for out, r in rolled.items()})
    names: dict[str, str] = {}  # column of each distinct expression
    states: dict[tuple[str, str], Column] = {}
    values = {}
    for r in rolled.values():
        x = _c(r.x)
        name = names.setdefault(str(x), f"_rw_x{len(names)}")
        values[name] = x.cast("double") if r.agg in ("var", "std") else x
        states |= {(name, s): _STATES[s](F.col(name)) for s in _NEEDS[r.agg]}
    d = df.withColumns(values).withColumn("_rw_n", F.row_number().over(asset_window(by, order)) - 1)
    d = d.withColumn("_rw_b", F.floor(F.col("_rw_n") / n))
    block = Window.partitionBy(*by, "_rw_b")
    back = block.orderBy(F.col("_rw_n").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fore = block.orderBy("_rw_n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumns({f"_rw_s_{x}_{s}": a.over(back) for (x, s), a in states.items()})
    d = d.withColumns({f"_rw_p_{x}_{s}": a.over(fore) for (x, s), a in states.items()})
    # the window's first row is n - 1 rows back; it lies in the own block where that ends here
    far = Window.partitionBy(*by).orderBy("_rw_b", "_rw_n")
    d = d.withColumns({f"_rw_l_{x}_{s}": F.lag(f"_rw_s_{x}_{s}", n - 1).over(far) for x, s in states})
    two = F.col("_rw_n") % n != n - 1
    out = {}
    for name, r in rolled.items():
        x = names[str(_c(r.x))]
        left = {s: F.when(two, F.col(f"_rw_l_{x}_{s}")) for s in _NEEDS[r.agg]}
        right = {s: F.col(f"_rw_p_{x}_{s}") for s in _NEEDS[r.agg]}
        out[name] = _merge(r.agg, n, n if r.min_samples is None else r.min_samples, left, right)
    return d.select(*[F.col(f"`{c}`") for c in df.columns if c not in out], *[e.alias(c) for c, e in out.items()])
