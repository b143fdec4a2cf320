"""Cross-sectional statistics without moving the panel.

A statistic per cross-section (per date, or per signal and date) is computed
with a partial + final aggregation (map-side combine, so a crowded date cannot
overload one task) and attached back with a broadcast join.  The stats table has one
row per cross-section - at most (signals x calendar days) rows, independent of the
number of assets.  The hint is needed: without it both sides are exchanged before
adaptive execution can measure the small one, and the panel has moved by then.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach_stats(df: DataFrame, by: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    stats = df.groupBy(*by).agg(*[c.alias(n) for n, c in aggs.items()])
    return df.join(F.broadcast(stats), list(by), "left")
