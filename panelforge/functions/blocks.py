"""Row blocks with a halo, for per-series windows on series too large for one
task (a hot key).

Each series is cut into blocks of ``block_rows`` consecutive rows; a block
also receives the last ``halo`` rows of the previous block, so any window
looking back at most ``halo`` rows is exact for the block's own rows when it
is partitioned by (key, block).  Global row numbers come from per-(key, year)
counts and a running total over that small table - no window ever spans a
whole key.  ``running_counts`` adds, for the given columns, the exact number
of non-null values from the series start (for count guards such as an EWM's
``min_samples``), computed the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def block_series(df: DataFrame, by: Sequence[str], order: str, block_rows: int = 4096, halo: int = 512,
                 running_counts: Sequence[str] = (), coarse=F.year) -> DataFrame:
    """Adds ``_blk`` (own block), ``_tgt`` (block the copy belongs to; a row
    in the last ``halo`` rows of its block is copied into the next block) and
    ``_nn_<col>`` running non-null counts.  Keep own rows with
    ``_blk == _tgt`` after the windows."""
    if halo > block_rows:
        raise ValueError("halo must not exceed the block size")
    by = list(by)
    d = df.withColumn("_cy", coarse(F.col(order)).cast("long"))
    aggs = [F.count(F.lit(1)).alias("_cn")] + [F.count(c).alias(f"_cnn_{c}") for c in running_counts]
    counts = d.groupBy(*by, "_cy").agg(*aggs)
    before = Window.partitionBy(*by).orderBy("_cy").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        *by, "_cy", F.coalesce(F.sum("_cn").over(before), F.lit(0)).alias("_cb"),
        *[F.coalesce(F.sum(f"_cnn_{c}").over(before), F.lit(0)).alias(f"_cbn_{c}") for c in running_counts])
    d = d.join(counts, [*by, "_cy"], "left")
    wy = Window.partitionBy(*by, "_cy").orderBy(order)
    run = wy.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("_grn", F.col("_cb") + F.row_number().over(wy) - 1)
    d = d.withColumns({f"_nn_{c}": F.col(f"_cbn_{c}") + F.count(c).over(run) for c in running_counts})
    d = d.withColumn("_blk", F.floor(F.col("_grn") / block_rows))
    copies = F.when(F.col("_grn") % block_rows >= block_rows - halo,
                    F.array(F.col("_blk"), F.col("_blk") + 1)).otherwise(F.array(F.col("_blk")))
    d = d.withColumn("_tgt", F.explode(copies))
    return d.drop("_cy", "_cb", *[f"_cbn_{c}" for c in running_counts])


def forward_fill_blocked(df: DataFrame, cols: Sequence[str], by: Sequence[str], order: str = "date",
                         bucket=F.year) -> DataFrame:
    """Forward fill of ``cols`` per series, run per (key, time bucket): the fill
    inside each bucket, then the last non-null value of the earlier buckets
    from a one-row-per-(key, bucket) table.  Equal to a plain forward fill."""
    by = list(by)
    d = df.withColumn("_fb", bucket(F.col(order)).cast("long"))
    inside = Window.partitionBy(*by, "_fb").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumns({f"_ff_{c}": F.last(c, ignorenulls=True).over(inside) for c in cols})
    last_in_bucket = d.groupBy(*by, "_fb").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_lb_{c}") for c in cols])
    prev = Window.partitionBy(*by).orderBy("_fb").rowsBetween(Window.unboundedPreceding, -1)
    carry = last_in_bucket.select(*by, "_fb", *[F.last(f"_lb_{c}", ignorenulls=True).over(prev).alias(f"_cy_{c}")
                                                for c in cols])
    d = d.join(carry, [*by, "_fb"], "left")
    d = d.withColumns({c: F.coalesce(F.col(f"_ff_{c}"), F.col(f"_cy_{c}")) for c in cols})
    return d.drop("_fb", *[f"_ff_{c}" for c in cols], *[f"_cy_{c}" for c in cols])
