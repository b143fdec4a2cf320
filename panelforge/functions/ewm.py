"""Exponentially weighted mean (adjusted form) as native Spark windows.

    y_t = sum_{i <= t, x_i not null} q^(t-i) x_i / sum_{i <= t, x_i not null} q^(t-i)
    q   = 1 - alpha,  alpha = 2 / (span + 1)

Output is NULL where x_t is NULL or fewer than ``min_samples`` non-null values
have been seen; a NULL still consumes one decay step (positions are absolute).

A running sum of q^(-i) x_i would overflow on long histories, so the series is
cut into blocks of ``B`` rows ("block carry"):

1. inside a block, running sums of q^(-r) x and q^(-r) [x not null] with
   r < B (bounded scale, no overflow);
2. each block's totals, scaled to its last position, are carried into the next
   blocks: a range frame over the block number collects the totals of the
   previous ``L`` blocks (one entry per block), where q^(B L) is below double
   precision, and folds them with ``aggregate``.

Everything stays inside the series partition: three sorts, no shuffle beyond
the one on the series key, O(n * L) work.  The whole series is never gathered
into one row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _list(x) -> list:
    return [x] if isinstance(x, str) else list(x)


def ewm_params(span: float) -> tuple[float, int, int]:
    """(q, block size B, carried blocks L) for a span."""
    if span < 1:
        raise ValueError("span must be >= 1")
    q = 1.0 - 2.0 / (span + 1.0)
    if q <= 0.0:
        return 0.0, 1, 0
    decay = -math.log10(q)  # digits lost per row
    block = int(max(1, min(256, math.floor(150.0 / decay))))
    carried = int(math.ceil(20.0 / (block * decay)))
    return q, block, carried


def ewm_mean(
    df: DataFrame,
    x: str,
    span: float,
    by: str | Sequence[str] = "barrid",
    order: str | Sequence[str] = "date",
    min_samples: int = 1,
    out: str | None = None,
    count_col: str | None = None,
) -> DataFrame:
    """Add ``out`` (default ``x``) = adjusted EWM mean of ``x`` per series ``by``.

    ``count_col``: a column holding the number of non-null values of ``x``
    from the true series start (when ``by`` splits a series into halo blocks);
    by default it is counted inside the partition."""
    by, order = _list(by), _list(order)
    out = out or x
    q, B, L = ewm_params(span)
    xc = F.col(x)
    w = Window.partitionBy(*by).orderBy(*order)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumn("_ewm_rn", F.row_number().over(w) - 1).withColumn(
        "_ewm_cnt", F.count(xc).over(running) if count_col is None else F.col(count_col)
    )
    if q == 0.0:  # span 1: weight only on the current row
        return df.withColumn(out, F.when(xc.isNotNull() & (F.col("_ewm_cnt") >= min_samples), xc)).drop(
            "_ewm_rn", "_ewm_cnt"
        )
    lq = math.log(q)
    df = (
        df.withColumn("_ewm_blk", F.floor(F.col("_ewm_rn") / B))
        .withColumn("_ewm_r", F.col("_ewm_rn") % B)
        .withColumn("_ewm_scale", F.exp(-F.col("_ewm_r") * lq))
        .withColumn("_ewm_sx", xc * F.col("_ewm_scale"))
        .withColumn("_ewm_sm", F.when(xc.isNotNull(), F.col("_ewm_scale")))
    )
    wb = Window.partitionBy(*by, "_ewm_blk").orderBy("_ewm_rn")
    in_block = wb.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole_block = wb.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    end_scale = q ** (B - 1)
    df = (
        df.withColumn("_ewm_an", F.coalesce(F.sum("_ewm_sx").over(in_block), F.lit(0.0)))
        .withColumn("_ewm_ad", F.coalesce(F.sum("_ewm_sm").over(in_block), F.lit(0.0)))
        .withColumn(
            "_ewm_mark",
            F.when(
                F.col("_ewm_r") == 0,
                F.struct(
                    F.col("_ewm_blk").alias("b"),
                    (F.coalesce(F.sum("_ewm_sx").over(whole_block), F.lit(0.0)) * end_scale).alias("n"),
                    (F.coalesce(F.sum("_ewm_sm").over(whole_block), F.lit(0.0)) * end_scale).alias("d"),
                ),
            ),
        )
    )
    carry_frame = Window.partitionBy(*by).orderBy("_ewm_blk").rangeBetween(-L, -1)
    qb = q**B
    fold = F.aggregate(
        F.collect_list("_ewm_mark").over(carry_frame),
        F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("d")),
        lambda acc, s: F.struct(
            (acc["n"] + F.pow(F.lit(qb), F.col("_ewm_blk") - 1 - s["b"]) * s["n"]).alias("n"),
            (acc["d"] + F.pow(F.lit(qb), F.col("_ewm_blk") - 1 - s["b"]) * s["d"]).alias("d"),
        ),
    )
    df = df.withColumn("_ewm_carry", fold)
    head = F.exp((F.col("_ewm_r") + 1) * lq)  # q^(r+1)
    body = F.exp(F.col("_ewm_r") * lq)  # q^r
    num = head * F.col("_ewm_carry.n") + body * F.col("_ewm_an")
    den = head * F.col("_ewm_carry.d") + body * F.col("_ewm_ad")
    df = df.withColumn(
        out, F.when(xc.isNotNull() & (F.col("_ewm_cnt") >= min_samples), F.try_divide(num, den))
    )
    return df.drop(
        "_ewm_rn", "_ewm_cnt", "_ewm_blk", "_ewm_r", "_ewm_scale", "_ewm_sx", "_ewm_sm",
        "_ewm_an", "_ewm_ad", "_ewm_mark", "_ewm_carry",
    )
