"""Bayesian signal weights (P2), smoothing (P3) and rolling moments.

Rolling moments of the K signal-return series over the previous ``N`` rows
(current row excluded) are computed natively, from mergeable states of blocks of
N rows (row numbers come from per-year counts, so gaps in the calendar are
handled).  The K x K solve per date runs in ``mapInPandas`` as one batched
``numpy.linalg.solve`` per Arrow batch.

    weights_raw = N0 Sigma0^-1 mu0 + N Sigma^-1 x_bar      (= Sigma_n^-1 mu_n)
    w_norm      = weights_raw / sum |weights_raw|
    w           = softmax(w_norm)
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.functions.ewm import ewm_mean
from panelforge.functions.windows import merged_moments
from panelforge.operators.reshape import pivot_wide, unpivot_long

# Fixed configuration values of the combination step (signals, prior Sharpe
# ratios, pseudo-observations, likelihood window, prior daily variance).
WEIGHT_SIGNALS = ["beta", "barra_reversal", "ivol"]
PRIOR_SHARPES = [0.5, 0.5, 0.5]
N0 = 252 * 5
N = 252 * 5
DAILY_VAR = 1e-5
SMOOTH_SPAN = 252


def row_numbers(df: DataFrame, order: str = "date") -> DataFrame:
    """Adds ``_grn``, the 0-based number of each row of a single ordered series, from
    per-year counts: no window holds more than a year, but for one over the years."""
    yr = F.year(order)
    counts = df.groupBy(yr.alias("_src")).agg(F.count(F.lit(1)).alias("_c"))
    before = Window.orderBy("_src").rowsBetween(Window.unboundedPreceding, -1)  # one row per calendar year
    counts = counts.select("_src", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"))
    rows = df.withColumn("_src", yr).withColumn("_lrn", F.row_number().over(Window.partitionBy("_src").orderBy(order)) - 1)
    return rows.join(counts, "_src").withColumn("_grn", F.col("_before") + F.col("_lrn")).drop("_src", "_lrn", "_before")


def rolling_moments(wide: DataFrame, names: Sequence[str], n: int) -> DataFrame:
    """For each date from row ``n`` on, the mean of each series and the
    sample covariance of each pair over the previous ``n`` rows.  A window
    with a missing or NaN value leaves the moments NULL (NumPy gives NaN).

    Linear time, without differences: the series is cut into blocks of ``n`` rows, so
    a window is the end of one block and the beginning of the next.  Both have running
    states (count, means, centred sums of products; one runs backwards), which are
    merged; what has left the window, a spike or a NaN, leaves no trace.  Blocks run in
    parallel; a row sends its two states to the rows that they are for."""
    names = list(names)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    d = row_numbers(wide.select("date", *names)).withColumn("_blk", F.floor(F.col("_grn") / n))
    missing = [F.col(a).isNull() | F.isnan(a) for a in names]
    states = {"k": F.count(F.lit(1)), "bad": F.sum(F.greatest(*missing, F.lit(False)).cast("int"))}
    states |= {f"m_{a}": F.avg(a) for a in names}
    states |= {f"c_{a}__{b}": F.covar_pop(a, b) for a, b in pairs}
    block = Window.partitionBy("_blk")
    back = block.orderBy(F.col("_grn").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fore = block.orderBy("_grn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumns({f"_s_{k}": a.over(back) for k, a in states.items()}).withColumns({f"_p_{k}": a.over(fore) for k, a in states.items()})
    # to the next row the state of the block's beginning, to the n-th next that of its end
    sent = d.withColumn("_to", F.explode(F.array(F.lit(0), F.lit(1), F.lit(n))))
    only = lambda to, c: F.max(F.when(F.col("_to") == to, F.col(c)))
    met = sent.groupBy((F.col("_grn") + F.col("_to")).alias("_grn")).agg(
        only(0, "date").alias("date"), *[only(1, f"_p_{k}").alias(f"p_{k}") for k in states], *[only(n, f"_s_{k}").alias(f"s_{k}") for k in states])
    met = met.filter((F.col("_grn") >= n) & F.col("date").isNotNull())

    whole = F.col("_grn") % n == 0  # the window is a block
    n1, n2 = F.col("s_k"), F.when(whole, F.lit(0)).otherwise(F.col("p_k"))
    gap = {a: F.col(f"p_m_{a}") - F.col(f"s_m_{a}") for a in names}
    cols = {f"m_{a}": F.when(whole, F.col(f"s_m_{a}")).otherwise(F.col(f"s_m_{a}") + gap[a] * (n2 / n)) for a in names}
    for a, b in pairs:
        total = merged_moments(n1, gap[a], F.col(f"s_c_{a}__{b}") * n1, n2, gap[b], F.col(f"p_c_{a}__{b}") * n2)
        cols[f"c_{a}__{b}"] = total / (n - 1)
    ok = F.col("s_bad") + F.when(whole, F.lit(0)).otherwise(F.col("p_bad")) == 0
    return met.select("date", *[F.when(ok, e).alias(c) for c, e in cols.items()])


#: Largest condition number of a correlation matrix that is solved.
MAX_CONDITION = 1e12


def _solve_batches(names: Sequence[str], n0: int, n: int, daily_var: float, mu0: np.ndarray):
    k = len(names)
    prior = n0 * mu0 / daily_var  # N0 Sigma0^-1 mu0 with Sigma0 = daily_var I

    def run(batches):
        for pdf in batches:
            m = len(pdf)
            xbar = np.stack([pdf[f"m_{a}"].to_numpy(dtype=float) for a in names], axis=1) if m else np.zeros((0, k))
            cov = np.zeros((m, k, k))
            for i, a in enumerate(names):
                for j, b in enumerate(names):
                    key = f"c_{a}__{b}" if i <= j else f"c_{b}__{a}"
                    cov[:, i, j] = pdf[key].to_numpy(dtype=float)
            raw = np.full((m, k), np.nan)
            ok = np.isfinite(cov).all(axis=(1, 2)) & np.isfinite(xbar).all(axis=1)
            if ok.any():
                c = cov[ok]
                # solvable when the correlations are: free of the variances' scale and of K
                scale = np.sqrt(np.einsum("mii->mi", c))
                with np.errstate(divide="ignore", invalid="ignore"):
                    corr = c / (scale[:, :, None] * scale[:, None, :])
                good = np.isfinite(corr).all(axis=(1, 2))
                good[good] = np.linalg.cond(corr[good]) < MAX_CONDITION
                sol = np.full((c.shape[0], k), np.nan)
                if good.any():
                    sol[good] = np.linalg.solve(c[good], xbar[ok][good][..., None])[..., 0]
                raw[ok] = prior[None, :] + n * sol
            out = {"date": pdf["date"]}
            for i, a in enumerate(names):
                out[f"w_raw_{a}"] = raw[:, i]
            yield pd.DataFrame(out)

    return run


def signal_weight_table(signal_returns: DataFrame, names: Sequence[str] = WEIGHT_SIGNALS,
                        prior_sharpes: Sequence[float] = PRIOR_SHARPES, n0: int = N0, n: int = N,
                        daily_var: float = DAILY_VAR, start=None, end=None) -> DataFrame:
    """Per date, raw / L1-normalised / softmax weights of the signals.  The
    raw weight is the solved vector prior + n * covariance^-1 * mean (not the
    posterior mean by itself)."""
    names = list(names)
    sr = signal_returns.filter(F.col("signal_name").isin(names))
    if start is not None:
        sr = sr.filter(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        sr = sr.filter(F.col("date") <= F.lit(end).cast("date"))
    wide = pivot_wide(sr, ["date"], "signal_name", "forward_return", names)
    mom = rolling_moments(wide, names, n)
    mu0 = np.array(prior_sharpes, dtype=float) * math.sqrt(daily_var) / math.sqrt(252)
    schema = T.StructType([T.StructField("date", T.DateType())] +
                          [T.StructField(f"w_raw_{a}", T.DoubleType()) for a in names])
    raw = mom.mapInPandas(_solve_batches(names, n0, n, daily_var, mu0), schema)
    # NaN (singular / incomplete window) -> NULL, then native normalisation
    raw = raw.select("date", *[F.when(~F.isnan(f"w_raw_{a}"), F.col(f"w_raw_{a}")).alias(f"w_raw_{a}")
                               for a in names])
    l1 = sum((F.abs(F.col(f"w_raw_{a}")) for a in names[1:]), F.abs(F.col(f"w_raw_{names[0]}")))
    raw = raw.withColumns({f"w_norm_{a}": F.try_divide(F.col(f"w_raw_{a}"), l1) for a in names})
    mx = F.greatest(*[F.col(f"w_norm_{a}") for a in names]) if len(names) > 1 else F.col(f"w_norm_{names[0]}")
    raw = raw.withColumn("_mx", mx)
    ex = {a: F.exp(F.col(f"w_norm_{a}") - F.col("_mx")) for a in names}
    tot = sum(list(ex.values())[1:], list(ex.values())[0])
    raw = raw.withColumns({f"w_{a}": ex[a] / tot for a in names}).drop("_mx")
    return raw


def smooth_weights(table: DataFrame, names: Sequence[str] = WEIGHT_SIGNALS, span: float = SMOOTH_SPAN) -> DataFrame:
    """Long form (date, signal_name, weight) with each signal's softmax
    weight smoothed by an adjusted EWM of ``span`` rows (per signal)."""
    long = unpivot_long(table, ["date"], [f"w_{a}" for a in names], "signal_name", "weight", strip_prefix="w_")
    return ewm_mean(long, "weight", span, by="signal_name", order="date", min_samples=1)
