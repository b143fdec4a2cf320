"""Portfolio and combination operators.

Cross-sections are partitioned by (portfolio/signal, date); per-asset series by
(portfolio/signal, barrid); return series by portfolio.  No operator gathers a
whole table into one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.numeric import log1p_or_null, safe_div
from panelforge.operators.crosssection import attach_stats


def _list(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


# ------------------------------------------------------------------ G8
def benchmark_weights(df: DataFrame, cap: str = "market_cap", by: Sequence[str] = ("date",),
                      out: str = "benchmark_weight") -> DataFrame:
    """Cap weight inside each cross-section: cap / sum(cap)."""
    df = attach_stats(df, by, {"_bw_tot": F.sum(cap)})
    return df.withColumn(out, safe_div(F.col(cap), F.col("_bw_tot"))).drop("_bw_tot")


# ------------------------------------------------------------------ P5 / D6
def optimizer_panel(assets: DataFrame, alphas: DataFrame, signals: Sequence[str] | None = None,
                    keep=("specific_risk",), held: bool = False) -> DataFrame:
    """Universe rows with benchmark weight, predicted beta and alpha (missing
    alpha -> 0).  ``alphas``: (date, barrid, alpha), or with ``signals`` given,
    (date, barrid, signal_name, alpha) and one panel per listed signal (the
    alphas of an asset and day meet its universe row as a list, and the rows are
    repeated per name after that, so each universe row moves once).

    ``held`` adds what a position taken here earns: ``held_until``, the day of the
    asset's next panel row, and ``held_return``, the asset's returns (decimal) of that
    day added up.  Both come from the same pass along the asset."""
    keys = ["date", "barrid"]
    universe = F.col("in_universe") == F.lit(True)
    earned = F.when(F.col("date").isNotNull() & F.col("barrid").isNotNull(), F.col("return") / 100).alias("_ret")
    base = assets.filter(universe).select(
        "date", "barrid", "predicted_beta", "market_cap",
        *[(F.col(k) / 100).alias(k) if k == "specific_risk" else F.col(k) for k in keep],
        *([earned] if held else []),
    )
    base = benchmark_weights(base).drop("market_cap")
    found = alphas.dropna(subset=keys)  # an alpha without asset or day matches nothing
    if signals is not None:
        found = found.filter(F.col("signal_name").isin(list(signals)))
    of = ["signal_name"] if signals is not None else []
    # stacked and dealt out by asset once: the sort by asset and day is shared by all signals
    stacked = base.withColumn("_base", F.lit(True)).unionByName(found.select(*keys, F.struct(*of, "alpha").alias("_a")), allowMissingColumns=True)
    if held:  # returns of days on which the asset is outside the universe
        outside = assets.filter(~F.coalesce(universe, F.lit(False))).select(*keys, earned).dropna(subset=keys)
        stacked = stacked.unionByName(outside, allowMissingColumns=True)
    day, along = Window.partitionBy("barrid", "date"), Window.partitionBy("barrid").orderBy("date")
    met = {"_held": F.collect_list("_a").over(day)} | ({"_same": F.sum("_ret").over(day)} if held else {})
    j = stacked.repartition("barrid").withColumns(met).filter("_base")
    if held:
        j = j.withColumns({"_next": F.lead("date").over(along), "_next_same": F.lead("_same").over(along)})
    own = F.col("_held")
    if signals is not None:
        j = j.withColumn("signal_name", F.explode(F.array(*[F.lit(n) for n in signals])))
        own = F.filter("_held", lambda a: a["signal_name"] == F.col("signal_name"))
    # a row for each alpha, one where there is none
    j = j.withColumn("_mine", own).select("*", F.posexplode_outer("_mine").alias("_pos", "_own"))
    out = j.select("*", F.coalesce("_own.alpha", F.lit(0.0)).alias("alpha"))
    shown = [*keys, *of, *base.drop(*keys, "_ret").columns, "alpha"]
    if not held:
        return out.select(*shown)
    again = F.col("_pos") < F.size("_mine") - 1  # the next of several rows of the asset and day follows
    return out.select(*shown, F.when(again, F.col("date")).otherwise(F.col("_next")).alias("held_until"),
                      F.when(again, F.col("_same")).otherwise(F.col("_next_same")).alias("held_return"))


# ------------------------------------------------------------------ P6
def active_weights(panel: DataFrame, by: Sequence[str] = ("date",), zero_beta=True,
                   target_risk: float = 0.05, alpha: str = "alpha", beta: str = "predicted_beta",
                   risk: str = "specific_risk", out: str = "weight", method: str = "stats") -> DataFrame:
    """Mean-variance active weights per cross-section with diagonal (specific)
    risk, in closed form:

        w ~ (alpha - mu_0 - mu_1 beta) / sigma^2   with 1'w = 0 (and beta'w = 0)

    where mu solves the 2x2 (or 1x1) system of the constraint sums, then w is
    scaled so that sqrt(sum w^2 sigma^2) = target_risk.  ``zero_beta`` is a
    bool or a boolean Column (constraint set chosen per row, e.g. per signal).
    This re-aims the reference's external solver call (ZeroInvestment /
    ZeroBeta constraints, target active risk); it is not that solver's output.

    ``method="stats"`` (default): the per-cross-section sums are partial
    aggregates attached with a broadcast - the panel is never
    shuffled and a crowded cross-section cannot overload a task; the panel is
    read twice, so pass a materialised one.  ``method="window"``: one windowed
    pass (one shuffle by cross-section)."""
    zb = zero_beta if isinstance(zero_beta, Column) else F.lit(bool(zero_beta))
    iv = F.lit(1.0) / (F.col(risk) * F.col(risk))
    a, b = F.col(alpha), F.col(beta)
    sums = {"_n": F.count(F.lit(1)), "_s11": F.sum(iv), "_s1a": F.sum(a * iv), "_s1b": F.sum(b * iv),
            "_sbb": F.sum(b * b * iv), "_sba": F.sum(b * a * iv)}
    if method == "window":
        w = Window.partitionBy(*by)
        df = panel.withColumns({k: v.over(w) for k, v in sums.items()})
    else:
        df = attach_stats(panel, by, sums)
    det = F.col("_s11") * F.col("_sbb") - F.col("_s1b") * F.col("_s1b")
    mu0 = safe_div(F.col("_sbb") * F.col("_s1a") - F.col("_s1b") * F.col("_sba"), det)
    mu1 = safe_div(F.col("_s11") * F.col("_sba") - F.col("_s1b") * F.col("_s1a"), det)
    raw = F.when(zb, (a - mu0 - mu1 * b) * iv).otherwise((a - safe_div(F.col("_s1a"), F.col("_s11"))) * iv)
    df = df.withColumn("_raw", raw)
    r2 = F.sum(F.col("_raw") * F.col("_raw") * F.col(risk) * F.col(risk))
    if method == "window":
        df = df.withColumn("_risk2", r2.over(Window.partitionBy(*by)))
    else:
        df = attach_stats(df, by, {"_risk2": r2})
    scale = safe_div(F.lit(target_risk), F.sqrt(F.col("_risk2")))
    # with no more assets than constraints the only feasible portfolio is empty
    n_constraints = F.when(zb, F.lit(2)).otherwise(F.lit(1))
    df = df.withColumn(out, F.when(F.col("_n") > n_constraints, F.col("_raw") * scale).otherwise(F.lit(0.0)))
    return df.drop("_n", "_s11", "_s1a", "_s1b", "_sbb", "_sba", "_raw", "_risk2")


# ------------------------------------------------------------------ P1
def signal_returns(weights: DataFrame, assets: DataFrame, by: Sequence[str] = ("signal_name",),
                   out: str = "forward_return") -> DataFrame:
    """Weight lagged one row per (signal, asset), joined to the same-day return
    (decimal), summed per (signal, date); an all-null sum is 0.

    Weights and returns are stacked and dealt out by asset once; lag and match are
    both windows inside the asset (returns that share a key add up, as they would in
    a join; a return without asset or day matches nothing).  Weights of a panel that
    carries ``held_until`` and ``held_return`` (see ``optimizer_panel``) have met their
    return already: they are summed where they lie."""
    by = _list(by)
    if {"held_until", "held_return"} <= set(weights.columns):
        opened = F.struct("date", F.lit(None).cast("double").alias("_earned"))  # a day has its row, if it earns nothing
        closed = F.struct(F.col("held_until").alias("date"), (F.col("held_return") * F.col("weight")).alias("_earned"))
        moves = weights.select(*by, F.explode(F.array(opened, F.when(F.col("held_until").isNotNull(), closed))).alias("_m"))
        days = moves.filter(F.col("_m").isNotNull()).select(*by, "_m.*").groupBy(*by, "date")
        return days.agg(F.coalesce(F.sum("_earned"), F.lit(0.0)).alias(out))
    rets = assets.select("date", "barrid", (F.col("return") / 100).alias("_ret")).dropna(subset=["date", "barrid"])
    stacked = weights.select(*by, "date", "barrid", "weight", F.lit(True).alias("_held")).unionByName(rets, allowMissingColumns=True)
    dealt = stacked.repartition("barrid")
    lagged = dealt.withColumn("_lag", F.lag("weight", 1).over(Window.partitionBy("barrid", "_held", *by).orderBy("date")))
    met = lagged.withColumn("_same", F.sum("_ret").over(Window.partitionBy("barrid", "date"))).filter("_held")
    return met.groupBy(*by, "date").agg(F.coalesce(F.sum(F.col("_same") * F.col("_lag")), F.lit(0.0)).alias(out))


# ------------------------------------------------------------------ P7 / P8 / E1
def forward_returns(assets: DataFrame, universe_only: bool = True) -> DataFrame:
    """(date, barrid, market_cap, return) with return = next row's return / 100
    per asset (the reference's shift(-1) over barrid)."""
    a = assets.filter(F.col("in_universe") == F.lit(True)) if universe_only else assets
    w = Window.partitionBy("barrid").orderBy("date")
    return a.select("date", "barrid", "market_cap", F.lead(F.col("return") / 100, 1).over(w).alias("return"))


def weighted_return(df: DataFrame, by: Sequence[str] = ("date",), ret: str = "return",
                    weight: str = "weight", out: str = "return") -> DataFrame:
    """sum(return * weight) per group; an all-null group sums to 0."""
    return df.groupBy(*by).agg(F.coalesce(F.sum(F.col(ret) * F.col(weight)), F.lit(0.0)).alias(out))


def portfolio_returns(weights: DataFrame, fwd: DataFrame, portfolio: str = "portfolio") -> DataFrame:
    """Weights (date, barrid, weight) held from ``date`` earn the next return."""
    j = weights.join(fwd.select("date", "barrid", "return"), ["date", "barrid"], "left")
    return weighted_return(j).withColumn("portfolio", F.lit(portfolio))


def benchmark_returns(fwd: DataFrame, portfolio: str = "Benchmark") -> DataFrame:
    """Cap-weighted forward return per date."""
    b = benchmark_weights(fwd, out="weight")
    return weighted_return(b).withColumn("portfolio", F.lit(portfolio))


def cumulative_log_return(series: DataFrame, by: Sequence[str] = ("portfolio",), ret: str = "return",
                          out: str = "cumulative_return", block=F.year) -> DataFrame:
    """100 * running sum of log1p(return), per portfolio, in date order.

    The running sum is split by time block (``block`` maps the date to a block
    number, default the year): a running sum inside each (portfolio, block)
    partition plus the total of all earlier blocks, taken from a one-row-per-
    (portfolio, block) table.  No series is ever held by one task."""
    by = list(by)
    x = log1p_or_null(ret)
    df = series.withColumn("_cb", block(F.col("date")).cast("long")).withColumn("_cx", x)
    w_in = Window.partitionBy(*by, "_cb").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = df.groupBy(*by, "_cb").agg(F.sum("_cx").alias("_tot"))
    w_prev = Window.partitionBy(*by).orderBy("_cb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, "_cb", F.sum("_tot").over(w_prev).alias("_off"))
    df = df.withColumn("_run", F.sum("_cx").over(w_in)).join(offsets, [*by, "_cb"], "left")
    # NULL until the series has a value, as a plain running sum would be
    total = F.when(F.col("_run").isNotNull() | F.col("_off").isNotNull(),
                   F.coalesce(F.col("_off"), F.lit(0.0)) + F.coalesce(F.col("_run"), F.lit(0.0)))
    return df.withColumn(out, total * 100).drop("_cb", "_cx", "_run", "_off")


def active_returns(portfolio: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Portfolio minus benchmark return per date."""
    p = portfolio.select("date", F.col("return").alias("_p"))
    b = benchmark.select("date", F.col("return").alias("_b"))
    return p.join(b, "date", "inner").select("date", (F.col("_p") - F.col("_b")).alias("return"),
                                             F.lit("Active").alias("portfolio"))


# ------------------------------------------------------------------ E3
def performance_summary(series: DataFrame, by: Sequence[str] = ("portfolio",), ret: str = "return",
                        periods: int = 252) -> DataFrame:
    """Annualised mean (%), volatility (%, sample std) and Sharpe per portfolio."""
    g = series.groupBy(*by).agg(
        (F.avg(ret) * (periods * 100)).alias("mean_return"),
        (F.stddev_samp(ret) * (math.sqrt(periods) * 100)).alias("volatility"),
    )
    return g.withColumn("sharpe", safe_div(F.col("mean_return"), F.col("volatility")))


# ------------------------------------------------------------------ P4 / E2
def composite_alphas(alphas: DataFrame, weights: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Inner join alphas to signal weights on (date, signal_name) and sum
    alpha * weight per (date, barrid).  Weights that are NULL or NaN are
    dropped first."""
    wt = weights.filter(F.col("weight").isNotNull() & ~F.isnan("weight"))
    al = alphas
    if names is not None:
        wt = wt.filter(F.col("signal_name").isin(list(names)))
        al = al.filter(F.col("signal_name").isin(list(names)))
    # one weight per (date, signal): broadcast, so the alphas do not move to meet it
    j = al.join(F.broadcast(wt.select("date", "signal_name", "weight")), ["date", "signal_name"], "inner")
    return j.groupBy("date", "barrid").agg(
        F.coalesce(F.sum(F.col("alpha") * F.col("weight")), F.lit(0.0)).alias("alpha"))
