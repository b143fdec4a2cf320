"""Signals, scorers and alphas.

A signal is a function ``DataFrame -> DataFrame`` that adds one column named
after the signal, computed per asset over the date-ordered universe rows (all
signals share one partitioning on ``barrid``).  Scorers and alphatizers work on
the long form (date, barrid, signal_name, signal_value, ...): cross-sections
are partitioned by (signal_name, date), per-asset statistics by
(signal_name, barrid), so one pass serves every registered signal.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.ewm import ewm_mean
from panelforge.functions.numeric import clip_keep_null, finite_or_null, log1p_or_null, safe_div
from panelforge.functions.rolling import lag, rolling_sum
from panelforge.functions.windows import Rolled, rolling_columns
from panelforge.operators.crosssection import attach_stats

ASSET = "barrid"
DATE = "date"
CARRY = ["price", "daily_volume", "specific_risk", "predicted_beta"]
SAME = "_same"  # rows that share a row's key, for the tables that refuse them


# ----------------------------------------------------------------- preparation
def signal_input(assets: DataFrame) -> DataFrame:
    """Universe rows with return, specific_return, specific_risk as decimals."""
    return (
        assets.filter(F.col("in_universe") == F.lit(True))
        .select(DATE, ASSET, "price", "return", "specific_return", "specific_risk",
                "predicted_beta", "daily_volume")
        .withColumns({c: finite_or_null(c) for c in ("price", "predicted_beta", "daily_volume")})
        .withColumns({
            "return": finite_or_null("return") / 100,
            "specific_return": finite_or_null("specific_return") / 100,
            "specific_risk": finite_or_null("specific_risk") / 100,
        })
    )


# ----------------------------------------------------------------- signals
def _col_signal(name: str, expr: Callable[..., Column]) -> Callable[..., DataFrame]:
    return lambda df, by=None, **_: df.withColumn(name, expr(by=by))


def _window_column(agg: str, x: str, log: bool, n: int) -> dict[str, Rolled]:
    """A rolling column by a name that says what it is, so that signals can share it."""
    return {f"_{agg}{n}_{'log_' if log else ''}{x}": Rolled(agg, log1p_or_null(x) if log else F.col(x))}


def add_windows(df: DataFrame, n: int, rolled: dict[str, Rolled], by=None) -> DataFrame:
    """The rolling columns that ``df`` does not have yet, in one pass."""
    missing = {name: r for name, r in rolled.items() if name not in df.columns}
    return rolling_columns(df, n, missing, by=list(by or [ASSET]), order=DATE) if missing else df


def momentum_windows(window: int = 230) -> dict[str, Rolled]:
    return _window_column("sum", "return", True, window)


def momentum(df: DataFrame, window: int = 230, skip: int = 22, name: str = "momentum", by=None, **_) -> DataFrame:
    """H1: lag_skip( rolling_sum_window( log1p(return) ) )."""
    (total,) = rolled = momentum_windows(window)
    return add_windows(df, window, rolled, by).withColumn(name, lag(total, skip, by=list(by or [ASSET])))


def reversal_expr(window: int = 22, by=None) -> Column:
    """H2: -rolling_sum_window( log1p(return) )."""
    return -rolling_sum(log1p_or_null("return"), window, by=list(by or [ASSET]))


def beta_expr(by=None) -> Column:
    """H3: -predicted_beta."""
    return -F.col("predicted_beta")


def barra_reversal(df: DataFrame, span: int = 5, min_samples: int = 5, name: str = "barra_reversal",
                   by=None, count_col: str | None = None, **_) -> DataFrame:
    """H4: lag1( -ewm_mean_span( specific_return ) )."""
    by = list(by or [ASSET])
    df = ewm_mean(df, "specific_return", span, by=by, order=DATE, min_samples=min_samples, out="_ewm_sr",
                  count_col=count_col)
    return df.withColumn(name, lag(-F.col("_ewm_sr"), 1, by=by)).drop("_ewm_sr")


def barra_momentum_windows(window: int = 230) -> dict[str, Rolled]:
    return _window_column("sum", "specific_return", True, window) | _window_column("std", "specific_return", False, window)


def barra_momentum(df: DataFrame, window: int = 230, skip: int = 21, name: str = "barra_momentum",
                   by=None, **_) -> DataFrame:
    """H5: lag_skip( rolling_sum(log1p(sr)) / rolling_std(sr) ), both over
    ``window`` rows with the full-window rule."""
    total, deviation = rolled = barra_momentum_windows(window)
    df = add_windows(df, window, rolled, by).withColumn("_bm_ratio", safe_div(F.col(total), F.col(deviation)))
    return df.withColumn(name, lag("_bm_ratio", skip, by=list(by or [ASSET]))).drop("_bm_ratio")


def ivol_expr(by=None) -> Column:
    """H6: lag1( -specific_risk )."""
    return lag(-F.col("specific_risk"), 1, by=list(by or [ASSET]))


# ----------------------------------------------------------------- scorers
def zscore(df: DataFrame, value: str = "signal_value", by: Sequence[str] = ("signal_name", DATE),
           out: str = "score", **_) -> DataFrame:  # block options do not apply to cross-sections
    """Cross-sectional z-score, sample std (one row -> NULL, std 0 -> NULL).
    Mean and std come from a partial aggregation per cross-section, attached
    back by a broadcast join (see ``operators.crosssection``)."""
    v = F.col(value)
    df = attach_stats(df, by, {"_zs_m": F.avg(v), "_zs_s": F.stddev_samp(v)})
    return df.withColumn(out, safe_div(v - F.col("_zs_m"), F.col("_zs_s"))).drop("_zs_m", "_zs_s")


def win_zscore(df: DataFrame, value: str = "signal_value", by: Sequence[str] = ("signal_name", DATE),
               asset_by: Sequence[str] = ("signal_name", ASSET), clip: float = 2.0, window: int = 252,
               block_rows: int | None = None, halo: int = 256) -> DataFrame:
    """H8: z-score clipped to [-clip, clip]; volume_score = standardised
    log1p(daily_volume * price) against its trailing ``window``-row mean / std
    (std NULL -> 1, floored at 1e-4; result NULL -> 0)."""
    df = zscore(df, value, by, "_z").withColumn("score", clip_keep_null("_z", -clip, clip)).drop("_z")
    dv = log1p_or_null(F.col("daily_volume") * F.col("price"))
    df = df.withColumn("dollar_volume", dv)
    part = list(asset_by)
    cols = df.columns
    if block_rows is not None:  # hot keys: per (signal, asset, row block) with a halo
        from panelforge.functions.blocks import block_series

        if halo < window - 1:
            raise ValueError("halo must cover the rolling window")
        df = block_series(df, part, DATE, block_rows, halo)
        part = part + ["_tgt"]
    rolled = {"dollar_volume_mean": Rolled("mean", "dollar_volume", 1), "dollar_volume_std": Rolled("std", "dollar_volume", 2)}
    df = rolling_columns(df, window, rolled, by=part, order=DATE)
    if block_rows is not None:
        df = df.filter(F.col("_blk") == F.col("_tgt")).select(*cols, "dollar_volume_mean", "dollar_volume_std")
    denom = F.greatest(F.coalesce(F.col("dollar_volume_std"), F.lit(1.0)), F.lit(0.0001))
    vs = F.coalesce((F.col("dollar_volume") - F.col("dollar_volume_mean")) / denom, F.lit(0.0))
    return df.withColumn("volume_score", vs)


# ----------------------------------------------------------------- alphatizers
def alpha_ic(df: DataFrame, ic: float = 0.05) -> DataFrame:
    """H9: alpha = score * ic * specific_risk."""
    return df.withColumn("alpha", F.col("score") * F.lit(ic) * F.col("specific_risk"))


def alpha_gated(df: DataFrame, ic: float = 0.05, gate: float = 2.0) -> DataFrame:
    """Alpha 0 where score == gate and volume_score >= gate, else H9."""
    base = F.col("score") * F.lit(ic) * F.col("specific_risk")
    cond = (F.col("score") == F.lit(gate)) & (F.col("volume_score") >= F.lit(gate))
    return df.withColumn("alpha", F.when(cond, F.lit(0.0)).otherwise(base))


# ----------------------------------------------------------------- registry
# rows after which the weight of a value in the 5-row EWM is below 2^-50
EWM_LOOKBACK = 100


@dataclass(frozen=True)
class SignalSpec:
    name: str
    compute: Callable[[DataFrame], DataFrame]
    scorer: Callable[..., DataFrame]
    alphatizer: Callable[..., DataFrame]
    constraints: Sequence[str] = field(default_factory=tuple)
    lookback: int = 0  # earlier rows of the asset that a value depends on
    windows: dict[int, Callable[[], dict[str, Rolled]]] = field(default_factory=dict)  # long windows that ``compute`` reads, by their rows


def default_signals() -> dict[str, SignalSpec]:
    both = ("ZeroBeta", "ZeroInvestment")
    return {
        "momentum": SignalSpec("momentum", momentum, zscore, alpha_ic, both, 251, {230: momentum_windows}),
        "reversal": SignalSpec("reversal", _col_signal("reversal", reversal_expr), zscore, alpha_ic, both, 21),
        "beta": SignalSpec("beta", _col_signal("beta", beta_expr), zscore, alpha_ic, ("ZeroInvestment",)),
        "barra_reversal": SignalSpec("barra_reversal", barra_reversal, win_zscore, alpha_gated, both, EWM_LOOKBACK),
        "barra_momentum": SignalSpec("barra_momentum", barra_momentum, zscore, alpha_ic, both, 250, {230: barra_momentum_windows}),
        "ivol": SignalSpec("ivol", _col_signal("ivol", ivol_expr), zscore, alpha_ic, both, 1),
    }


SIGNALS = default_signals()


def signal_columns(inp: DataFrame, names: Sequence[str] | None = None,
                   registry: dict[str, SignalSpec] | None = None,
                   block_rows: int | None = None, halo: int = 512, count_col: str | None = None) -> DataFrame:
    """Wide frame: one column per signal (one shared per-asset partitioning).

    ``count_col``: the specific returns that a series holds up to each row, where it
    began before ``inp`` (it then needs the rows that the signals look back to).

    ``block_rows``: for assets whose series is too long for one task, run the
    windows per (asset, block of rows) with a ``halo``-row look-back (see
    ``functions.blocks``).  A signal that looks back further than the halo is
    refused, and the EWM keeps its exact sample count, so results are unchanged."""
    reg = registry or SIGNALS
    names = list(names or reg)
    windows: dict[int, dict[str, Rolled]] = {}  # of one length together, for all signals
    for n in names:
        for rows, rolled in reg[n].windows.items():
            windows.setdefault(rows, {}).update(rolled())
    if block_rows is None:
        out = inp
        for rows, rolled in windows.items():
            out = add_windows(out, rows, rolled)
        for n in names:
            out = reg[n].compute(out, count_col=count_col) if count_col else reg[n].compute(out)
        return out.drop(*[c for rolled in windows.values() for c in rolled])
    from panelforge.functions.blocks import block_series

    far = {n: reg[n].lookback for n in names if reg[n].lookback > halo}
    if far:
        raise ValueError(f"signals look back further than the halo of {halo} rows: {far}")
    cols = inp.columns
    out = block_series(inp, [ASSET], DATE, block_rows, halo, running_counts=["specific_return"])
    for rows, rolled in windows.items():
        out = add_windows(out, rows, rolled, [ASSET, "_tgt"])
    for n in names:
        out = reg[n].compute(out, by=[ASSET, "_tgt"], count_col="_nn_specific_return")
    return out.filter(F.col("_blk") == F.col("_tgt")).select(*cols, *names)


def with_key_counts(wide: DataFrame, names: Sequence[str]) -> DataFrame:
    """Column ``SAME``: of the signals of the row's (date, asset), how often the most
    frequent one will be in the long form.  The rows lie by asset already, so they are
    not moved for it."""
    seen = F.col("predicted_beta").isNotNull() & F.col("specific_risk").isNotNull()
    key = Window.partitionBy(ASSET, DATE)
    counts = [F.count(F.when(seen, F.col(n))).over(key) for n in names]
    return wide.withColumn(SAME, (F.greatest(*counts) if len(counts) > 1 else counts[0]).cast("int"))


def signals_long(wide: DataFrame, names: Sequence[str]) -> DataFrame:
    """Unpivot the signal columns; keep rows where the signal, predicted_beta
    and specific_risk are present (what each scorer sees)."""
    ids = [DATE, ASSET, *CARRY, *([SAME] if SAME in wide.columns else [])]
    long = wide.unpivot(ids, list(names), "signal_name", "signal_value")
    return long.filter(
        F.col("signal_value").isNotNull() & F.col("predicted_beta").isNotNull() & F.col("specific_risk").isNotNull()
    )


def scored_long(long: DataFrame, names: Sequence[str], reg: dict[str, SignalSpec], block_rows: int | None = None,
                halo: int = 256, earlier: DataFrame | None = None, store: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Scores and alphas of the long signal table, one pass for signals that share a
    (scorer, alphatizer) pair.  ``earlier``: rows of the assets before these, for
    scorers that look back along an asset; they are scored with them.  ``store`` keeps
    what such scorers give; a cross-section's scores cost no more than to read them."""
    kept = [SAME] if SAME in long.columns else []
    groups: dict[tuple, list[str]] = {}
    for n in names:
        groups.setdefault((reg[n].scorer, reg[n].alphatizer), []).append(n)
    scored = None
    for (scorer, alphatizer), members in groups.items():
        part = long.filter(F.col("signal_name").isin(members)) if len(groups) > 1 else long
        if earlier is not None:
            part = part.unionByName(earlier.filter(F.col("signal_name").isin(members)))
        scored_part = scorer(part, block_rows=block_rows, halo=halo) if block_rows is not None else scorer(part)
        part = alphatizer(scored_part).select(DATE, ASSET, "signal_name", "signal_value", "score", "alpha", *kept)
        if store is not None and scorer is win_zscore:
            part = store(part)
        scored = part if scored is None else scored.unionByName(part)
    return scored


def compute_signals(assets: DataFrame, names: Sequence[str] | None = None,
                    registry: dict[str, SignalSpec] | None = None,
                    materialize: Callable[[DataFrame], DataFrame] | None = None,
                    block_rows: int | None = None, halo: int = 256, store_scored: bool = True,
                    count_keys: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(signals, scores, alphas) in long form for every registered signal.

    Signals sharing a (scorer, alphatizer) pair are scored in one pass;
    ``block_rows`` switches every per-asset window to row blocks with a halo
    (hot keys, see ``signal_columns``).  The
    long signal table feeds every scorer group, and the rows that a scorer which looks
    back has scored feed both scores and alphas; ``materialize`` (e.g. a reliable
    ``checkpoint``) stores each once instead of recomputing it for every use; without
    ``store_scored`` only the former, for a caller that reads one of the two results
    once.  ``count_keys``: all three have ``SAME``, above 1 where rows share a key
    (not with ``block_rows``, which deal an asset out)."""
    reg = registry or SIGNALS
    names = list(names or reg)
    inp = signal_input(assets)
    wide = signal_columns(inp, names, reg, block_rows=block_rows, halo=halo)
    kept = [SAME] if count_keys and block_rows is None else []
    long = signals_long(with_key_counts(wide, names) if kept else wide, names)
    if materialize is not None:
        long = materialize(long)
    scored = scored_long(long, names, reg, block_rows, halo, store=materialize if store_scored else None)
    signals = long.select(DATE, ASSET, "signal_name", "signal_value", *kept)
    scores = scored.select(DATE, ASSET, "signal_name", "score", *kept)
    alphas = scored.select(DATE, ASSET, "signal_name", "alpha", *kept)
    return signals, scores, alphas
