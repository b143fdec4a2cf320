"""Flow F8: the combination chain.

alphas -> per-signal optimiser panels (P5) -> active weights (P6) -> signal
returns (P1) -> Bayesian signal weights (P2) -> smoothed weights (P3) ->
composite alphas (P4) -> composite panel and weights (P5, P6) -> portfolio,
benchmark and active return series (P7-P9) -> performance summary (E3).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.operators import portfolio as P
from panelforge.operators import weights as Wt
from panelforge.operators.signals import SIGNALS


def signal_active_weights(assets: DataFrame, alphas: DataFrame, names: Sequence[str] | None = None,
                          target_risk: float = 0.05, held: bool = False) -> DataFrame:
    """P5 + P6 per signal: (date, barrid, signal_name, weight); each signal uses
    its registered constraints (ZeroBeta only where listed), chosen per row so
    all signals share one pass.  ``held`` adds what the weights earn (see
    ``optimizer_panel``), for signal returns."""
    names = list(names or SIGNALS)
    # the hand-off panel (the optimiser's input dataset) is materialised once;
    # the weights read it twice (sums, risk scaling)
    panel = checkpoint(P.optimizer_panel(assets, alphas, signals=names, held=held))
    with_beta = [n for n in names if "ZeroBeta" in SIGNALS[n].constraints]
    out = P.active_weights(panel, by=("signal_name", "date"), zero_beta=F.col("signal_name").isin(with_beta),
                           target_risk=target_risk)
    return out.select("date", "barrid", "signal_name", "weight", *(["held_until", "held_return"] if held else []))


def composite_panel_weights(assets: DataFrame, composite: DataFrame, target_risk: float = 0.05) -> DataFrame:
    panel = checkpoint(P.optimizer_panel(assets, composite))
    return P.active_weights(panel, by=("date",), zero_beta=True, target_risk=target_risk).select(
        "date", "barrid", "weight")


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the session's shared checkpoint folder: cuts
    the lineage at a stage boundary and survives executor loss."""
    from panelforge.session import reliable_checkpoint

    return reliable_checkpoint(df)


class Chain:
    """The whole chain over one asset panel and its alphas.

    What later stages use several times (the tables of a row a day: signal returns,
    signal weights, return series) is materialised once with a reliable checkpoint;
    panels that one stage uses once run within its plan and are not written."""

    def __init__(self, assets: DataFrame, alphas: DataFrame, names: Sequence[str] = Wt.WEIGHT_SIGNALS,
                 materialize: bool = True):
        self._cp = checkpoint if materialize else (lambda d: d)
        self.assets = assets
        self.alphas = alphas
        self.names = list(names)
        self._memo: dict = {}

    def _stage(self, key, build):
        if key not in self._memo:
            self._memo[key] = self._cp(build())
        return self._memo[key]

    def active(self, held: bool = False) -> DataFrame:
        return signal_active_weights(self.assets, self._memo.get("alphas", self.alphas), held=held)

    def signal_returns(self) -> DataFrame:
        return self._stage("signal_returns", lambda: P.signal_returns(self.active(held=True), self.assets))

    def weight_table(self) -> DataFrame:
        return self._stage("weight_table", lambda: Wt.signal_weight_table(self.signal_returns(), self.names))

    def signal_weights(self) -> DataFrame:
        return self._stage("signal_weights", lambda: Wt.smooth_weights(self.weight_table(), self.names))

    def composite(self) -> DataFrame:
        alphas = self._stage("alphas", lambda: self.alphas)  # read twice from here: for the weights, and by them
        return P.composite_alphas(alphas, self.signal_weights(), self.names)

    def composite_weights(self) -> DataFrame:
        return composite_panel_weights(self.assets, self.composite())

    def returns(self) -> tuple[DataFrame, DataFrame]:
        fwd = P.forward_returns(self.assets)
        port = self._stage("portfolio", lambda: P.portfolio_returns(self.composite_weights(), fwd, "Portfolio"))
        bench = self._stage("benchmark", lambda: P.benchmark_returns(fwd))
        return port, bench
