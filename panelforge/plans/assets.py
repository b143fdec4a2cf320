"""Flow F1: the daily asset panel.

returns with the specific returns, risk and volume of their (date, barrid), the
rows of the identity history, tickers and cusips that hold there (backward as-of),
the membership flags of (date, cusip), forward filled between rebalance days ->
``in_universe``.  All of it is one sweep along each asset's time axis, so the panel
is exchanged once (``operators.sweep``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.operators.cleaning import date_range, decode_flags, split_ids
from panelforge.operators.joins import AsofSide, asof_join_many, left_chain, universe_fill
from panelforge.operators.sweep import panel_sweep
from panelforge.sources.catalog import table_spec

IDENTITY_COLUMNS = ["rootid", "issuerid", "instrument", "name", "iso_country_code", "iso_currency_code"]

def build_assets(
    returns: DataFrame,
    specific_returns: DataFrame,
    risk: DataFrame,
    volume: DataFrame,
    asset_ids: DataFrame,
    barra_ids: DataFrame,
    membership: DataFrame,
    start=None,
    end=None,
    fill_bucket=None,
    carry: DataFrame | None = None,
) -> DataFrame:
    """All columns that the vendor tables supply, in the catalogue's order.
    ``membership`` is the raw index file (date, cusip, russell1000,
    russell2000 as "Y"/"N").  ``fill_bucket`` (e.g. ``F.year``) joins step by
    step and runs the constituency fill per (asset, time bucket), for very long series.
    ``carry``: the flags (barrid, russell_1000, russell_2000) that hold before
    ``start``, for a panel that continues an earlier one."""
    rng = lambda d: date_range(d, start, end)
    tickers = split_ids(barra_ids, "LOCALID", "ticker", strip_us=True)
    cusips = split_ids(barra_ids, "CUSIP", "cusip")
    histories = [
        AsofSide(asset_ids, "start_date", ("end_date", "rootid"), columns=IDENTITY_COLUMNS),
        AsofSide(tickers, "start_date", ("end_date",), columns=["ticker"]),
        AsofSide(cusips, "start_date", ("end_date",), columns=["cusip"]),
    ]
    flags = decode_flags(membership, {"russell1000": "russell_1000", "russell2000": "russell_2000"})
    flags = flags.select("date", "cusip", "russell_1000", "russell_2000")
    if fill_bucket is None:
        out = panel_sweep(rng(returns), [rng(specific_returns), rng(risk), rng(volume)], histories, flags, carry=carry)
    else:  # step by step, each split by time bucket
        combined = left_chain(rng(returns), [rng(specific_returns), rng(risk), rng(volume)])
        combined = asof_join_many(combined, histories, left_on="date", by="barrid")
        out = universe_fill(combined, flags, bucket=fill_bucket, carry=carry)
    declared = [f.name for f in table_spec("assets").schema.fields]
    return out.select(*[c for c in declared if c in out.columns], *[c for c in out.columns if c not in declared])


def build_assets_from_fixtures(spark, sf_dir: str, start=None, end=None, fill_bucket=None) -> DataFrame:
    from panelforge.plans import fixtures as fx
    from panelforge.plans.combination import checkpoint

    # the four vendor tables of the fixture share one aggregate: store it once,
    # as the vendor tables would be stored
    p = checkpoint(fx.panel(spark, sf_dir).sortWithinPartitions("barrid", "date"))
    return build_assets(
        fx.vendor_returns(p),
        fx.vendor_specific_returns(p),
        fx.vendor_risk(p),
        fx.vendor_volume(p),
        fx.asset_ids(spark, sf_dir),
        fx.barra_ids(p),
        fx.membership(p),
        start,
        end,
        fill_bucket,
    )
