"""Whole flows (F2-F7, F9) as plain functions over a session and a store root.

Each flow is one Spark plan per table write; nothing loops over years, dates
or assets on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.operators.reshape import pivot_wide
from panelforge.operators.signals import SAME, compute_signals
from panelforge.sources import archives as A
from panelforge.sources import vendor as V
from panelforge.sources.tables import Table, TableSpec

def signal_table_spec(name: str) -> TableSpec:
    """Catalogue spec of the signals / scores / alphas tables."""
    from panelforge.sources.catalog import table_spec

    return table_spec(name)


def signals_flow(spark: SparkSession, assets: DataFrame, root: str, names: Sequence[str] | None = None,
                 write_start=None, write_end=None, block_rows: int | None = None) -> dict[str, Table]:
    """signals, scores and alphas from the full asset history, upserted into
    three yearly tables; ``write_start``/``write_end`` restrict only what is
    written (the windows always see the whole history).  ``block_rows`` runs
    the per-asset windows in row blocks, for series too long for one task."""
    from panelforge.plans.combination import checkpoint

    sig, sc, al = compute_signals(assets, names, materialize=checkpoint, block_rows=block_rows, count_keys=True)
    out = {}
    for name, df in (("signals", sig), ("scores", sc), ("alphas", al)):
        if write_start is not None:
            df = df.filter(F.col("date") >= F.lit(str(write_start)).cast("date"))
        if write_end is not None:
            df = df.filter(F.col("date") <= F.lit(str(write_end)).cast("date"))
        t = Table(spark, root, signal_table_spec(name))
        t.upsert(df, counted=SAME in df.columns)
        out[name] = t
    return out


def vendor_history_flow(spark: SparkSession, archive_root: str, spec: A.ArchiveSpec, vendor: V.VendorSpec,
                        raw_columns: Sequence[str], table: Table, years: Sequence[int] | None = None) -> None:
    """archives of the given years -> clean -> upsert."""
    raw = A.read_history(spark, archive_root, spec, raw_columns, years)
    table.upsert(vendor.clean(raw))


def vendor_daily_flow(spark: SparkSession, archive_root: str, spec: A.ArchiveSpec, vendor: V.VendorSpec,
                      raw_columns: Sequence[str], table: Table, sessions) -> None:
    """daily archives of the look-back sessions -> clean -> upsert
    (idempotent, so re-running the look-back is harmless)."""
    raw = A.read_daily(spark, archive_root, spec, raw_columns, sessions)
    table.upsert(vendor.clean(raw))


def snapshot_flow(spark: SparkSession, archive_root: str, spec: A.ArchiveSpec, vendor: V.VendorSpec,
                  raw_columns: Sequence[str], table: Table, sessions, us_only: bool = False) -> None:
    """newest daily snapshot -> clean -> overwrite; ``us_only`` keeps the
    assets whose own identifier holds "US"."""
    raw = A.read_daily(spark, archive_root, spec, raw_columns, sessions, latest_only=True)
    df = vendor.clean(raw)
    if us_only:
        df = df.filter(F.col("barrid").contains("US"))
    table.overwrite(df)


def dataset_flow(spark: SparkSession, archive_root: str, name: str, table: Table, years: Sequence[int] | None = None,
                 sessions=None, factors: Sequence[str] | None = None) -> None:
    """F2/F3 for any of the nine datasets by its name: its archives (of the given
    sessions, else its history) -> clean, scale -> for factor datasets pivot on
    ``factors`` -> upsert, or overwrite for id snapshots."""
    spec, vendor = V.archive_specs()[name], V.DATASETS[name]
    if sessions is None:
        raw = A.read_history(spark, archive_root, spec, vendor.raw_columns(), years)
    else:
        raw = A.read_daily(spark, archive_root, spec, vendor.raw_columns(), sessions, latest_only=not table.spec.yearly)
    df = vendor.clean(raw)
    if name in V.WIDE:
        index, on, value = V.WIDE[name]
        df = pivot_wide(df, index, on, value, factors)
    (table.upsert if table.spec.yearly else table.overwrite)(df)


def factor_matrix_flow(long: DataFrame, index: Sequence[str], on: str, value: str, factors: Sequence[str],
                       table: Table) -> None:
    """F2/F3 for the wide factor tables: pivot on the fixed factor list, upsert."""
    table.upsert(pivot_wide(long, index, on, value, factors))


def warehouse_backfill_flow(src: DataFrame, columns, date_col: str, table: Table, start=None, end=None,
                            where=None, flags=None) -> None:
    """extract (projection, rename, range, predicate) -> decode flags -> upsert."""
    from panelforge.operators.cleaning import decode_flags
    from panelforge.sources.extracts import extract

    df = extract(src, columns, date_col, start, end, where)
    if flags:
        df = decode_flags(df, flags)
    table.upsert(df)


def warehouse_flow(src: DataFrame, name: str, table: Table, start=None, end=None) -> None:
    """F5 for any warehouse extract of the catalogue by its name: its column map, date
    column and source-side predicate; "Y"/"N" membership flags become booleans."""
    from panelforge.sources.catalog import EXTRACTS

    columns, date_col, where = EXTRACTS[name]
    flags = {c: f"russell_{c.removeprefix('russell')}" for c in columns.values() if c.startswith("russell")}
    warehouse_backfill_flow(src, columns, date_col, table, start, end, None if where is None else F.expr(where), flags)


def factor_file_flow(spark: SparkSession, path: str, schema: T.StructType, table: Table) -> None:
    """sectioned text file -> daily block -> snapshot overwrite."""
    table.overwrite(A.read_sectioned_csv(spark, path, schema))


def backfill_all(spark: SparkSession, root: str, vendor: dict[str, DataFrame], start=None, end=None,
                 signal_names: Sequence[str] | None = None, id_archives: tuple | None = None) -> dict[str, Table]:
    """id tables first, then the vendor tables, then the asset panel (built
    once, after the ids), then signals / scores / alphas.

    ``vendor``: cleaned frames keyed returns, specific_returns, risk, volume,
    asset_ids, barra_ids, membership (raw "Y"/"N" flags).  ``id_archives``
    (archive root, spec, sessions) takes barra_ids from its newest archived
    snapshot instead."""
    from panelforge.plans.assets import build_assets

    tables: dict[str, Table] = {}
    id_keys = {"asset_ids": ("barrid", "start_date", "rootid", "end_date"),
               "barra_ids": ("barrid", "start_date", "asset_id_type", "end_date")}
    for name, keys in id_keys.items():
        if name == "barra_ids" and id_archives is not None:
            archive_root, spec, sessions = id_archives
            t = Table(spark, root, signal_table_spec(name))
            snapshot_flow(spark, archive_root, spec, V.IDS, V.IDS.raw_columns(), t, sessions, us_only=True)
        else:
            df = vendor[name]
            t = Table(spark, root, TableSpec(name, df.schema, keys, yearly=False))
            t.overwrite(df)
        tables[name] = t
    for name in ("returns", "specific_returns", "risk", "volume", "membership"):
        df = vendor[name]
        keys = ("date", "cusip") if name == "membership" else ("date", "barrid")
        t = Table(spark, root, TableSpec(name, df.schema, keys))
        t.upsert(df)
        tables[name] = t
    assets = build_assets(
        tables["returns"].read(start, end), tables["specific_returns"].read(start, end),
        tables["risk"].read(start, end), tables["volume"].read(start, end),
        tables["asset_ids"].read(), tables["barra_ids"].read(), tables["membership"].read(), start, end)
    at = Table(spark, root, TableSpec("assets", assets.schema, ("date", "barrid")))
    at.overwrite(assets)
    tables["assets"] = at
    tables.update(signals_flow(spark, at.read(), root, signal_names))
    return tables


def daily_all(spark: SparkSession, root: str, archive_root: Callable[[str], str], sessions, membership: DataFrame, asset_ids: DataFrame,
              barra_ids: DataFrame, signal_names: Sequence[str] | None = None) -> dict[str, Table]:
    """F9 by day: the four daily vendor tables take the archives of the look-back
    ``sessions``, the asset panel is built anew from the stored tables, and the
    signal tables take the years of the look-back (their windows see the whole
    history).  ``archive_root`` names the folder of a dataset's archives.  Running
    a day again changes nothing."""
    from panelforge.plans.assets import build_assets

    tables = {}
    for name in ("returns", "specific_returns", "risk", "volume"):
        tables[name] = Table(spark, root, signal_table_spec(f"barra_{name}"))
        dataset_flow(spark, archive_root(name), name, tables[name], sessions=sessions)
    assets = build_assets(*(tables[n].read() for n in ("returns", "specific_returns", "risk", "volume")),
                          asset_ids, barra_ids, membership)
    tables["assets"] = Table(spark, root, signal_table_spec("assets"))
    tables["assets"].overwrite(assets, apart=True)
    first = f"{min(sessions).year}-01-01"
    return tables | signals_flow(spark, tables["assets"].read(), root, signal_names, write_start=first)
