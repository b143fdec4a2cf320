"""Projection / filter / cleaning operators (vendor frames, ids, flags, casts,
session calendar)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRAILER = "[End of File]"


def rename_non_strict(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by dictionary; names absent from ``df`` are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def drop_trailer(df: DataFrame, col: str, marker: str = TRAILER) -> DataFrame:
    """Drop the archive's end-of-file row (NULL-safe: NULL keys are kept)."""
    return df.filter(F.col(col).isNull() | (F.col(col) != F.lit(marker)))


def parse_dates(df: DataFrame, cols: Sequence[str], fmt: str = "yyyyMMdd") -> DataFrame:
    """``YYYYMMDD`` strings -> DATE (bad strings -> NULL instead of an ANSI error)."""
    return df.withColumns({c: F.try_to_date(F.col(c), fmt) if hasattr(F, "try_to_date")
                           else F.to_date(F.col(c), fmt) for c in cols})


def strip_first(col, pattern: str) -> Column:
    """Remove the first occurrence of ``pattern`` (a literal) from a string."""
    c = F.col(col) if isinstance(col, str) else col
    esc = "".join("\\" + ch if not ch.isalnum() else ch for ch in pattern)
    return F.regexp_replace(c, f"^(.*?){esc}", "$1")


def clean_vendor(
    df: DataFrame,
    rename: Mapping[str, str],
    columns: Sequence[str],
    date_cols: Sequence[str] = ("date",),
    key: str = "barrid",
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """Clean one vendor frame: rename (non-strict) -> drop trailer -> parse dates
    -> cast -> fixed column subset/order."""
    out = rename_non_strict(df, rename)
    out = drop_trailer(out, key)
    out = parse_dates(out, [c for c in date_cols if c in out.columns])
    if types:
        out = out.withColumns({c: F.col(c).cast(t) for c, t in types.items() if c in out.columns})
    return out.select(*columns)


def split_ids(ids: DataFrame, id_type: str, value_name: str, strip_us: bool = False,
              us_only: bool = True) -> DataFrame:
    """Keep one id type (optionally US assets only), drop the type column,
    rename the value; ``strip_us`` removes the first "US" from the value."""
    out = ids.filter(F.col("asset_id_type") == id_type)
    if us_only:
        out = out.filter(F.col("barrid").startswith("US"))
    out = out.drop("asset_id_type").withColumnRenamed("asset_id", value_name)
    if strip_us:
        out = out.withColumn(value_name, strip_first(value_name, "US"))
    return out


def decode_flags(df: DataFrame, flags: Mapping[str, str], true_value: str = "Y") -> DataFrame:
    """Map "Y" flags to booleans under new names, e.g. {"russell1000": "russell_1000"}."""
    keep = [c for c in df.columns if c not in flags]
    return df.select(*keep, *[(F.col(src) == true_value).alias(dst) for src, dst in flags.items()])


def cast_drop_nan(df: DataFrame, col: str, to: str = "double") -> DataFrame:
    """Cast a text column to a number and drop NaN results (NULL kept, as in the
    reference; use ``drop_null`` to drop both)."""
    c = F.expr(f"try_cast(`{col}` AS {to})")
    return df.withColumn(col, c).filter(F.col(col).isNull() | ~F.isnan(F.col(col)))


def date_range(df: DataFrame, start=None, end=None, col: str = "date") -> DataFrame:
    """Inclusive date range filter (pushed to the parquet scan)."""
    if start is not None:
        df = df.filter(F.col(col) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col(col) <= F.lit(end).cast("date"))
    return df


def last_n_sessions(calendar: DataFrame, as_of, n: int, col: str = "date") -> DataFrame:
    """The ``n`` sessions strictly before ``as_of`` (rolled forward to the next
    session when it is not one - which selects the same sessions).  A top-k over
    the calendar: the limit is the feature, and the calendar holds one row per
    trading day."""
    return (
        calendar.select(F.col(col).alias("date"))
        .filter(F.col("date") < F.lit(as_of).cast("date"))
        .distinct()
        .orderBy(F.col("date").desc())
        .limit(n)
    )


def distinct_years(df: DataFrame, col: str = "date") -> DataFrame:
    return df.select(F.year(col).alias("year")).distinct()
