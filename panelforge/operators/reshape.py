"""Pivot / unpivot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.operators.cleaning import strip_first


def pivot_wide(df: DataFrame, index: Sequence[str], on: str, values: str, names: Sequence[str],
               strict: bool = True) -> DataFrame:
    """Long -> wide with a fixed list of ``names`` (fixed schema, no extra job
    to discover values).  One partial/final aggregation on ``index``.

    ``strict``: a cell that holds several rows raises when it is computed (the
    same aggregation counts them); else the least value stands for them."""
    cells = df.groupBy(*index).pivot(on, list(names)).agg(F.min(values).alias("v"), F.count(F.lit(1)).alias("n"))
    message = F.lit(f"pivot on {on!r}: some ({', '.join(index)}) cells hold several rows")
    value = lambda c: F.when(F.col(f"`{c}_n`") > 1, F.raise_error(message)).otherwise(F.col(f"`{c}_v`"))
    return cells.select(*index, *[(value(c) if strict else F.col(f"`{c}_v`")).alias(c) for c in names])


def unpivot_long(df: DataFrame, index: Sequence[str], cols: Sequence[str], var: str, val: str,
                 strip_prefix: str | None = None) -> DataFrame:
    """Wide -> long; optionally remove the first occurrence of a name prefix."""
    out = df.unpivot(list(index), list(cols), var, val)
    if strip_prefix:
        out = out.withColumn(var, strip_first(var, strip_prefix))
    return out
