"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None).

Builders take (spark, sf_dir) and return a DataFrame over the driver's tables.
Floating outputs are rounded (``R`` in SQL, ``rnd`` in Spark) and -0.0 is
normalised, so both engines print the same values.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql)
        return fn

    return deco


def R(expr: str, bits: int = 20) -> str:
    """SQL twin of ``rnd``."""
    return f"(floor(({expr}) * CAST({2**bits} AS DOUBLE) + 0.5) / CAST({2**bits} AS DOUBLE))"


def rnd(col, bits: int = 20) -> F.Column:
    """Round to a binary grid: floor(x * 2^bits + 0.5) / 2^bits (about 1e-6).

    Every step is an exact or correctly rounded IEEE operation, so two engines
    holding the same double print the same value, and a tie needs x to be an
    odd multiple of 2^-(bits+1) - unlike a decimal grid, where data built from
    decimals often lands exactly on a printed half and the engines' ``round``
    functions disagree."""
    c = F.col(col) if isinstance(col, str) else col
    scale = float(2**bits)
    return F.floor(c * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def RR(expr: str, bits: int = 24) -> str:
    """SQL twin of ``rnd_rel``."""
    scale = f"power(2.0, {bits} - floor(log2(abs({expr}))))"
    return f"(CASE WHEN ({expr}) = 0 THEN 0.0 ELSE floor(({expr}) * {scale} + 0.5) / {scale} END)"


def rnd_rel(col, bits: int = 24) -> F.Column:
    """Round to ``bits`` significant bits: the grid follows the value's size."""
    c = F.col(col) if isinstance(col, str) else col
    scale = F.pow(F.lit(2.0), F.lit(bits) - F.floor(F.log2(F.abs(c))))
    return F.when(c == 0, F.lit(0.0)).otherwise(F.floor(c * scale + F.lit(0.5)).cast("double") / scale)


def round_all(df: DataFrame, bits: int = 20, skip: tuple = ()) -> DataFrame:
    """Round every double column of ``df``."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float") and f.name not in skip:
            out.append(rnd(f.name, bits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
