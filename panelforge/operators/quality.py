"""Data-quality operators (Q1-Q4): completeness, group counts, column
statistics, key uniqueness.  Results are DataFrames, never driver loops."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def completeness(df: DataFrame, col: str, expected: Sequence[str]) -> DataFrame:
    """Status of every name in ``expected`` and in the data: present /
    missing (expected only) / extra (data only).  The expected list is a small
    configuration list; the data side is one distinct aggregation."""
    spark = SparkSession.getActiveSession() or df.sparkSession
    exp = spark.createDataFrame([(n,) for n in expected], f"{col}_e string")
    present = df.select(F.col(col).alias(f"{col}_p")).distinct()
    j = exp.join(present, F.col(f"{col}_e") == F.col(f"{col}_p"), "full_outer")
    return j.select(
        F.coalesce(f"{col}_e", f"{col}_p").alias(col),
        F.when(F.col(f"{col}_p").isNull(), "missing").when(F.col(f"{col}_e").isNull(), "extra")
        .otherwise("present").alias("status"),
    )


def group_counts(tables: Mapping[str, DataFrame], by: str) -> DataFrame:
    """Row count per group in several tables; ``unequal`` flags a table whose
    groups differ in size."""
    parts = [t.groupBy(by).agg(F.count(F.lit(1)).alias("n")).withColumn("table_name", F.lit(name))
             for name, t in tables.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    w = Window.partitionBy("table_name")
    return u.select("table_name", by, "n", (F.min("n").over(w) != F.max("n").over(w)).alias("unequal"))


def column_stats(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    """count, nulls, min, max, mean, sample std of ``col`` per group."""
    c = F.col(col)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("count"),
        (F.count(F.lit(1)) - F.count(c)).alias("nulls"),
        F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
    )


def duplicate_keys(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (an upsert would multiply them)."""
    return df.groupBy(*ids).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
