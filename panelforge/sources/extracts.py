"""Warehouse extracts (A6) and object-store text files.

``extract`` takes any Spark source - a JDBC table (``spark.read.jdbc`` with
per-year ``predicates`` for parallel reads), a catalog table or a parquet
folder - and applies projection, renaming, the inclusive date range and an
optional predicate; Catalyst pushes all of it into the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def extract(src: DataFrame, columns: Mapping[str, str], date_col: str, start=None, end=None,
            where: Column | None = None, types: Mapping[str, str] | None = None) -> DataFrame:
    """``columns``: source name -> output name (``date_col`` is a source name)."""
    d = F.col(date_col).cast("date")
    df = src
    if where is not None:
        df = df.filter(where)
    if start is not None:
        df = df.filter(d >= F.lit(str(start)).cast("date"))
    if end is not None:
        df = df.filter(d <= F.lit(str(end)).cast("date"))
    out = []
    for s, o in columns.items():
        c = F.col(s).cast("date") if s == date_col else F.col(s)
        if types and o in types:
            c = c.cast(types[o])
        out.append(c.alias(o))
    return df.select(*out)


def jdbc_year_predicates(date_col: str, years: Sequence[int]) -> list[str]:
    """One predicate per year for ``spark.read.jdbc(..., predicates=...)``."""
    return [f"{date_col} >= '{y}-01-01' AND {date_col} < '{y + 1}-01-01'" for y in years]


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """CSV with a header to any Hadoop-compatible URI (s3a://, abfss://, file:)."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """CSV with an explicit schema (no inference pass)."""
    return spark.read.schema(schema).option("header", True).option("sep", sep).option("mode", "FAILFAST").csv(path)


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Object listing as a DataFrame (path, length, modificationTime) - the
    content column is never selected, so files are not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
            .select("path", "length", "modificationTime"))


def read_weight_files(spark: SparkSession, root: str, risk: str = "0.05") -> DataFrame:
    """A10: optimiser output laid out as ``{root}/{signal}/{risk}/*.parquet``
    (or ``signal_name=...`` / ``risk=...`` directories).  One scan over all
    signals; ``signal_name`` comes from each file's path.  Only directory
    names are listed on the driver (one per signal)."""
    import re

    from panelforge.sources.tables import glob_paths

    dirs = sorted(set(glob_paths(spark, f"{root.rstrip('/')}/*/{risk}") +
                      glob_paths(spark, f"{root.rstrip('/')}/*/risk={risk}")))
    if not dirs:
        raise FileNotFoundError(f"no weight files for risk {risk} under {root}")
    df = spark.read.parquet(*dirs)
    pat = r"/(?:signal_name=)?([^/]+)/(?:risk=)?" + re.escape(risk) + r"/[^/]+$"
    return df.withColumn("signal_name", F.regexp_extract(F.col("_metadata.file_path"), pat, 1))


def write_handoff(df: DataFrame, root: str, name: str, start, end) -> str:
    """The dataset handed to the optimiser, ``{root}/{name}_{start}_{end}.parquet``."""
    path = f"{root.rstrip('/')}/{name}_{start}_{end}.parquet"
    df.write.mode("overwrite").parquet(path)
    return path
