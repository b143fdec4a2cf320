"""Spark result vs DuckDB oracle: row count, column names, value multiset."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if v == 0.0:
            v = 0.0
        return repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def compare(sdf, sql: str, con) -> dict:
    spark_cols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sql)
    dcols = rel.columns
    drows = rel.fetchall()
    res = {"spark_rows": len(srows), "oracle_rows": len(drows),
           "cols_match": sorted(spark_cols) == sorted(dcols)}
    if not res["cols_match"]:
        res["spark_cols"] = sorted(spark_cols)
        res["oracle_cols"] = sorted(dcols)
        res["match"] = False
        return res
    order_s = sorted(range(len(spark_cols)), key=lambda i: spark_cols[i])
    order_d = sorted(range(len(dcols)), key=lambda i: dcols[i])
    sc = Counter(tuple(_norm(r[i]) for i in order_s) for r in srows)
    dc = Counter(tuple(_norm(r[i]) for i in order_d) for r in drows)
    res["match"] = sc == dc and len(srows) == len(drows)
    if not res["match"]:
        only_s = list((sc - dc).elements())[:3]
        only_d = list((dc - sc).elements())[:3]
        res["only_spark"] = only_s
        res["only_oracle"] = only_d
        res["n_diff"] = sum((sc - dc).values())
        res["cols"] = sorted(spark_cols)
    return res
