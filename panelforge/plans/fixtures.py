"""Derived test inputs: the driver's TPC-H-style tables mapped onto the shapes
of the reference's vendor tables.

``lineitem`` supplies the panel: the supplier is the asset, the ship date the
trading date.  Base sums go through exact decimals so that the Spark result and
the SQL oracle agree bit for bit.  Every view is an ordinary Spark plan over the
given parquet files, so its work grows with the tables.

The SQL twins of these views live in ``panelforge.plans.fixture_sql``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dec(c: str, p: int) -> F.Column:
    return F.col(c).cast(f"decimal({p},2)")


def barrid_of(suppkey: F.Column) -> F.Column:
    return F.concat(F.lit("US"), F.lpad(suppkey.cast("string"), 6, "0"))


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(barrid, date) panel: price, market_cap, return (percent), specific_return
    (percent), specific_risk, predicted_beta, daily_volume."""
    li = read_table(spark, sf_dir, "lineitem").select(
        barrid_of(F.col("l_suppkey")).alias("barrid"),
        F.col("l_shipdate").cast("date").alias("date"),
        _dec("l_extendedprice", 14).alias("px"),
        _dec("l_quantity", 12).alias("qty"),
        _dec("l_discount", 12).alias("disc"),
        _dec("l_tax", 12).alias("tax"),
    )
    # dealt out by asset, so that a stored panel lies by asset and day and what is read from it compresses
    agg = li.repartition("barrid").groupBy("barrid", "date").agg(
        F.sum("px").cast("double").alias("_px"),
        F.sum("qty").cast("double").alias("_qty"),
        F.sum(F.col("disc") - F.col("tax")).cast("double").alias("_ret"),
        (F.max("disc") - F.max("tax")).cast("double").alias("_sret"),
        F.count(F.lit(1)).alias("_n"),
    )
    return agg.select(
        "barrid",
        "date",
        (F.col("_px") / F.col("_qty")).alias("price"),
        F.col("_px").alias("market_cap"),
        (F.lit(100.0) * F.col("_ret")).alias("return"),
        (F.lit(100.0) * F.col("_sret")).alias("specific_return"),
        (F.lit(10.0) + F.col("_qty") / F.col("_n")).alias("specific_risk"),
        (F.lit(0.5) + F.col("_qty") / F.col("_n") / F.lit(50.0)).alias("predicted_beta"),
        F.col("_qty").alias("daily_volume"),
    )


def vendor_returns(p: DataFrame) -> DataFrame:
    return p.select("date", "barrid", "price", "market_cap", "return",
                    F.lit("FIXTURE").alias("price_source"), F.lit("USD").alias("currency"))


def vendor_specific_returns(p: DataFrame) -> DataFrame:
    return p.select("date", "barrid", "specific_return")


def vendor_risk(p: DataFrame) -> DataFrame:
    return p.select("date", "barrid", (F.col("predicted_beta") * 2).alias("yield"),
                    (F.col("specific_risk") + 5).alias("total_risk"), "specific_risk",
                    (F.col("predicted_beta") - 0.25).alias("historical_beta"), "predicted_beta")


def vendor_volume(p: DataFrame) -> DataFrame:
    return p.select(
        "date", "barrid", "daily_volume",
        *[(F.col("daily_volume") / k).alias(f"average_daily_volume_{d}") for d, k in ((30, 2), (60, 4), (90, 8))],
        (F.col("price") / 1024).alias("bid_ask_spread"),
        *[(F.col("price") / k).alias(f"average_daily_bid_ask_spread_{d}") for d, k in ((30, 2048), (60, 4096), (90, 8192))])


def barra_ids(p: DataFrame) -> DataFrame:
    """Id history: LOCALID rows (ticker source, 45-day validity) on the first
    three days of each month, and one open-ended CUSIP row per asset."""
    local = p.filter(F.dayofmonth("date") <= 3).select(
        "barrid",
        F.lit("LOCALID").alias("asset_id_type"),
        F.concat(F.lit("US"), (F.floor("market_cap").cast("bigint") % 9973).cast("string")).alias("asset_id"),
        F.col("date").alias("start_date"),
        F.date_add("date", 45).alias("end_date"),
    )
    cusip = p.groupBy("barrid").agg(
        F.lit("CUSIP").alias("asset_id_type"),
        F.concat(F.lit("C"), F.substring("barrid", 3, 100)).alias("asset_id"),
        F.min("date").alias("start_date"),
        F.lit("2099-12-31").cast("date").alias("end_date"),
    )
    return local.unionByName(cusip)


def membership(p: DataFrame) -> DataFrame:
    """Index membership file: ("Y"/"N" flags) on the first day of each month."""
    return p.filter(F.dayofmonth("date") == 1).select(
        "date",
        F.concat(F.lit("C"), F.substring("barrid", 3, 100)).alias("cusip"),
        F.when(F.col("specific_risk") > 35, "Y").otherwise("N").alias("russell1000"),
        F.when(F.col("specific_risk").between(25, 35), "Y").otherwise("N").alias("russell2000"),
    )


def asset_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Asset identity history from ``supplier`` x ``nation``: an original record
    from 1990 and a renamed record from 1998-07-01 for every supplier."""
    s = read_table(spark, sf_dir, "supplier")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    base = s.join(n, s.s_nationkey == n.n_nationkey, "left").select(
        barrid_of(F.col("s_suppkey")).alias("barrid"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("I"), F.col("s_nationkey").cast("string")).alias("issuerid"),
        F.substring("n_name", 1, 3).alias("iso_country_code"),
    )
    first = base.select(
        F.lit("1990-01-01").cast("date").alias("start_date"),
        F.lit("1998-06-30").cast("date").alias("end_date"),
        F.col("barrid").alias("rootid"),
        "barrid",
        "issuerid",
        F.lit("STOCK").alias("instrument"),
        "name",
        "iso_country_code",
        F.lit("USD").alias("iso_currency_code"),
    )
    second = base.select(
        F.lit("1998-07-01").cast("date").alias("start_date"),
        F.lit("2099-12-31").cast("date").alias("end_date"),
        F.col("barrid").alias("rootid"),
        "barrid",
        "issuerid",
        F.lit("STOCK").alias("instrument"),
        F.concat(F.col("name"), F.lit(" NEW")).alias("name"),
        "iso_country_code",
        F.lit("USD").alias("iso_currency_code"),
    )
    return first.unionByName(second)


def exposures_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.groupBy(
        F.col("l_shipdate").cast("date").alias("date"),
        barrid_of(F.col("l_suppkey")).alias("barrid"),
        F.concat(F.lit("F_"), F.col("l_returnflag"), F.col("l_linestatus")).alias("factor"),
    ).agg(F.sum(_dec("l_discount", 12)).cast("double").alias("exposures"))


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trading calendar: every ship date."""
    return read_table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("date")).distinct()
