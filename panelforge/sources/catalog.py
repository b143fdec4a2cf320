"""Table catalogue: the 24 keyed tables of the research database, their
declared schemas and keys, and a ``Catalog`` resolving them under a root and
an environment (research / production / development: path-based isolation).

Numeric columns the reference stored as text (signal returns, signal weights)
are DOUBLE here.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from panelforge.sources.tables import Table, TableSpec

ENVIRONMENTS = ("research", "production", "development")

# The vendor's 76 risk-model factor names, in column order
# (alphabetical), used as the wide columns of exposures / covariances / factors.
FACTORS = [
    "USSLOWL_AERODEF", "USSLOWL_AIRLINES", "USSLOWL_ALUMSTEL", "USSLOWL_APPAREL", "USSLOWL_AUTO",
    "USSLOWL_BANKS", "USSLOWL_BETA", "USSLOWL_BEVTOB", "USSLOWL_BIOLIFE", "USSLOWL_BLDGPROD",
    "USSLOWL_CHEM", "USSLOWL_CNSTENG", "USSLOWL_CNSTMACH", "USSLOWL_CNSTMATL", "USSLOWL_COMMEQP",
    "USSLOWL_COMPELEC", "USSLOWL_COMSVCS", "USSLOWL_CONGLOM", "USSLOWL_CONTAINR", "USSLOWL_COUNTRY",
    "USSLOWL_DISTRIB", "USSLOWL_DIVFIN", "USSLOWL_DIVYILD", "USSLOWL_EARNQLTY", "USSLOWL_EARNYILD",
    "USSLOWL_ELECEQP", "USSLOWL_ELECUTIL", "USSLOWL_FOODPROD", "USSLOWL_FOODRET", "USSLOWL_GASUTIL",
    "USSLOWL_GROWTH", "USSLOWL_HLTHEQP", "USSLOWL_HLTHSVCS", "USSLOWL_HOMEBLDG", "USSLOWL_HOUSEDUR",
    "USSLOWL_INDMACH", "USSLOWL_INSURNCE", "USSLOWL_INTERNET", "USSLOWL_LEISPROD", "USSLOWL_LEISSVCS",
    "USSLOWL_LEVERAGE", "USSLOWL_LIFEINS", "USSLOWL_LIQUIDTY", "USSLOWL_LTREVRSL", "USSLOWL_MEDIA",
    "USSLOWL_MGDHLTH", "USSLOWL_MGMTQLTY", "USSLOWL_MIDCAP", "USSLOWL_MOMENTUM", "USSLOWL_MULTUTIL",
    "USSLOWL_OILGSCON", "USSLOWL_OILGSDRL", "USSLOWL_OILGSEQP", "USSLOWL_OILGSEXP", "USSLOWL_PAPER",
    "USSLOWL_PHARMA", "USSLOWL_PRECMTLS", "USSLOWL_PROFIT", "USSLOWL_PROSPECT", "USSLOWL_PSNLPROD",
    "USSLOWL_REALEST", "USSLOWL_RESTAUR", "USSLOWL_RESVOL", "USSLOWL_ROADRAIL", "USSLOWL_SEMICOND",
    "USSLOWL_SEMIEQP", "USSLOWL_SIZE", "USSLOWL_SOFTWARE", "USSLOWL_SPLTYRET", "USSLOWL_SPTYCHEM",
    "USSLOWL_SPTYSTOR", "USSLOWL_TELECOM", "USSLOWL_TRADECO", "USSLOWL_TRANSPRT", "USSLOWL_VALUE",
    "USSLOWL_WIRELESS",
]

_TYPES = {"date": T.DateType(), "str": T.StringType(), "dbl": T.DoubleType(), "int": T.LongType(),
          "bool": T.BooleanType()}


def _schema(cols: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in cols])


def _f(names, t="dbl"):
    return [(n, t) for n in names]


_VOLUME = ["daily_volume", "average_daily_volume_30", "average_daily_volume_60", "average_daily_volume_90",
           "bid_ask_spread", "average_daily_bid_ask_spread_30", "average_daily_bid_ask_spread_60",
           "average_daily_bid_ask_spread_90"]

# Table name -> (columns, key, yearly)
TABLES: dict[str, tuple[list, tuple, bool]] = {
    "assets": ([("date", "date"), ("rootid", "str"), ("barrid", "str"), ("issuerid", "str"), ("instrument", "str"),
                ("name", "str"), ("cusip", "str"), ("isin", "str"), ("cisn", "str"), ("ticker", "str"),
                ("price", "dbl"), ("return", "dbl"), ("specific_return", "dbl"), ("market_cap", "dbl"),
                ("price_source", "str"), ("currency", "str"), ("iso_country_code", "str"),
                ("iso_currency_code", "str"), ("yield", "dbl"), ("total_risk", "dbl"), ("specific_risk", "dbl"),
                ("historical_beta", "dbl"), ("predicted_beta", "dbl"), ("russell_1000", "bool"),
                ("russell_2000", "bool"), ("in_universe", "bool")] + _f(_VOLUME),
               ("date", "barrid"), True),
    "barra_returns": ([("barrid", "str"), ("price", "dbl"), ("market_cap", "dbl"), ("price_source", "str"),
                       ("currency", "str"), ("return", "dbl"), ("date", "date")], ("date", "barrid"), True),
    "barra_specific_returns": ([("barrid", "str"), ("specific_return", "dbl"), ("date", "date")],
                               ("date", "barrid"), True),
    "barra_risk": ([("barrid", "str"), ("yield", "dbl"), ("total_risk", "dbl"), ("specific_risk", "dbl"),
                    ("historical_beta", "dbl"), ("predicted_beta", "dbl"), ("date", "date")],
                   ("date", "barrid"), True),
    "barra_volume": ([("date", "date"), ("barrid", "str")] + _f(_VOLUME), ("date", "barrid"), True),
    "exposures": ([("date", "date"), ("barrid", "str")] + _f(FACTORS), ("date", "barrid"), True),
    "covariances": ([("date", "date"), ("factor_1", "str")] + _f(FACTORS), ("date", "factor_1"), True),
    "factors": ([("date", "date")] + _f(FACTORS), ("date",), True),
    "crsp_events": ([("date", "date"), ("permno", "int"), ("ticker", "str"), ("shrcd", "int"), ("exchcd", "int")],
                    ("date", "permno"), True),
    "crsp_monthly": ([("date", "date"), ("permno", "int"), ("cusip", "str"), ("ret", "dbl"), ("retx", "dbl"),
                      ("prc", "dbl"), ("vol", "int"), ("shrout", "int")], ("date", "permno"), True),
    "crsp_daily": ([("date", "date"), ("permno", "int"), ("cusip", "str"), ("ret", "dbl"), ("retx", "dbl"),
                    ("prc", "dbl"), ("vol", "int"), ("openprc", "dbl"), ("askhi", "dbl"), ("bidlo", "dbl"),
                    ("shrout", "int")], ("date", "permno"), True),
    "crsp_v2_monthly": ([("date", "date"), ("permno", "int"), ("ticker", "str"), ("cusip", "str"), ("ret", "dbl"),
                         ("retx", "dbl"), ("prc", "dbl"), ("vol", "int"), ("shrout", "int"),
                         ("primaryexch", "str"), ("securitytype", "str")], ("date", "permno"), True),
    "crsp_v2_daily": ([("date", "date"), ("permno", "int"), ("cusip", "str"), ("ticker", "str"), ("ret", "dbl"),
                       ("retx", "dbl"), ("prc", "dbl"), ("vol", "int"), ("open", "dbl"), ("high", "dbl"),
                       ("low", "dbl"), ("close", "dbl"), ("shrout", "int"), ("primaryexch", "str"),
                       ("securitytype", "str")], ("date", "permno"), True),
    "asset_ids": ([("start_date", "date"), ("end_date", "date"), ("rootid", "str"), ("barrid", "str"),
                   ("issuerid", "str"), ("instrument", "str"), ("name", "str"), ("iso_country_code", "str"),
                   ("iso_currency_code", "str")], ("barrid", "start_date", "rootid", "end_date"), False),
    "barra_ids": ([("barrid", "str"), ("asset_id_type", "str"), ("asset_id", "str"), ("start_date", "date"),
                   ("end_date", "date")], ("barrid", "start_date", "asset_id_type", "end_date"), False),
    "fama_french": ([("date", "date"), ("mkt_rf", "dbl"), ("smb", "dbl"), ("hml", "dbl"), ("rmw", "dbl"),
                     ("cma", "dbl"), ("rf", "dbl")], ("date",), False),
    "ftse_russell": ([("date", "date"), ("cusip", "str"), ("russell_2000", "bool"), ("russell_1000", "bool")],
                     ("date", "cusip"), True),
    "signals": ([("date", "date"), ("barrid", "str"), ("signal_name", "str"), ("signal_value", "dbl")],
                ("date", "barrid", "signal_name"), True),
    "scores": ([("date", "date"), ("barrid", "str"), ("signal_name", "str"), ("score", "dbl")],
               ("date", "barrid", "signal_name"), True),
    "alphas": ([("date", "date"), ("barrid", "str"), ("signal_name", "str"), ("alpha", "dbl")],
               ("date", "barrid", "signal_name"), True),
    "active_weights": ([("date", "date"), ("barrid", "str"), ("signal", "str"), ("weight", "dbl")],
                       ("date", "barrid", "signal"), True),
    "composite_alphas": ([("date", "date"), ("barrid", "str"), ("alpha", "dbl")], ("date", "barrid"), True),
    "signal_returns": ([("date", "date"), ("signal_name", "str"), ("forward_return", "dbl")],
                       ("date", "signal_name"), True),
    "signal_weights": ([("date", "date"), ("signal_name", "str"), ("weight", "dbl")],
                       ("date", "signal_name"), True),
}

# Warehouse source columns -> table columns for the extracts
# (A6), with the date column of each source and the source-side predicate.
EXTRACTS = {
    "crsp_daily": ({"date": "date", "permno": "permno", "cusip": "cusip", "ret": "ret", "retx": "retx",
                    "prc": "prc", "vol": "vol", "openprc": "openprc", "askhi": "askhi", "bidlo": "bidlo",
                    "shrout": "shrout"}, "date", None),
    "crsp_monthly": ({"date": "date", "permno": "permno", "cusip": "cusip", "ret": "ret", "retx": "retx",
                      "prc": "prc", "vol": "vol", "shrout": "shrout"}, "date", None),
    "crsp_events": ({"date": "date", "permno": "permno", "ticker": "ticker", "shrcd": "shrcd", "exchcd": "exchcd"},
                    "date", "event = 'NAMES'"),
    "crsp_v2_daily": ({"dlycaldt": "date", "permno": "permno", "cusip": "cusip", "ticker": "ticker",
                       "dlyret": "ret", "dlyretx": "retx", "dlyprc": "prc", "dlyvol": "vol", "dlyopen": "open",
                       "dlyhigh": "high", "dlylow": "low", "dlyclose": "close", "shrout": "shrout",
                       "primaryexch": "primaryexch", "securitytype": "securitytype"}, "dlycaldt", None),
    "crsp_v2_monthly": ({"mthcaldt": "date", "permno": "permno", "cusip": "cusip", "ticker": "ticker",
                         "mthret": "ret", "mthretx": "retx", "mthprc": "prc", "mthvol": "vol", "shrout": "shrout",
                         "primaryexch": "primaryexch", "securitytype": "securitytype"}, "mthcaldt", None),
    "ftse_russell": ({"date": "date", "cusip": "cusip", "russell2000": "russell2000", "russell1000": "russell1000"},
                     "date", None),
}


def table_spec(name: str) -> TableSpec:
    cols, ids, yearly = TABLES[name]
    return TableSpec(name, _schema(cols), tuple(ids), yearly)


class Catalog:
    """``Catalog(spark, root, env).table("assets")`` -> a ``Table`` under
    ``{root}/{env}/assets``; environments only differ by path."""

    def __init__(self, spark: SparkSession, root: str, env: str = "development"):
        if env not in ENVIRONMENTS:
            raise ValueError(f"unknown environment {env!r}")
        self.spark = spark
        self.root = f"{root.rstrip('/')}/{env}"

    def table(self, name: str) -> Table:
        return Table(self.spark, self.root, table_spec(name))

    def __getattr__(self, name: str) -> Table:
        if name.endswith("_table") and name[: -len("_table")] in TABLES:
            return self.table(name[: -len("_table")])
        raise AttributeError(name)

    @staticmethod
    def names() -> list[str]:
        return list(TABLES)
