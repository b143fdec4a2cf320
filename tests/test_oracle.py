"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver repeats this at sf0.01)."""

import os
import re

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck

SF = os.environ.get("PANELFORGE_TEST_SF", "/root/testdata/sf0.001")
QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(SQL) <= set(QUERIES)
    missing = sorted(set(QUERIES) - set(SQL) - {n for n in QUERIES if re.match(r"op\d+_|pipeline$", n)})
    assert missing == [], missing


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    res = compare(QUERIES[name](spark, SF), SQL[name], con)
    assert res["match"], res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["date", "barrid", "signal_name", "alpha"]
    assert df.count() > 0
