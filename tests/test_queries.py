"""Every registered query against its oracle SQL (DuckDB) on the smallest data set."""

import pytest

import __spark_entry__ as E
from dimkiln.plans.catalog import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_check import compare_one, duck

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare_one(spark, con, name, E.queries()[name], E.oracle_sql().get(name), SF_SMALL)
    assert res["ok"] in (True, None), res["note"]
    assert res["rows"] >= 0


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "Customer_SK" in df.columns
