"""Every registered query against its DuckDB statement, on the smallest test tables."""

import os

import pytest

from paylater.oracle.check import compare_one, duck
from tests.conftest import SF_SMALL

import __spark_entry__ as entry_mod
from paylater.oracle.sql import oracle_sql as reference_sql
from paylater.queries import REGISTRY

QUERIES = REGISTRY
SQL = reference_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_mod.queries()) and set(SQL) <= set(entry_mod.oracle_sql())


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0 and "customer_sk" in df.columns


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare_one(spark, con, name, QUERIES[name], SQL.get(name), SF_SMALL)
    assert r["status"] == "ok", r
