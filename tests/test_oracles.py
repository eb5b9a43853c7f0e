"""Every query with SQL, over whole tables, against DuckDB; the others have to run."""

import os

import pytest
from oracle import assert_same, connect

import __spark_entry__ as entry
from colloqua.plans import dealt_queries, reference_queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
MODULES = (dealt_queries, reference_queries)
QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
SQL = {k: v for m in MODULES for k, v in m.ORACLES.items()}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, con, name):
    assert_same(QUERIES[name](spark, FOLDER), con, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())
