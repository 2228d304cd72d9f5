"""Every catalogued query against its SQL counterpart on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from check_oracles import TABLES, canonical
from corpusloom.plans.catalog import QUERIES
from corpusloom.plans.oracles import ORACLES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no benchmark tables here")
ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def connection():
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def test_only_queries_without_sql_meaning_lack_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, connection, name):
    ours = QUERIES[name](spark, FOLDER).toPandas()
    theirs = connection.execute(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns) and len(ours) == len(theirs) > 0
    assert canonical(ours).tolist() == canonical(theirs).tolist()


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0
