"""Every registered query against its DuckDB counterpart on the smallest data set."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry
from compare import TABLES, rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, db, name):
    got = entry.queries()[name](spark, SF_DIR).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(got)
        return
    want = db.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    assert entry.entry(spark).count() == 76


def test_no_key_is_missing():
    assert set(entry.oracle_sql()) <= set(entry.queries())
