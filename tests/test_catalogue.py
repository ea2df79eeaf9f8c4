"""Every query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from check import TABLES, canonical

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables are not here")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def test_every_sql_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_query_equals_its_sql(spark, sql, name):
    got = entry_points.queries()[name](spark, FOLDER).toPandas()
    if name in entry_points.oracle_sql():
        want = sql.sql(entry_points.oracle_sql()[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert canonical(got) == canonical(want)
    else:
        assert len(got) > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
