"""Every registered query with SQL agrees with it on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    assert difference(got, con.execute(entry.oracle_sql()[name]).df()) == ""


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
