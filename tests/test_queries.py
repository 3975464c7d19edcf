"""Every registered query against its SQL in DuckDB, over the whole tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from tools.check import compare

QUERIES, SQL = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def connection(folder):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, connection, folder, name):
    assert compare(spark, connection, name, folder).startswith("ok")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert driver.entry(spark).count() > 0
