"""Every query with an SQL counterpart gives the same rows on Spark and DuckDB."""

import duckdb
import pytest

import __spark_entry__ as contract
from tools.check import TABLES, rows_of

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return connection


def test_names():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_same_rows(spark, con, name):
    df = contract.queries()[name](spark, SF_DIR)
    got, columns = rows_of(df.collect(), df.columns)
    result = con.execute(contract.oracle_sql()[name])
    expected, names = rows_of(result.fetchall(), [d[0] for d in result.description])
    assert columns == names
    assert got == expected
