"""Every registered query against its SQL twin on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from check_oracles import TABLES, compare
from scholarweave.plans import catalogue

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, con, name):
    ok, note = compare(spark, con, FOLDER, name)
    assert ok, note


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["year", "topic", "n"] and df.count() > 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
