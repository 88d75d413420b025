"""Every registered query against its SQL, at the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from codequarry.plans.oracle import CHECKS
from codequarry.plans.queries import QUERIES
from tools.check import rows_of


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{sf_dir}/{file}'")
    return connection


def test_entry_gives_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["language", "kind", "n_definitions"]
    assert df.count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(entry.queries()) and set(CHECKS) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    got = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in got.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, got.fetchall())
