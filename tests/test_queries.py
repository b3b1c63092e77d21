"""Registered queries against their SQL in DuckDB, on the smallest test tables."""

import os
import sys

import duckdb
import pytest

from conftest import SF

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from check_sql import TABLES, plain  # noqa: E402
from tallyloom.oracle import all_sql  # noqa: E402
from tallyloom.queries import all_queries  # noqa: E402

@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_same_rows_as_sql(spark, db, name):
    df = queries()[name](spark, SF)
    cursor = db.execute(oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert plain([tuple(r) for r in df.collect()], df.columns) == plain(
        cursor.fetchall(), names)


def test_every_query_but_one_has_sql():
    assert set(all_queries()) - set(all_sql()) == {"fingerprint"}
    assert not set(oracle_sql()) - set(queries())


def test_entry(spark):
    assert entry(spark).count() > 5000
