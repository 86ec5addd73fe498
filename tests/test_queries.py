"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, con, name):
    ok, note = check.compare(spark, con, FOLDER, name)
    assert ok, note


def test_entry(spark):
    assert {r["split"] for r in entry(spark).collect()} <= {"train", "val", "test"}


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
