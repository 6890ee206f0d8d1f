"""Every registered query against its SQL on DuckDB, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import rows_of
from workload import ORACLES, QUERIES

SF_DIR = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not SF_DIR.is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for file in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    frame = QUERIES[name](spark, str(SF_DIR))
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(columns, cursor.fetchall())


def test_entry(spark):
    assert entry(spark).count() == 30
