"""Every registered query against its SQL on DuckDB."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as registered

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
ORACLES = registered.oracle_sql()
# The training-data operators, where they are there, have tests of their own; some have no SQL.
QUERIES = {
    name: query
    for name, query in registered.queries().items()
    if name in ORACLES or not (name == "pipeline" or name.startswith("op"))
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in sorted(os.listdir(SF_DIR)):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


def rows_by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple("" if row[i] is None else repr(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(cells)


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows_as_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    got = rows_by_name(frame.columns, [tuple(row) for row in frame.collect()])
    answer = duck.execute(ORACLES[name])
    columns = [column[0] for column in answer.description]
    wanted = rows_by_name(columns, answer.fetchall())
    assert got[0] == wanted[0]
    assert len(got[1]) == len(wanted[1])
    assert got[1] == wanted[1]
    assert wanted[1]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert registered.entry(spark).count() > 0
