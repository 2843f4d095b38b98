"""Every registered query against its SQL on the same tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from quirefold.plans.oracle import SQL
from quirefold.plans.queries import registered

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("events", "orders")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


def as_sorted(columns: list[str], rows: list[tuple]) -> list[list]:
    """Rows in an order of their own, values by column name."""
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    return sorted(([row[at] for at in order] for row in rows), key=repr)


def test_every_query_has_sql():
    assert registered().keys() == SQL.keys()
    assert registered().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", list(registered()))
def test_query_equals_sql(spark, duck, name):
    frame = entry.queries()[name](spark, SF_DIR)
    relation = duck.sql(entry.oracle_sql()[name])
    assert sorted(frame.columns) == sorted(relation.columns)
    got = as_sorted(frame.columns, [tuple(row) for row in frame.collect()])
    assert got == as_sorted(relation.columns, relation.fetchall())
    assert got, "the query must have a result at this scale"


def test_entry(spark):
    assert entry.entry(spark).count() == 50
