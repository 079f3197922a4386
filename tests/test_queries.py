"""Every registered query against its SQL on the small tables."""

import datetime as dt
import re

import duckdb
import pytest

import __spark_entry__ as entry_points
from catalog.queries import QUERIES as CATALOG

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES = {name: f for name, f in entry_points.queries().items() if name in CATALOG}
SQL = entry_points.oracle_sql()
PRODUCTS_OR_PYTHON = re.compile("CartesianProduct|NestedLoop|Python|Pandas")


@pytest.fixture(scope="module")
def tables(small_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small_dir}/{name}.parquet'")
    return con


def plain(value):
    return value.replace(tzinfo=None) if isinstance(value, dt.datetime) else value


def in_order(rows):
    return sorted(rows, key=lambda row: tuple((v is None, v if v is not None else 0) for v in row))


def test_every_query_has_sql():
    assert set(QUERIES) == set(CATALOG) <= set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_equal_to_sql(spark, small_dir, tables, name):
    df = QUERIES[name](spark, small_dir)
    assert not PRODUCTS_OR_PYTHON.search(df._jdf.queryExecution().executedPlan().toString())
    columns = sorted(df.columns)
    got = [tuple(plain(row[c]) for c in columns) for row in df.collect()]
    found = tables.execute(SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = [tuple(row[i] for i in places) for row in found.fetchall()]
    assert in_order(got) == in_order(want)


ORDERED = ["sort_daily_rank", "sort_multi", "ingest_export_processed"]


@pytest.mark.parametrize("name", ORDERED)
def test_order_of_sorted_results(spark, small_dir, tables, name):
    df = QUERIES[name](spark, small_dir)
    columns = df.columns
    got = [tuple(plain(v) for v in row) for row in df.collect()]
    found = tables.execute(SQL[name])
    places = [[d[0] for d in found.description].index(c) for c in columns]
    assert got == [tuple(row[i] for i in places) for row in found.fetchall()]


def test_entry(spark):
    assert "first_played_date" in entry_points.entry(spark).columns
