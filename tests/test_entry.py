"""Every registered query against its SQL counterpart in DuckDB."""

import os

import pytest

import __spark_entry__ as entry_module
from conftest import TESTDATA

SF = os.path.join(TESTDATA, "sf0.001")
VIEWS = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "pages", "benchmark", "labels", "conversations",
)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in VIEWS:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(entry_module._QUERIES) <= set(entry_module.oracle_sql())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() == 26


def test_known_totals(spark):
    """Counts established beforehand on the next larger tables."""
    sf = os.path.join(TESTDATA, "sf0.01")
    queries = entry_module.queries()
    assert [r.users for r in queries["funnel"](spark, sf).collect()] == [150, 39, 10]
    headline = queries["headline"](spark, sf).first()
    assert (headline.total_users, headline.churned_users) == (1500, 1021)
    assert queries["cancelled_users"](spark, sf).count() == 38


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_same_result_as_sql(spark, duck, name):
    df = entry_module.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    cursor = duck.execute(entry_module.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)
    assert expected and got == expected
