"""Every registered query against its SQL twin on the small tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from conftest import TABLES

import __spark_entry__ as entry_point
from tablemend import queries as registered
from tools.check_queries import plan_for_large_tables, rows_of

pytestmark = pytest.mark.skipif(not Path(TABLES).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def sql_tables():
    db = duckdb.connect()
    for path in sorted(Path(TABLES).glob("*.parquet")):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return db


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query_equals_sql(spark, sql_tables, name):
    df = registered.queries()[name](spark, TABLES)
    cursor = sql_tables.execute(registered.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, cursor.fetchall())


SKEWED = (
    "q14 q16 q18 q21 q23 q24 q27 q37 q39 q41 q42 q43 q46 q47 q56 q58 q62 q72 q74 q80 q89 q92"
).split()


@pytest.fixture
def large_plans(spark):
    """Plans as for large tables: nothing is broadcast by size, and every key above 20 rows is hot."""
    undo = plan_for_large_tables(spark, 20)
    yield
    undo()


@pytest.mark.parametrize("name", [n for n in sorted(registered.queries()) if n.split("_")[0] in SKEWED])
def test_query_with_hot_keys_equals_sql(spark, sql_tables, large_plans, name):
    test_query_equals_sql(spark, sql_tables, name)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_names_are_plain():
    assert all("pipeline" not in n and not n.startswith("op") for n in registered.queries())
    assert registered.queries().keys() <= entry_point.queries().keys()
