"""Every registered query against its SQL form, on the smallest tables with hot keys and edge values added.

`check.py` runs the same comparison on the tables as supplied, at any scale factor.
"""

import os

import duckdb
import pytest

import check
import skewed_tables
from __spark_entry__ import entry, queries
from marquee.plans import REGISTRY

FOLDER = "/root/testdata/sf0.001"
QUERIES = dict(REGISTRY)
SQL = {name: query.sql for name, query in REGISTRY.items() if query.sql}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="supplied tables not present")


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """A copy of the supplied tables with hot keys, ties, nulls and zeros."""
    folder = str(tmp_path_factory.mktemp("tables"))
    skewed_tables.write(FOLDER, folder)
    db = duckdb.connect()
    for table in check.TABLES:
        db.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return folder, db


def test_entry(spark):
    assert entry(spark).count() == 20


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, tables, name):
    folder, db = tables
    good, text, _ = check.compare(spark, db, name, folder, QUERIES[name], SQL[name])
    assert good, text


def test_a_day_is_cut_at_the_scan(spark, tables):
    plan = QUERIES["daily_page_of_day"](spark, tables[0])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-15" in plan and "LessThan(ts,2024-01-16" in plan
