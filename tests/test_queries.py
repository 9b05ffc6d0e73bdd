"""Every registered query against its SQL."""

import os

import pytest

import __spark_entry__ as entry_module
from comparison import connect, difference
from suite import QUERIES, SQL

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, database, name):
    assert difference(QUERIES[name](spark, FOLDER), database, SQL[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry_has_rows_and_a_stable_schema(spark):
    first, second = entry_module.entry(spark), entry_module.entry(spark)
    assert first.schema == second.schema
    assert not first.isEmpty()
