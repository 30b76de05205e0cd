"""Every registered query against its SQL."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_module
from compare import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry_module.queries()
SQL = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def database():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, database, name):
    assert differences(QUERIES[name](spark, SF_DIR), database, SQL[name]) == []
