"""Every registered query against its SQL counterpart on the smallest test tables."""

from __future__ import annotations

import os

import pytest
from compare import connect, duckdb_rows, spark_rows

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    assert spark_rows(queries()[name](spark, FOLDER)) == duckdb_rows(duck, oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_sql_gives_rows(spark, name):
    assert queries()[name](spark, FOLDER).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())
