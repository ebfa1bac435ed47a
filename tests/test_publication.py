"""Replacing tables: a run that dies between any two steps leaves the old or the new version readable."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import SparkSession

from spotlift.sources import catalog


class Died(Exception):
    pass


@pytest.fixture
def name(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS published")
    yield "published.numbers"
    for table in ("published.numbers", "published.numbers__before"):
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def _rows(spark, name):
    return sorted(tuple(r) for r in spark.table(name).collect())


def _versions(spark):
    home = spark.catalog.getDatabase("published").locationUri.removeprefix("file:")
    return os.listdir(f"{home}/_versions/numbers")


def test_versions(spark, name):
    for last in range(1, 6):
        got = catalog.replace_table(spark.range(last), name)
        assert sorted(r["id"] for r in got.collect()) == list(range(last))
    assert len(_versions(spark)) == 2  # the current one and the one before
    reader = spark.table(name)
    catalog.replace_table(spark.range(7), name)
    assert reader.count() == 5  # it goes on with the version that it has looked up
    assert spark.table(name).count() == 7
    own = catalog.replace_table(spark.table(name).where("id < 3"), name)  # a table made from itself
    assert sorted(r["id"] for r in own.collect()) == [0, 1, 2]


@pytest.mark.parametrize("changed", [False, True])
@pytest.mark.parametrize("step", range(6))
def test_death_between_steps(spark, name, monkeypatch, step, changed):
    """The run dies before its catalog call number ``step``; with the same columns the name is readable at every moment."""
    old = [(0,), (1,)]
    catalog.replace_table(spark.range(2), name)
    new = spark.range(3).selectExpr("id", "id * 2 AS twice") if changed else spark.range(3)
    calls = []
    sql, create, clear = SparkSession.sql, catalog._create, catalog._clear

    def counted(real):
        def call(*args, **kwargs):
            changing = not (real is sql and not str(args[1]).startswith(("ALTER", "DROP")))
            if changing:
                if len(calls) == step:
                    raise Died
                calls.append(1)
            return real(*args, **kwargs)

        return call

    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "sql", counted(sql))
        patch.setattr(catalog, "_create", counted(create))
        patch.setattr(catalog, "_clear", counted(clear))
        try:
            catalog.replace_table(new, name)
        except Died:
            pass
    wanted = sorted(tuple(r) for r in new.collect())
    if not changed:
        assert _rows(spark, name) in (old, wanted)
    catalog.recover(spark, name)
    assert _rows(spark, name) in (old, wanted)
    assert sorted(tuple(r) for r in catalog.replace_table(new, name).collect()) == wanted
    assert not catalog.table_exists(spark, f"{name}__before")


def test_failed_rows_leave_the_old_version(spark, name):
    catalog.replace_table(spark.range(2), name)
    with pytest.raises(Exception, match="(?i)divi"):
        catalog.replace_table(spark.range(5).selectExpr("id / (id - id) AS id"), name)
    assert _rows(spark, name) == [(0,), (1,)]


def test_a_table_of_another_make(spark, name):
    """Tables that the catalog manages itself are taken over."""
    spark.range(4).write.format("parquet").saveAsTable(name)
    assert catalog.replace_table(spark.range(2), name).count() == 2
    spark.sql(f"DROP TABLE {name}")
    assert catalog.replace_table(spark.range(1), name).count() == 1
