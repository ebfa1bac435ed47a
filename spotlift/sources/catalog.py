"""Catalog databases, tables and views."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BEFORE = "__before"

DATABASES = ("raw", "audit", "staging", "intermediate", "marts", "dq", "ml")


def create_databases(spark: SparkSession, names: Iterable[str] = DATABASES) -> None:
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def replace_table(df: DataFrame, name: str) -> DataFrame:
    """Publish ``df`` as a new version of the table ``name`` and return it as read back.

    Rows go to a new folder beside the database; then one catalog call points the table there. A run that dies before that call
    leaves the old version in place, one that dies after it the new one; there is always a readable version. The version before the
    current one stays for readers that are still at it; older ones go, and so do folders that no version came of.

    A table whose columns change cannot be switched in one call. It is renamed, and should the run die before the new one has its
    name, the next call of this function or of ``recover`` gives the old one its name back.
    """
    spark = df.sparkSession
    recover(spark, name)
    database, table = _split(spark, name)
    home = f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/_versions/{table}"
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    path = f"{home}/{version}"
    df.write.parquet(path)
    before = _location(spark, name)
    if before is None:
        _create(df, name, path)
    elif _columns(spark.table(name)) == _columns(df):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    else:
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}{_BEFORE}")
        _create(df, name, path)
        spark.sql(f"DROP TABLE {name}{_BEFORE}")
    spark.catalog.refreshTable(name)
    _clear(spark, home, {version, (before or "").rstrip("/").rsplit("/", 1)[-1]}, version)
    return spark.table(name)


def recover(spark: SparkSession, name: str) -> None:
    """Gives a table its name back that a run which died had renamed."""
    if spark.catalog.tableExists(f"{name}{_BEFORE}"):
        if spark.catalog.tableExists(name):
            spark.sql(f"DROP TABLE {name}{_BEFORE}")
        else:
            spark.sql(f"ALTER TABLE {name}{_BEFORE} RENAME TO {name}")


def _create(df: DataFrame, name: str, path: str) -> None:
    df.sparkSession.catalog.createTable(name, path=path, source="parquet", schema=df.schema)


def _columns(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema]


def _split(spark: SparkSession, name: str) -> tuple[str, str]:
    database, dot, table = name.rpartition(".")
    return (database, table) if dot else (spark.catalog.currentDatabase(), name)


def _location(spark: SparkSession, name: str) -> str | None:
    """The folder of a table's rows; none where there is no table."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def _clear(spark: SparkSession, home: str, kept: set[str], newest: str) -> None:
    """Removes versions that are older than the newest and not kept; a later one belongs to another run."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(home)
    store = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for status in store.listStatus(folder):
        version = status.getPath().getName()
        if version < newest and version not in kept:
            store.delete(status.getPath(), True)


def append_table(df: DataFrame, name: str) -> None:
    """Append rows, creating the table on first use."""
    df.write.mode("append").format("parquet").saveAsTable(name)


def replace_view(spark: SparkSession, name: str, table: str, columns: Sequence[str]) -> DataFrame:
    """Create or replace a persistent view: one projection over one table."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(columns)} FROM {table}")
    return spark.table(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    """Whether a table or view exists; an unqualified name is looked up in every database."""
    if "." in name:
        database, table = name.split(".", 1)
        return spark.catalog.databaseExists(database) and spark.catalog.tableExists(f"{database}.{table}")
    return any(spark.catalog.tableExists(f"{d.name}.{name}") for d in spark.catalog.listDatabases())


def list_tables(spark: SparkSession, databases: Iterable[str] = DATABASES) -> list[str]:
    present = [d for d in databases if spark.catalog.databaseExists(d)]
    return [f"{d}.{t.name}" for d in present for t in spark.catalog.listTables(d)]


def first_available(spark: SparkSession, names: Iterable[str]) -> str | None:
    return next((n for n in names if table_exists(spark, n)), None)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` of several tables in one job."""
    parts = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)
