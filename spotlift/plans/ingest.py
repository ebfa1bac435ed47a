"""Raw ingestion with an audit log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotlift.schemas import RAW_SOURCES, RawSource
from spotlift.sources.catalog import append_table, create_databases, replace_table, row_counts
from spotlift.sources.csv_files import path_exists, read_typed, require_paths

AUDIT_TABLE = "audit.ingestion_log"


def with_ingestion_stamp(df: DataFrame) -> DataFrame:
    return df.withColumn("ingestion_ts", F.current_timestamp())


def audit_rows(tables: Mapping[str, DataFrame], paths: Mapping[str, str], status: str = "SUCCESS") -> DataFrame:
    """``(table_name, file_path, row_count, status)``, one row per loaded table."""
    path_of = F.create_map(*[F.lit(v) for item in paths.items() for v in item])
    return row_counts(tables).select(
        "table_name",
        path_of[F.col("table_name")].alias("file_path"),
        "row_count",
        F.lit(status).alias("status"),
    )


def _log_failed(spark: SparkSession, failed: Sequence[tuple[str, str]]) -> None:
    schema = "table_name string, file_path string, row_count bigint, status string"
    rows = [(table, path, None, "FAILED") for table, path in failed]
    append_table(with_ingestion_stamp(spark.createDataFrame(rows, schema)), AUDIT_TABLE)


def ingest(spark: SparkSession, root: str, sources: Sequence[RawSource] = RAW_SOURCES) -> dict[str, DataFrame]:
    """Load every source into its raw table and log each load.

    All sources are looked up before the first table is replaced; a missing one is logged
    as FAILED and nothing is loaded.
    """
    create_databases(spark)
    paths = {s.table: f"{root.rstrip('/')}/{s.path}" for s in sources}
    missing = [(t, p) for t, p in paths.items() if not path_exists(spark, p)]
    if missing:
        _log_failed(spark, missing)
    require_paths(spark, [p for _, p in missing])

    tables = {}
    for s in sources:
        stamped = with_ingestion_stamp(read_typed(spark, paths[s.table], s.schema))
        try:
            tables[s.table] = replace_table(stamped, s.table)
        except Exception:
            _log_failed(spark, [(s.table, paths[s.table])])
            raise
        append_table(with_ingestion_stamp(audit_rows({s.table: tables[s.table]}, paths)), AUDIT_TABLE)
    return tables
