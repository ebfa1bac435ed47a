"""The QA report: files, schemas, tables, keys, attribution window, lift and scores.

A check yields rows of ``(check_name, status, details)``. Checks that read data count their
failing rows in one aggregation and stay lazy until the report is stored; checks that read
metadata only (file listing, catalog, column names) are decided on the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, FractionalType, IntegralType, NumericType

from spotlift.functions.numeric import invalid_number, is_boolean, is_missing
from spotlift.functions.timing import days_between
from spotlift.operators.checks import failing_rows, outside, union_all
from spotlift.schemas import RAW_SOURCES
from spotlift.sources import catalog
from spotlift.sources.csv_files import discover, path_exists, read_text_columns, write_csv

PASSED, FAILED, WARNING = "PASSED", "FAILED", "WARNING"
_ROW = "check_name string, status string, details string"

#: Written by a run only if it is asked to.
CANDIDATE_TABLE = "intermediate.int_session_campaign_candidates"
# Tables a full run leaves behind.
EXPECTED_TABLES = (
    "raw.campaign_master",
    "raw.grp_spots",
    "raw.odec_mapping",
    "raw.sessions",
    "staging.stg_campaign_master",
    "staging.stg_grp_spots",
    "staging.stg_odec_mapping",
    "staging.stg_sessions",
    "intermediate.int_session_campaign_candidates",
    "intermediate.int_attributed_sessions",
    "intermediate.int_pre_post_spot_sessions",
    "marts.fact_campaign_sessions",
    "marts.mart_campaign_effectiveness",
    "marts.odec_ready_campaign_dataset",
    "ml.ml_campaign_response_scores",
    "dq.dq_results",
    "audit.ingestion_log",
)


class QaError(RuntimeError):
    """Raised when the report holds a FAILED check."""


@dataclass(frozen=True)
class QaConfig:
    """What to check. Names of columns, bounds and candidate tables are parameters."""

    required_files: Sequence[str] = tuple(s.path for s in RAW_SOURCES)
    minimum_rows: Mapping[str, int] = field(default_factory=lambda: {s.path: 1 for s in RAW_SOURCES})
    #: file -> column -> "number" or "string"
    expected_schemas: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    #: The candidates' table is expected only from a run that publishes it: pass ``EXPECTED_TABLES`` then.
    expected_tables: Sequence[str] = tuple(t for t in EXPECTED_TABLES if t != CANDIDATE_TABLE)
    primary_keys: Mapping[str, str] = field(default_factory=lambda: {s.table: s.key for s in RAW_SOURCES})
    attribution_tables: Sequence[str] = (
        "intermediate.int_attributed_sessions",
        "marts.fact_campaign_sessions",
        "marts.mart_campaign_effectiveness",
    )
    impression_column: str = "spot_ts"
    conversion_column: str = "session_ts"
    max_days: int = 7
    lift_tables: Sequence[str] = (
        "marts.mart_campaign_effectiveness",
        "marts.fact_campaign_sessions",
        "intermediate.int_pre_post_spot_sessions",
    )
    rate_columns: Sequence[str] = ()
    lift_column: str = "incremental_lift_pct"
    score_tables: Sequence[str] = ("ml.ml_campaign_response_scores", "marts.odec_ready_campaign_dataset")
    score_bounds: tuple[float, float] = (-1.0, 1.0)


def fixed(spark: SparkSession, rows: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rows), _ROW)


def _verdict(counts: DataFrame, name: str, count: str, failed: str, passed: str) -> DataFrame:
    bad = F.col(count)
    return counts.select(
        F.lit(name).alias("check_name"),
        F.when(bad > 0, FAILED).otherwise(PASSED).alias("status"),
        F.when(bad > 0, F.concat(F.lit(failed), bad.cast("string")))
        .otherwise(passed)
        .alias("details"),
    )


# --- files -----------------------------------------------------------------------------


def file_checks(spark: SparkSession, root: str, required: Sequence[str]) -> DataFrame:
    """A required source is a file, or a folder of part files, with at least one byte."""
    owner = F.coalesce(
        *[F.when((F.col("path") == r) | F.startswith("path", F.lit(f"{r}/")), F.lit(r)) for r in required]
    )
    found = discover(spark, root).groupBy(owner.alias("required")).agg(F.sum("length").alias("size"))
    # A scan leaves files without content out, so whether the path is there is asked apart.
    there = [(r, path_exists(spark, f"{root.rstrip('/')}/{r}")) for r in required]
    sizes = spark.createDataFrame(there, "required string, there boolean").join(found, "required", "left")
    missing, empty = ~F.col("there"), F.coalesce("size", F.lit(0)) == 0
    full = F.concat(F.lit(f"{root.rstrip('/')}/"), "required")
    kind = F.when(missing, "File exists: ").otherwise("File not empty: ")
    return sizes.select(
        F.concat(kind, "required").alias("check_name"),
        F.when(missing | empty, FAILED).otherwise(PASSED).alias("status"),
        F.when(missing, F.concat(F.lit("Missing required file: "), full))
        .when(empty, F.concat(F.lit("File is empty: "), full))
        .otherwise(F.concat(F.lit("File exists and size="), F.col("size").cast("string"), F.lit(" bytes")))
        .alias("details"),
    )


def column_set_checks(spark: SparkSession, name: str, actual: Sequence[str], expected: Sequence[str]) -> DataFrame:
    missing, extra = sorted(set(expected) - set(actual)), sorted(set(actual) - set(expected))
    return fixed(
        spark,
        [
            (f"Schema columns: {name}", FAILED, f"Missing columns: {missing}")
            if missing
            else (f"Schema columns: {name}", PASSED, "All required columns exist"),
            (f"Extra columns: {name}", WARNING, f"Extra columns found: {extra}")
            if extra
            else (f"Extra columns: {name}", PASSED, "No unexpected columns"),
        ],
    )


def _invalid_values(column: str) -> Column:
    """Values that are no number; a column of booleans only counts as numeric."""
    others = F.count_if(~is_missing(column) & ~is_boolean(column))
    return F.when(others > 0, F.count_if(invalid_number(column))).otherwise(0)


def numeric_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, invalid_values)`` for columns that should be numbers, in one pass."""
    typed = {f.name: isinstance(f.dataType, NumericType) for f in df.schema}
    counts = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                (F.lit(0).cast("long") if typed[c] else _invalid_values(c)).alias("invalid_values"),
            )
            for c in columns
        ]
    )
    return df.agg(counts.alias("counts")).select(F.inline("counts"))


def column_type_checks(spark: SparkSession, name: str, df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    present = [c for c in expected if c in df.columns]
    others = [c for c in present if expected[c] != "number"]
    parts = [fixed(spark, [(f"Column type: {name}.{c}", PASSED, "String/object-compatible column validated")
                           for c in others])]
    numbers = [c for c in present if expected[c] == "number"]
    if numbers:
        bad = F.col("invalid_values")
        parts.append(
            numeric_columns(df, numbers).select(
                F.concat(F.lit(f"Column type: {name}."), "column_name").alias("check_name"),
                F.when(bad > 0, FAILED).otherwise(PASSED).alias("status"),
                F.when(bad > 0, F.concat(F.lit("Expected numeric, invalid values="), bad.cast("string")))
                .otherwise("Numeric column validated")
                .alias("details"),
            )
        )
    return union_all(parts)


def schema_checks(spark: SparkSession, root: str, expected: Mapping[str, Mapping[str, str]]) -> list[DataFrame]:
    parts = []
    for name, columns in expected.items():
        path = f"{root.rstrip('/')}/{name}"
        if not path_exists(spark, path):
            missing = "There is no such file to compare"
            parts.append(fixed(spark, [(f"Schema check: {name}", FAILED, missing)]))
            continue
        df = read_text_columns(spark, path)
        parts.append(column_set_checks(spark, name, df.columns, list(columns)))
        parts.append(column_type_checks(spark, name, df, columns))
    return parts


def minimum_row_check(df: DataFrame, name: str, minimum: int) -> DataFrame:
    rows = F.col("rows")
    return df.agg(F.count("*").alias("rows")).select(
        F.lit(f"Raw row count: {name}").alias("check_name"),
        F.when(rows < minimum, FAILED).otherwise(PASSED).alias("status"),
        F.when(rows < minimum, F.concat(F.lit(f"Expected at least {minimum}, actual="), rows.cast("string")))
        .otherwise(F.concat(F.lit("Actual rows="), rows.cast("string")))
        .alias("details"),
    )


def row_count_checks(spark: SparkSession, root: str, minimum_rows: Mapping[str, int]) -> list[DataFrame]:
    parts = []
    for name, minimum in minimum_rows.items():
        path = f"{root.rstrip('/')}/{name}"
        if path_exists(spark, path):
            parts.append(minimum_row_check(read_text_columns(spark, path), name, minimum))
        else:
            parts.append(fixed(spark, [(f"Raw row count: {name}", FAILED, "File missing")]))
    return parts


# --- tables ----------------------------------------------------------------------------


def table_checks(spark: SparkSession, expected: Sequence[str]) -> list[DataFrame]:
    known = [t for t in expected if catalog.table_exists(spark, t)]
    found = "PASSED" if catalog.list_tables(spark) else "FAILED"
    parts = [fixed(spark, [("Catalog exists", found, f"Warehouse: {spark.conf.get('spark.sql.warehouse.dir')}")])]
    if known:
        counts = catalog.row_counts({t: spark.table(t) for t in known})
        parts.append(
            counts.select(
                F.concat(F.lit("Table exists: "), "table_name").alias("check_name"),
                F.lit(PASSED).alias("status"),
                F.concat(F.lit("Rows="), F.col("row_count").cast("string")).alias("details"),
            )
        )
    absent = [t for t in expected if t not in known]
    if absent:
        parts.append(fixed(spark, [(f"Table exists: {t}", FAILED, "Table missing") for t in absent]))
    return parts


def key_profile(df: DataFrame, key: str) -> DataFrame:
    """``(null_keys, duplicate_groups)`` of a primary key from one grouping; nulls are one group."""
    rows = F.col("rows")
    return (
        df.groupBy(F.col(key).alias("key"))
        .agg(F.count("*").alias("rows"))
        .agg(
            F.coalesce(F.sum(F.when(F.col("key").isNull(), rows)), F.lit(0)).alias("null_keys"),
            F.count_if(rows > 1).alias("duplicate_groups"),
        )
    )


def key_checks(keys: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Null and duplicate checks of primary keys, given as (table, rows, column); two rows for each.

    All keys are counted by one grouping with one shuffle, whole numbers as such and other types as text.
    """
    rows = union_all([_typed_key(df, key).withColumn("no", F.lit(no)) for no, (_, df, key) in enumerate(keys)])
    counted = rows.groupBy("no", "whole", "other").agg(F.count("*").alias("rows"))
    found = counted.agg(
        *[F.coalesce(F.sum(F.when((F.col("no") == no) & _no_key(), F.col("rows"))), F.lit(0)).alias(f"null_{no}") for no in range(len(keys))],
        *[F.count_if((F.col("no") == no) & (F.col("rows") > 1)).alias(f"duplicate_{no}") for no in range(len(keys))],
    )

    def verdict(name: str, place: str, bad: Column, failed: str, passed: str) -> Column:
        return F.struct(
            F.lit(f"{name}: {place}").alias("check_name"),
            F.when(bad > 0, FAILED).otherwise(PASSED).alias("status"),
            F.when(bad > 0, F.concat(F.lit(failed), bad.cast("string"))).otherwise(passed).alias("details"),
        )

    verdicts = []
    for no, (table, _, key) in enumerate(keys):
        place = f"{table}.{key}"
        verdicts.append(verdict("Null check", place, F.col(f"null_{no}"), "Null count=", "No null primary keys"))
        verdicts.append(verdict("Duplicate check", place, F.col(f"duplicate_{no}"), "Duplicate key groups=", "No duplicate primary keys"))
    return found.select(F.inline(F.array(*verdicts)))


def _no_key() -> Column:
    return F.col("whole").isNull() & F.col("other").isNull()


def _typed_key(df: DataFrame, key: str) -> DataFrame:
    kind, column = df.schema[key].dataType, F.col(key)
    if isinstance(kind, IntegralType):
        return df.select(column.cast("bigint").alias("whole"), F.lit(None).cast("string").alias("other"))
    if isinstance(kind, FractionalType) and not isinstance(kind, DecimalType):
        column = column + F.lit(0.0)  # minus zero is zero
    return df.select(F.lit(None).cast("bigint").alias("whole"), column.cast("string").alias("other"))


def attribution_failures(df: DataFrame, impression: str, conversion: str, max_days: int = 7) -> DataFrame:
    """``(invalid_rows)``: conversions before their impression or more than ``max_days`` after it."""
    late = f"{days_between(impression, conversion)} > {int(max_days)}"
    return failing_rows(df, {"invalid_rows": f"{conversion} < {impression} OR {late}"})


def rate_failures(df: DataFrame, rates: Sequence[str], low: float = 0, high: float = 1) -> DataFrame:
    """``(invalid_rows)``: rows with any rate outside the bounds; a null rate does not count."""
    return failing_rows(df, {"invalid_rows": " OR ".join(outside(c, low, high) for c in rates)})


def null_lift(df: DataFrame, lift: str) -> DataFrame:
    return failing_rows(df, {"invalid_rows": F.col(lift).isNull()})


def score_column(columns: Sequence[str]) -> str | None:
    """First column whose name speaks of a score or probability."""
    return next((c for c in columns if "score" in c.lower() or "prob" in c.lower()), None)


def score_failures(df: DataFrame, score: str, low: float, high: float) -> DataFrame:
    """``(invalid_rows)``: scores outside the bounds or null."""
    return failing_rows(df, {"invalid_rows": outside(score, low, high, null_fails=True)})


def attribution_checks(spark: SparkSession, config: QaConfig) -> list[DataFrame]:
    table = catalog.first_available(spark, config.attribution_tables)
    if table is None:
        return [_no_table(spark, "Attribution table exists", "attribution")]
    df = spark.table(table)
    needed = {config.impression_column, config.conversion_column}
    if not needed <= set(df.columns):
        details = f"{table} lacks {sorted(needed - set(df.columns))}; it has {df.columns}"
        return [fixed(spark, [("Attribution-window columns", WARNING, details)])]
    counts = attribution_failures(df, config.impression_column, config.conversion_column, config.max_days)
    span = f"{config.max_days}-day window"
    return [
        _verdict(
            counts,
            "Attribution-window logic",
            "invalid_rows",
            f"Invalid attributed rows outside {span}=",
            f"All attributed conversions are within valid {span} in {table}",
        )
    ]


def lift_checks(spark: SparkSession, config: QaConfig) -> list[DataFrame]:
    table = catalog.first_available(spark, config.lift_tables)
    if table is None:
        return [_no_table(spark, "Incremental lift table exists", "incremental lift")]
    df = spark.table(table)
    missing = [c for c in (*config.rate_columns, config.lift_column) if c not in df.columns]
    if missing:
        details = f"{table} has no column {missing}"
        return [fixed(spark, [("Incremental lift metric columns", WARNING, details)])]
    parts = []
    if config.rate_columns:
        rates = rate_failures(df, config.rate_columns)
        parts.append(
            _verdict(rates, "Incremental lift rate bounds", "invalid_rows", "Rates outside 0-1 range=",
                     "Conversion rates are within 0-1 range")
        )
    nulls = null_lift(df, config.lift_column)
    parts.append(
        _verdict(nulls, "Incremental lift null check", "invalid_rows", f"Null {config.lift_column} rows=",
                 "No null incremental lift values")
    )
    return parts


def score_checks(spark: SparkSession, config: QaConfig) -> list[DataFrame]:
    table = catalog.first_available(spark, config.score_tables)
    if table is None:
        return [_no_table(spark, "ML scoring table exists", "ML scoring")]
    df = spark.table(table)
    score = score_column(df.columns)
    if score is None:
        details = f"No column of {table} is named after a score or probability: {df.columns}"
        return [fixed(spark, [("ML probability column exists", WARNING, details)])]
    low, high = config.score_bounds
    bounds = _verdict(
        score_failures(df, score, low, high),
        "ML score bounds",
        "invalid_rows",
        f"Invalid score rows in {table}.{score}=",
        f"All ML scores in {table}.{score} are between {low:g} and {high:g}",
    )
    rows = F.col("rows")
    size = df.agg(F.count("*").alias("rows")).select(
        F.lit("ML output row count").alias("check_name"),
        F.when(rows == 0, FAILED).otherwise(PASSED).alias("status"),
        F.when(rows == 0, f"{table} has 0 rows")
        .otherwise(F.concat(F.lit(f"{table} rows="), rows.cast("string")))
        .alias("details"),
    )
    return [bounds, size]


def _no_table(spark: SparkSession, check: str, kind: str) -> DataFrame:
    details = f"No standard {kind} table found. Available tables={catalog.list_tables(spark)}"
    return fixed(spark, [(check, WARNING, details)])


# --- report ----------------------------------------------------------------------------


def stamped(results: Sequence[DataFrame]) -> DataFrame:
    checked_at = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    return union_all(results).withColumn("checked_at", checked_at)


def publish(results: Sequence[DataFrame], report_path: str) -> DataFrame:
    """Store the report, then raise if any check in it failed."""
    spark = results[0].sparkSession
    write_csv(stamped(results), report_path)
    report = read_text_columns(spark, report_path)
    failed = report.where(F.col("status") == FAILED).count()
    if failed:
        raise QaError(f"{failed} QA checks failed, see {report_path}")
    return report


def run_qa(
    spark: SparkSession, root: str, report_path: str, config: QaConfig | None = None, fail_fast: bool = False
) -> DataFrame:
    """Run all checks over the raw files below ``root`` and the catalog tables.

    With ``fail_fast`` the report is stored and the run ends after the first group of checks
    that holds a failure; otherwise it covers all groups first.
    """
    config = config or QaConfig()
    groups = (
        lambda: [file_checks(spark, root, config.required_files)],
        lambda: schema_checks(spark, root, config.expected_schemas),
        lambda: row_count_checks(spark, root, config.minimum_rows),
        lambda: table_checks(spark, config.expected_tables),
        lambda: _all_key_checks(spark, config.primary_keys),
        lambda: attribution_checks(spark, config),
        lambda: lift_checks(spark, config),
        lambda: score_checks(spark, config),
    )
    results: list[DataFrame] = []
    for group in groups:
        found = group()
        if fail_fast and found:  # looked at now and written later, from one evaluation
            rows = [tuple(r) for r in union_all(found).collect()]  # one row for each check
            found = [fixed(spark, rows)] if rows else []
            results += found
            if any(status == FAILED for _, status, _ in rows):
                break
        else:
            results += found
    return publish(results, report_path)


def _all_key_checks(spark: SparkSession, keys: Mapping[str, str]) -> list[DataFrame]:
    there = [table for table in keys if catalog.table_exists(spark, table)]
    parts = [fixed(spark, [(f"Null check: {t}.{k}", FAILED, "Table missing")]) for t, k in keys.items() if t not in there]
    return [*parts, key_checks([(t, spark.table(t), keys[t]) for t in there])] if there else parts
