"""Data-quality checks and the gate in front of publication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotlift.operators.checks import DuplicateCheck, RowCheck, not_null, outside, run_checks

WINDOW_MINUTES = 15
FACT = "marts.fact_campaign_sessions"
EFFECTIVENESS = "marts.mart_campaign_effectiveness"

# Table and check names, in the order they are reported.
DQ_CHECKS = (
    RowCheck("raw.grp_spots", "spot_id_not_null", not_null("spot_id")),
    RowCheck("raw.grp_spots", "campaign_id_not_null", not_null("campaign_id")),
    RowCheck("raw.sessions", "session_id_not_null", not_null("session_id")),
    RowCheck("raw.sessions", "session_timestamp_not_null", not_null("session_timestamp")),
    DuplicateCheck(FACT, "no_duplicate_attributed_sessions", "session_id"),
    RowCheck(FACT, "valid_attribution_window", outside("minutes_after_spot", 0, WINDOW_MINUTES)),
    RowCheck(EFFECTIVENESS, "non_negative_session_counts", "pre_spot_sessions < 0 OR post_spot_sessions < 0"),
)


class QualityGateError(RuntimeError):
    """Raised when data-quality checks found failing rows."""


def dq_results(tables: Mapping[str, DataFrame]) -> DataFrame:
    return run_checks(tables, DQ_CHECKS)


def worst_first(results: DataFrame) -> DataFrame:
    return results.orderBy(F.desc("failed_rows"))


def total_failures(results: DataFrame) -> DataFrame:
    return results.agg(F.coalesce(F.sum("failed_rows"), F.lit(0).cast("long")).alias("total_failures"))


def enforce(results: DataFrame) -> None:
    """Raise when any check failed. Call it after the results are stored."""
    failed = total_failures(results).first().total_failures
    if failed > 0:
        raise QualityGateError(f"Data quality checks failed. Total failed rows: {failed}")
