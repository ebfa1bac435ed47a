"""Business measures and chart frames over the marts.

Averages are rounded to six digits so that they do not depend on the order of summation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotlift.operators.ranking import global_rank

DIGITS = 6


def _avg(column: str, name: str) -> Column:
    return F.round(F.avg(column), DIGITS).alias(name)


def kpi_summary(effectiveness: DataFrame) -> DataFrame:
    return effectiveness.agg(
        F.count_distinct("campaign_id").alias("total_campaigns"),
        F.sum("attributed_sessions").alias("total_attributed_sessions"),
        _avg("incremental_lift_pct", "avg_incremental_lift_pct"),
    )


def budget_by_campaign(effectiveness: DataFrame) -> DataFrame:
    """The mart repeats a campaign's budget on each of its spots, so it is not summed."""
    return effectiveness.groupBy("campaign_id", "campaign_name").agg(F.max("budget").alias("budget"))


def campaign_ranking(effectiveness: DataFrame) -> DataFrame:
    campaigns = effectiveness.groupBy("campaign_id", "campaign_name").agg(
        _avg("incremental_lift_pct", "avg_lift_pct"), F.sum("attributed_sessions").alias("attributed_sessions")
    )
    best_first = {"avg_lift_pct": "desc", "attributed_sessions": "desc", "campaign_id": "asc"}
    return global_rank(campaigns, best_first, "campaign_rank")


def grp_by_channel(spots: DataFrame, channels: DataFrame) -> DataFrame:
    """Rating points per channel, from the spots: the fact repeats them per session."""
    per_channel = spots.groupBy("channel_id").agg(F.round(F.sum("grp_value"), DIGITS).alias("total_grp"))
    return per_channel.join(channels.select("channel_id", "channel_name"), "channel_id", "left")


def sessions_after_spots(effectiveness: DataFrame) -> DataFrame:
    return effectiveness.agg(F.sum("post_spot_sessions").alias("sessions_after_spots"))


def attributed_by_channel(fact: DataFrame) -> DataFrame:
    return fact.groupBy("channel_id", "channel_name").agg(F.count("*").alias("attributed_sessions"))


def performance_by_channel_type(effectiveness: DataFrame) -> DataFrame:
    return effectiveness.groupBy("channel_type").agg(
        F.count("*").alias("spots"),
        _avg("incremental_lift_pct", "avg_lift_pct"),
        F.sum("post_spot_sessions").alias("post_spot_sessions"),
        F.sum("attributed_sessions").alias("attributed_sessions"),
    )


def score_distribution(scores: DataFrame, width: float = 0.05) -> DataFrame:
    """Spots per score bin ``[bin_start, bin_start + width)``."""
    bin_no = F.floor(F.col("anomaly_score") / F.lit(width))
    return (
        scores.groupBy(bin_no.alias("bin"))
        .agg(F.count("*").alias("spots"))
        .withColumn("bin_start", F.round(F.col("bin") * F.lit(width), DIGITS))
    )


def segment_counts(segmented: DataFrame) -> DataFrame:
    return segmented.groupBy("response_segment", "campaign_id").agg(F.count("*").alias("spots"))


def response_ranking(scores: DataFrame) -> DataFrame:
    campaigns = scores.groupBy("campaign_id").agg(_avg("anomaly_score", "avg_anomaly_score"))
    return global_rank(campaigns, {"avg_anomaly_score": "desc", "campaign_id": "asc"}, "response_rank")


def average_response_score(scores: DataFrame) -> DataFrame:
    return scores.agg(_avg("anomaly_score", "avg_anomaly_score"))


def device_source_patterns(attributed: DataFrame) -> DataFrame:
    return attributed.groupBy("device_type", "session_source").agg(F.count("*").alias("attributed_sessions"))


def chart_pre_post(effectiveness: DataFrame) -> DataFrame:
    """Pre and post sessions, lift and attributed sessions per spot, in spot order."""
    return effectiveness.select(
        "campaign_id",
        "channel_id",
        "spot_id",
        "pre_spot_sessions",
        "post_spot_sessions",
        F.coalesce("incremental_lift_pct", F.lit(0.0)).alias("incremental_lift_pct"),
        "attributed_sessions",
    ).orderBy("spot_id", "campaign_id")


def chart_anomaly(scores: DataFrame) -> DataFrame:
    return scores.select(
        "spot_id", "campaign_id", "incremental_lift_pct", "anomaly_score", "is_abnormal_response", "response_segment"
    ).orderBy("spot_id", "campaign_id")
