"""Candidates, attribution, pre/post counts and the three published marts.

Dimension joins carry no broadcast hint: Spark broadcasts a dimension when its measured size
is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and merges, where
adaptive execution splits hot keys. Dimension keys may repeat and then multiply rows; the
QA report guards their uniqueness.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotlift.functions.response import lift_pct
from spotlift.functions.timing import minute_no, minutes_between
from spotlift.operators.asof import asof_join
from spotlift.operators.interval_join import interval_join
from spotlift.operators.pair_ranges import PairRanges, pair_ranges
from spotlift.operators.reach_index import BROADCAST_BYTES
from spotlift.operators.salting import ROWS_PER_TASK
from spotlift.operators.window_counts import counts_around

WINDOW_S = 15 * 60

# Column order of the published tables.
CANDIDATE_COLUMNS = [
    "session_id", "user_id", "session_ts", "device_type", "session_source",
    "spot_id", "campaign_id", "channel_id", "spot_ts", "spot_date", "grp_value",
]
FACT_COLUMNS = [
    "session_id", "user_id", "session_ts", "spot_id", "campaign_id", "campaign_name", "brand",
    "channel_id", "odec_channel_code", "channel_name", "channel_type", "spot_ts",
    "minutes_after_spot", "grp_value", "attribution_flag",
]
EFFECTIVENESS_COLUMNS = [
    "spot_id", "campaign_id", "campaign_name", "brand", "channel_id", "channel_name",
    "channel_type", "spot_ts", "pre_spot_sessions", "post_spot_sessions",
    "incremental_lift_pct", "attributed_sessions", "budget",
]
ODEC_COLUMNS = [
    "campaign_id", "campaign_name", "brand", "channel_id", "odec_channel_code", "channel_name",
    "channel_type", "spot_id", "spot_ts", "session_id", "session_ts", "minutes_after_spot",
    "grp_value", "attribution_flag",
]

_SPOT_KEYS = ["spot_id", "campaign_id", "channel_id", "spot_ts"]


def _spot_side(spots: DataFrame) -> DataFrame:
    return spots.select("spot_id", "campaign_id", "channel_id", "spot_ts", "spot_date", "grp_value")


def _with_minutes(pairs: DataFrame) -> DataFrame:
    return pairs.selectExpr(*CANDIDATE_COLUMNS, f"{minutes_between('spot_ts', 'session_ts')} AS minutes_after_spot")


def _with_minute(df: DataFrame, side: str) -> DataFrame:
    """``df`` with the minute of its time, computed once for each row and not for each pair."""
    return df.selectExpr("*", f"{minute_no(f'{side}_ts')} AS {side}_minute")


#: Minutes of a pair, computed once for a session and a list of spots of one minute.
_MINUTES = {"together": ["spot_minute"], "once": ["session_minute - spot_minute AS minutes_after_spot"]}


def session_spot_candidates(
    sessions: DataFrame, spots: DataFrame, window_s: int = WINDOW_S, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Every session with every spot aired up to 15 minutes before it."""
    points, anchors = _with_minute(sessions, "session"), _with_minute(_spot_side(spots), "spot")
    pairs = interval_join(points, anchors, "session_ts", "spot_ts", 0, window_s, rows_per_task, **_MINUTES)
    return pairs.select(*CANDIDATE_COLUMNS, "minutes_after_spot")


def candidate_ranges(sessions: DataFrame, spots: DataFrame, window_s: int = WINDOW_S) -> PairRanges:
    """The same pairs as ranges of numbered spots for each instant with sessions; its size does not grow with the pairs."""
    return pair_ranges(sessions, _with_minute(_spot_side(spots), "spot"), "session_ts", "spot_ts", window_s)


def expanded_candidates(ranges: PairRanges, sessions: DataFrame) -> DataFrame:
    """``session_spot_candidates`` from its ranges."""
    return ranges.expanded(_with_minute(sessions, "session"), **_MINUTES).select(*CANDIDATE_COLUMNS, "minutes_after_spot")


def nearest_spots(
    sessions: DataFrame,
    spots: DataFrame,
    window_s: int = WINDOW_S,
    rows_per_task: int = ROWS_PER_TASK,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Each session row with the latest spot aired up to 15 minutes before it."""
    spots = _spot_side(spots)
    nearest = asof_join(
        sessions, spots, "session_ts", "spot_ts", window_s, ["spot_id"], rows_per_task, broadcast_bytes
    )
    return _with_minutes(nearest)


def attributed_sessions(nearest: DataFrame) -> DataFrame:
    """One row per session id: the one with the fewest minutes since its spot.

    Among equal minutes the later spot wins, then the lower spot id; a hash of the remaining columns
    only settles repeated session ids, so that a consumer need not carry them. Fewer minutes and a later spot go together, so the
    best candidate of a session is its nearest spot and the pairs need not be ranked. Spark
    keeps the top row per id on the map side before the shuffle, so a session id repeated
    very often arrives as one row per map task.
    """
    rest = [c for c in CANDIDATE_COLUMNS if c not in ("session_id", "spot_id", "spot_ts")]
    best_first = "minutes_after_spot, spot_ts DESC, spot_id ASC NULLS LAST, settled_by"
    return (
        nearest.selectExpr("*", f"xxhash64({', '.join(rest)}) AS settled_by")
        .selectExpr("*", f"row_number() OVER (PARTITION BY session_id ORDER BY {best_first}) AS attribution_rank")
        .where("attribution_rank = 1")
        .withColumn("attribution_rank", F.expr("cast(attribution_rank AS bigint)"))
        .drop("settled_by")
    )


def pre_post_spot_sessions(sessions: DataFrame, spots: DataFrame, window_s: int = WINDOW_S) -> DataFrame:
    """Sessions in the 15 minutes up to and from each spot; zero where there are none.

    A spot listed several times counts its sessions that many times.
    """
    listed = spots.groupBy(*_SPOT_KEYS).agg(F.expr("count(*) AS times"))
    around = counts_around(spots, sessions, "spot_ts", "session_ts", window_s)
    return listed.join(around, "spot_ts", "left").selectExpr(
        *_SPOT_KEYS,
        "coalesce(before, 0) * times AS pre_spot_sessions",
        "coalesce(after, 0) * times AS post_spot_sessions",
    )


def fact_campaign_sessions(attributed: DataFrame, campaigns: DataFrame, channels: DataFrame) -> DataFrame:
    return (
        attributed.join(campaigns.select("campaign_id", "campaign_name", "brand"), "campaign_id", "left")
        .join(channels, "channel_id", "left")
        .selectExpr(*FACT_COLUMNS[:-1], "1 AS attribution_flag")
    )


def attributed_by_spot(fact: DataFrame) -> DataFrame:
    """Distinct sessions per spot: deduplicated on (spot, session) first, so a spot with a
    large share of the sessions is counted by many tasks."""
    return fact.groupBy("spot_id").agg(F.count_distinct("session_id").alias("attributed_sessions"))


def campaign_effectiveness(
    pre_post: DataFrame, fact: DataFrame, campaigns: DataFrame, channels: DataFrame
) -> DataFrame:
    lift = lift_pct("pre_spot_sessions", "post_spot_sessions")
    computed = {
        "incremental_lift_pct": lift,
        "attributed_sessions": "coalesce(attributed_sessions, 0)",
    }
    return (
        pre_post.join(attributed_by_spot(fact), "spot_id", "left")
        .join(campaigns.select("campaign_id", "campaign_name", "brand", "budget"), "campaign_id", "left")
        .join(channels.select("channel_id", "channel_name", "channel_type"), "channel_id", "left")
        .selectExpr(*[f"{computed[c]} AS {c}" if c in computed else c for c in EFFECTIVENESS_COLUMNS])
    )


def odec_ready_dataset(fact: DataFrame) -> DataFrame:
    return fact.select(*ODEC_COLUMNS)
