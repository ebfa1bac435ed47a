"""Raw tables to typed, cleaned staging frames.

Each staging frame is one projection over one raw table, written as SQL expressions so that
the same text serves a DataFrame and a persistent view. Casts follow ANSI rules: a value
that does not parse fails the run instead of turning into null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from spotlift.functions.response import clean_label

# ``concat`` yields null when a part is null; ``concat_ws`` would skip the part.
SPOT_COLUMNS = (
    "spot_id",
    "campaign_id",
    "channel_id",
    "cast(concat(spot_date, ' ', spot_time) AS timestamp_ntz) AS spot_ts",
    "cast(spot_date AS date) AS spot_date",
    "cast(grp_value AS double) AS grp_value",
    "cast(spot_duration_sec AS int) AS spot_duration_sec",
)
SESSION_COLUMNS = (
    "session_id",
    "user_id",
    "cast(session_timestamp AS timestamp_ntz) AS session_ts",
    f"{clean_label('device_type')} AS device_type",
    f"{clean_label('session_source')} AS session_source",
)
CAMPAIGN_COLUMNS = (
    "campaign_id",
    "campaign_name",
    "brand",
    "cast(start_date AS date) AS start_date",
    "cast(end_date AS date) AS end_date",
    "cast(budget AS double) AS budget",
)
CHANNEL_COLUMNS = ("channel_id", "odec_channel_code", "channel_name", "channel_type")

#: Staging view, the raw table it reads and its columns.
STAGING_VIEWS = {
    "staging.stg_grp_spots": ("raw.grp_spots", SPOT_COLUMNS),
    "staging.stg_sessions": ("raw.sessions", SESSION_COLUMNS),
    "staging.stg_campaign_master": ("raw.campaign_master", CAMPAIGN_COLUMNS),
    "staging.stg_odec_mapping": ("raw.odec_mapping", CHANNEL_COLUMNS),
}


def stage_spots(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(*SPOT_COLUMNS)


def stage_sessions(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(*SESSION_COLUMNS)


def stage_campaigns(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(*CAMPAIGN_COLUMNS)


def stage_channels(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(*CHANNEL_COLUMNS)
