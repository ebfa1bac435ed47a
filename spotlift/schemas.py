"""Declared schemas; nothing is inferred.

Dates and times of the raw files stay strings and are cast in staging: inference would
turn ``20:30:00`` into a timestamp on the current day.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType


def _struct(**fields) -> StructType:
    return StructType([StructField(name, dtype(), True) for name, dtype in fields.items()])


# Names and types of the raw columns.
RAW_SPOTS = _struct(
    spot_id=StringType,
    campaign_id=StringType,
    channel_id=StringType,
    spot_date=StringType,
    spot_time=StringType,
    grp_value=DoubleType,
    spot_duration_sec=IntegerType,
)
RAW_SESSIONS = _struct(
    session_id=StringType,
    user_id=StringType,
    session_timestamp=StringType,
    device_type=StringType,
    session_source=StringType,
)
RAW_CAMPAIGNS = _struct(
    campaign_id=StringType,
    campaign_name=StringType,
    brand=StringType,
    start_date=StringType,
    end_date=StringType,
    budget=DoubleType,
)
RAW_CHANNELS = _struct(
    channel_id=StringType,
    odec_channel_code=StringType,
    channel_name=StringType,
    channel_type=StringType,
)


@dataclass(frozen=True)
class RawSource:
    """One raw file: where it lies under the source root, its table, schema and key."""

    table: str
    path: str
    schema: StructType
    key: str


RAW_SOURCES = (
    RawSource("raw.grp_spots", "grp_spots/grp_spots.csv", RAW_SPOTS, "spot_id"),
    RawSource("raw.sessions", "sessions/sessions.csv", RAW_SESSIONS, "session_id"),
    RawSource("raw.campaign_master", "campaign_master/campaign_master.csv", RAW_CAMPAIGNS, "campaign_id"),
    RawSource("raw.odec_mapping", "odec/odec_mapping.csv", RAW_CHANNELS, "channel_id"),
)
