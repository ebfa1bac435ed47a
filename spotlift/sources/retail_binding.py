"""The retail test tables seen as spots, sessions, campaigns and channels.

The ``raw_*`` readers give the raw layout (dates and times as text, untidy labels), so the
staging casts are exercised exactly as on CSV input.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotlift.operators import staging
from spotlift.plans import marts

#: Raw table and the test table it is read from.
BOUND_FILES = {
    "raw.grp_spots": "events.parquet",
    "raw.sessions": "events.parquet",
    "raw.campaign_master": "part.parquet",
    "raw.odec_mapping": "nation.parquet",
}

#: Declared layouts of the test tables in use; reading them starts no schema job.
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}

#: What is wrong in the damaged frames: nulls, repeated keys and values out of range, on a fixed share of the rows.
_DAMAGE = {
    "raw.grp_spots": {
        "spot_id": "CASE WHEN spot_id % 13 = 0 THEN NULL WHEN spot_id % 11 = 0 THEN 1 ELSE spot_id END",
        "campaign_id": "if(spot_id % 17 = 1, NULL, campaign_id)",
    },
    "raw.sessions": {
        "session_id": "CASE WHEN session_id % 97 = 0 THEN NULL WHEN session_id % 89 = 0 THEN session_id % 5 ELSE session_id END",
        "session_timestamp": "if(session_id % 83 = 1, NULL, session_timestamp)",
    },
    "raw.campaign_master": {"campaign_id": "CASE WHEN campaign_id % 7 = 0 THEN NULL WHEN campaign_id % 5 = 0 THEN 1 ELSE campaign_id END"},
    "raw.odec_mapping": {"channel_id": "CASE WHEN channel_id % 7 = 0 THEN NULL WHEN channel_id % 5 = 0 THEN 1 ELSE channel_id END"},
    "fact": {
        "session_id": "if(session_id % 11 = 0, session_id % 3, session_id)",
        "minutes_after_spot": "CASE WHEN session_id % 13 = 0 THEN minutes_after_spot + 20 WHEN session_id % 7 = 0 THEN -1 ELSE minutes_after_spot END",
    },
    "mart": {
        "pre_spot_sessions": "if(spot_id % 17 = 0, -1, pre_spot_sessions)",
        "post_spot_sessions": "if(spot_id % 19 = 0, -2, post_spot_sessions)",
        "incremental_lift_pct": "if(spot_id % 23 = 0, NULL, incremental_lift_pct)",
    },
    "attributed": {
        "session_ts": "CASE WHEN session_id % 7 = 0 THEN spot_ts + INTERVAL '9' DAY "
        "WHEN session_id % 5 = 0 THEN spot_ts - INTERVAL '1' HOUR ELSE session_ts END"
    },
}


class RetailTables:
    """Raw, staged and derived frames over one folder of test tables.

    Touching ``nearest`` or a frame behind it runs the job that sizes the index of spots; the rest is lazy.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def raw_spots(self) -> DataFrame:
        return self.table("events").where("event_type = 'purchase'").selectExpr(
            "event_id AS spot_id",
            "user_id AS campaign_id",
            "event_id % 27 AS channel_id",
            "substring(cast(ts AS string), 1, 10) AS spot_date",
            "substring(cast(ts AS string), 12, 15) AS spot_time",
            "value AS grp_value",
            "cast(get_json_object(props, '$.k') AS int) AS spot_duration_sec",
        )

    @cached_property
    def raw_sessions(self) -> DataFrame:
        return self.table("events").where("event_type IN ('view', 'click')").selectExpr(
            "event_id AS session_id",
            "user_id",
            "cast(ts AS string) AS session_timestamp",
            "element_at(array('  Mobile ', 'DESKTOP', ' Tablet'), 1 + cast(event_id % 3 AS int)) AS device_type",
            "concat(' ', upper(event_type), ' ') AS session_source",
        )

    @cached_property
    def raw_campaigns(self) -> DataFrame:
        start = "date_add(date'2024-01-01', cast(p_partkey % 30 AS int))"
        return self.table("part").selectExpr(
            "p_partkey AS campaign_id",
            "p_name AS campaign_name",
            "p_brand AS brand",
            f"cast({start} AS string) AS start_date",
            f"cast(date_add({start}, 10) AS string) AS end_date",
            "p_retailprice AS budget",
        )

    @cached_property
    def raw_channels(self) -> DataFrame:
        regions = self.table("region").withColumnRenamed("r_regionkey", "n_regionkey")
        return self.table("nation").join(regions, "n_regionkey").selectExpr(
            "cast(n_nationkey AS bigint) AS channel_id",
            "concat('ODEC_', n_name) AS odec_channel_code",
            "n_name AS channel_name",
            "r_name AS channel_type",
        )

    @property
    def raw_tables(self) -> dict[str, DataFrame]:
        return {
            "raw.grp_spots": self.raw_spots,
            "raw.sessions": self.raw_sessions,
            "raw.campaign_master": self.raw_campaigns,
            "raw.odec_mapping": self.raw_channels,
        }

    def damaged(self, name: str) -> DataFrame:
        """A raw table, the ``fact``, the ``mart`` or the ``attributed`` sessions with faults that checks have to find."""
        whole = {"fact": "fact", "mart": "effectiveness", "attributed": "attributed"}
        df = getattr(self, whole[name]) if name in whole else self.raw_tables[name]
        return df.withColumns({c: F.expr(e) for c, e in _DAMAGE[name].items()})

    @cached_property
    def spots(self) -> DataFrame:
        return staging.stage_spots(self.raw_spots)

    @cached_property
    def sessions(self) -> DataFrame:
        return staging.stage_sessions(self.raw_sessions)

    @cached_property
    def campaigns(self) -> DataFrame:
        return staging.stage_campaigns(self.raw_campaigns)

    @cached_property
    def channels(self) -> DataFrame:
        return staging.stage_channels(self.raw_channels)

    @cached_property
    def candidates(self) -> DataFrame:
        return marts.session_spot_candidates(self.sessions, self.spots)

    @cached_property
    def nearest(self) -> DataFrame:
        return marts.nearest_spots(self.sessions, self.spots)

    @cached_property
    def attributed(self) -> DataFrame:
        return marts.attributed_sessions(self.nearest)

    @cached_property
    def pre_post(self) -> DataFrame:
        return marts.pre_post_spot_sessions(self.sessions, self.spots)

    @cached_property
    def fact(self) -> DataFrame:
        return marts.fact_campaign_sessions(self.attributed, self.campaigns, self.channels)

    @cached_property
    def effectiveness(self) -> DataFrame:
        return marts.campaign_effectiveness(self.pre_post, self.fact, self.campaigns, self.channels)
