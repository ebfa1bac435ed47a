
from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotlift.functions.response import lift_pct
from spotlift.operators.checks import duplicate_groups, union_all
from spotlift.operators.scaling import Scaler, scaling_stats
from spotlift.plans import marts, measures, qa_report, quality_gate, scoring
from spotlift.plans.ingest import audit_rows
from spotlift.schemas import RAW_SOURCES
from spotlift.sources.catalog import row_counts
from spotlift.sources.retail_binding import BOUND_FILES, RetailTables

try:
    import spotlift.llm.queries as llm
except ModuleNotFoundError as missing:  # the subpackage can be taken away
    if not str(missing.name).startswith(("spotlift.llm", "corpus_pipeline")):
        raise
    llm = None

SF_SMOKE = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Campaign effectiveness per spot on the smallest test tables."""
    return RetailTables(spark, SF_SMOKE).effectiveness


# --- queries ---------------------------------------------------------------------------


def _query(build: Callable[[RetailTables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: build(RetailTables(spark, folder))


def _ingest_audit(t: RetailTables) -> DataFrame:
    return audit_rows(t.raw_tables, BOUND_FILES)


def _dq_results(t: RetailTables) -> DataFrame:
    return quality_gate.worst_first(_dq_frame(t))


def _dq_frame(t: RetailTables) -> DataFrame:
    tables = {
        "raw.grp_spots": t.raw_spots,
        "raw.sessions": t.raw_sessions,
        quality_gate.FACT: t.fact,
        quality_gate.EFFECTIVENESS: t.effectiveness,
    }
    return quality_gate.dq_results(tables)


def _damaged_dq_frame(t: RetailTables) -> DataFrame:
    tables = {name: t.damaged(name) for name in ("raw.grp_spots", "raw.sessions")}
    return quality_gate.dq_results({**tables, quality_gate.FACT: t.damaged("fact"), quality_gate.EFFECTIVENESS: t.damaged("mart")})


def _damaged_pk_checks(t: RetailTables) -> DataFrame:
    return qa_report.key_checks([(s.table, t.damaged(s.table), s.key) for s in RAW_SOURCES])


def _raw_minimum_rows(t: RetailTables) -> DataFrame:
    minimum = {"raw.grp_spots": 1, "raw.sessions": 1, "raw.campaign_master": 10**12, "raw.odec_mapping": 25}
    return union_all([qa_report.minimum_row_check(df, name, minimum[name]) for name, df in t.raw_tables.items()])


def _duplicate_keys(t: RetailTables) -> DataFrame:
    keys = [
        ("raw.grp_spots", t.raw_spots, "spot_id"),
        ("raw.grp_spots", t.raw_spots, "campaign_id"),
        ("raw.sessions", t.raw_sessions, "user_id"),
        ("raw.campaign_master", t.raw_campaigns, "brand"),
        ("raw.odec_mapping", t.raw_channels, "channel_type"),
    ]
    return union_all(
        [
            duplicate_groups(df, key).select(
                F.lit(table).alias("table_name"), F.lit(key).alias("key_column"), "duplicate_groups"
            )
            for table, df, key in keys
        ]
    )


def _pk_checks(t: RetailTables) -> DataFrame:
    keys = [
        ("raw.campaign_master", t.raw_campaigns, "campaign_id"),
        ("raw.grp_spots", t.raw_spots, "spot_id"),
        ("raw.sessions", t.raw_sessions, "session_id"),
        ("raw.odec_mapping", t.raw_channels, "channel_id"),
    ]
    return qa_report.key_checks(keys)


def _rates(t: RetailTables) -> DataFrame:
    """Shares that can leave 0..1: sessions before a spot relative to those after it."""
    after = F.when(F.col("post_spot_sessions") > 0, F.col("post_spot_sessions"))
    return t.effectiveness.select(
        (F.col("attributed_sessions") / after).alias("exposed_conversion_rate"),
        (F.col("pre_spot_sessions") / after).alias("control_conversion_rate"),
    )


def _flagged(t: RetailTables) -> DataFrame:
    """Segments under a fixed abnormal flag, so that SQL can check the rules."""
    features = scoring.ml_features(t.effectiveness)
    return scoring.with_segment(features.withColumn("is_abnormal_response", F.when(F.col("spot_id") % 4 == 0, 1).otherwise(0)))


def _scores(t: RetailTables) -> DataFrame:
    return scoring.score_responses(t.effectiveness)[1]


def _scaled(t: RetailTables) -> DataFrame:
    features = scoring.ml_features(t.effectiveness)
    scaled = Scaler.fit(features, scoring.FEATURES).transform(features)
    return scaled.select("spot_id", *[F.round(c, 6).alias(c) for c in scoring.FEATURES])


def _feature_scaling(t: RetailTables) -> DataFrame:
    stats = scaling_stats(scoring.ml_features(t.effectiveness), scoring.FEATURES)
    return stats.select("feature", F.round("mean", 6).alias("mean"), F.round("std_pop", 6).alias("std_pop"))


def _expanded_candidates(t: RetailTables) -> DataFrame:
    return marts.expanded_candidates(marts.candidate_ranges(t.sessions, t.spots), t.sessions)


def _incremental_lift(t: RetailTables) -> DataFrame:
    lift = f"{lift_pct('pre_spot_sessions', 'post_spot_sessions')} AS incremental_lift_pct"
    return t.pre_post.selectExpr("spot_id", "pre_spot_sessions", "post_spot_sessions", lift)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _reference_queries() | (llm.queries() if llm else {})


def _reference_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        name: _query(build)
        for name, build in {
            # staging and ingestion
            "stg_spots": lambda t: t.spots,
            "stg_sessions": lambda t: t.sessions,
            "stg_campaigns": lambda t: t.campaigns,
            "stg_channels": lambda t: t.channels,
            "ingest_audit": _ingest_audit,
            "table_row_counts": lambda t: row_counts(t.raw_tables),
            # attribution and marts
            "session_spot_candidates": lambda t: t.candidates,
            "session_spot_ranges": lambda t: marts.candidate_ranges(t.sessions, t.spots).ranges,
            "session_spot_candidates_expanded": _expanded_candidates,
            "attributed_sessions": lambda t: t.attributed,
            "attributed_sessions_asof": lambda t: t.nearest,
            "pre_post_spot_sessions": lambda t: t.pre_post,
            "incremental_lift": _incremental_lift,
            "fact_sessions": lambda t: t.fact,
            "attributed_by_spot": lambda t: marts.attributed_by_spot(t.fact),
            "campaign_effectiveness": lambda t: t.effectiveness,
            "odec_dataset": lambda t: marts.odec_ready_dataset(t.fact),
            # data quality and QA
            "dq_results": _dq_results,
            "dq_total_failures": lambda t: quality_gate.total_failures(_dq_frame(t)),
            "duplicate_keys": _duplicate_keys,
            "pk_checks": _pk_checks,
            "qa_numeric_columns": lambda t: qa_report.numeric_columns(
                t.table("events"), ["user_id", "value", "event_type", "props"]
            ),
            "qa_attribution_window": lambda t: qa_report.attribution_failures(t.attributed, "spot_ts", "session_ts"),
            "qa_rate_bounds": lambda t: qa_report.rate_failures(
                _rates(t), ["exposed_conversion_rate", "control_conversion_rate"]
            ),
            "qa_lift_not_null": lambda t: qa_report.null_lift(t.effectiveness, "incremental_lift_pct"),
            "qa_score_bounds": lambda t: qa_report.score_failures(_rates(t), "control_conversion_rate", 0, 1),
            # the same checks over damaged tables, where each has failures to find
            "damaged_dq_results": lambda t: quality_gate.worst_first(_damaged_dq_frame(t)),
            "damaged_dq_total_failures": lambda t: quality_gate.total_failures(_damaged_dq_frame(t)),
            "damaged_pk_checks": _damaged_pk_checks,
            "damaged_attribution_window": lambda t: qa_report.attribution_failures(t.damaged("attributed"), "spot_ts", "session_ts"),
            "damaged_lift_not_null": lambda t: qa_report.null_lift(t.damaged("mart"), "incremental_lift_pct"),
            "raw_minimum_rows": _raw_minimum_rows,
            # business measures and chart frames
            "kpi_summary": lambda t: measures.kpi_summary(t.effectiveness),
            "budget_by_campaign": lambda t: measures.budget_by_campaign(t.effectiveness),
            "campaign_ranking": lambda t: measures.campaign_ranking(t.effectiveness),
            "grp_by_channel": lambda t: measures.grp_by_channel(t.spots, t.channels),
            "sessions_after_spots": lambda t: measures.sessions_after_spots(t.effectiveness),
            "attributed_by_channel": lambda t: measures.attributed_by_channel(t.fact),
            "performance_by_channel_type": lambda t: measures.performance_by_channel_type(t.effectiveness),
            "device_source_patterns": lambda t: measures.device_source_patterns(t.attributed),
            "chart_pre_post": lambda t: measures.chart_pre_post(t.effectiveness),
            # response scoring
            "ml_features": lambda t: scoring.ml_features(t.effectiveness),
            "feature_scaling": _feature_scaling,
            "scaled_features": _scaled,
            "response_segments": _flagged,
            "segment_counts": lambda t: measures.segment_counts(_flagged(t)),
            "anomaly_scores": _scores,
            "score_distribution": lambda t: measures.score_distribution(_scores(t)),
            "response_ranking": lambda t: measures.response_ranking(_scores(t)),
            "average_response_score": lambda t: measures.average_response_score(_scores(t)),
            "chart_anomaly": lambda t: measures.chart_anomaly(_scores(t)),
        }.items()
    }


# --- SQL counterparts ------------------------------------------------------------------
# Written against the test tables directly: the interval conditions stand as plain range
# joins, independent of how the jobs compute them.

_SPOTS = """
spots AS (
    SELECT event_id AS spot_id, user_id AS campaign_id, event_id % 27 AS channel_id, ts AS spot_ts,
           CAST(ts AS DATE) AS spot_date, value AS grp_value,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS spot_duration_sec
    FROM events WHERE event_type = 'purchase')"""
_SESSIONS = """
visits AS (
    SELECT event_id AS session_id, user_id, ts AS session_ts,
           ['mobile', 'desktop', 'tablet'][1 + event_id % 3] AS device_type, event_type AS session_source
    FROM events WHERE event_type IN ('view', 'click'))"""
_CAMPAIGNS = """
campaigns AS (
    SELECT p_partkey AS campaign_id, p_name AS campaign_name, p_brand AS brand,
           CAST(DATE '2024-01-01' + CAST(p_partkey % 30 AS INTEGER) AS DATE) AS start_date,
           CAST(DATE '2024-01-11' + CAST(p_partkey % 30 AS INTEGER) AS DATE) AS end_date, p_retailprice AS budget
    FROM part)"""
_CHANNELS = """
channels AS (
    SELECT CAST(n_nationkey AS BIGINT) AS channel_id, 'ODEC_' || n_name AS odec_channel_code,
           n_name AS channel_name, r_name AS channel_type
    FROM nation JOIN region ON r_regionkey = n_regionkey)"""
_PAIRS = """
pairs AS (
    SELECT v.*, spot_id, campaign_id, channel_id, spot_ts, spot_date, grp_value,
           date_diff('minute', spot_ts, session_ts) AS minutes_after_spot
    FROM visits v JOIN spots ON session_ts >= spot_ts AND session_ts <= spot_ts + INTERVAL 15 MINUTE)"""
# Buckets of 15 minutes count from the year 1; 69,039,552 of them lie before 1970.
_RANGES = """
times AS (SELECT DISTINCT session_ts, CAST(floor(epoch(session_ts) / 900) AS BIGINT) + 69039552 AS b FROM visits WHERE session_ts IS NOT NULL),
placed AS (SELECT spot_ts, CAST(floor(epoch(spot_ts) / 900) AS BIGINT) + 69039552 AS bucket FROM spots WHERE spot_ts IS NOT NULL),
ranges AS (
    SELECT session_ts, bucket, count(*) FILTER (spot_ts < session_ts - INTERVAL 15 MINUTE) AS first, count(*) AS until
    FROM times JOIN placed ON bucket = b - 1 GROUP BY ALL
    UNION ALL
    SELECT session_ts, bucket, 0 AS first, count(*) FILTER (spot_ts <= session_ts) AS until
    FROM times JOIN placed ON bucket = b GROUP BY ALL)"""
_BEST = """
best AS (
    SELECT *, CAST(row_number() OVER pick AS BIGINT) AS attribution_rank FROM pairs
    WINDOW pick AS (PARTITION BY session_id ORDER BY minutes_after_spot, spot_ts DESC, spot_id)
    QUALIFY attribution_rank = 1)"""
_FACT = """
fact AS (
    SELECT session_id, user_id, session_ts, spot_id, b.campaign_id, campaign_name, brand, b.channel_id,
           odec_channel_code, channel_name, channel_type, spot_ts, minutes_after_spot, grp_value,
           CAST(1 AS INTEGER) AS attribution_flag
    FROM best b LEFT JOIN campaigns c ON c.campaign_id = b.campaign_id
                LEFT JOIN channels h ON h.channel_id = b.channel_id)"""
_AROUND = """
around AS (
    SELECT spot_id, campaign_id, channel_id, spot_ts,
           CAST(count(session_id) FILTER (session_ts <= spot_ts) AS BIGINT) AS pre_spot_sessions,
           CAST(count(session_id) FILTER (session_ts >= spot_ts) AS BIGINT) AS post_spot_sessions
    FROM spots LEFT JOIN visits
         ON session_ts >= spot_ts - INTERVAL 15 MINUTE AND session_ts <= spot_ts + INTERVAL 15 MINUTE
    GROUP BY ALL),
lifted AS (
    SELECT *, CASE WHEN pre_spot_sessions > 0
                   THEN round((post_spot_sessions - pre_spot_sessions) * 100.0::DOUBLE / pre_spot_sessions, 2)
                   WHEN post_spot_sessions > 0 THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END AS incremental_lift_pct
    FROM around)"""
_MART = """
mart AS (
    SELECT l.spot_id, l.campaign_id, campaign_name, brand, l.channel_id, channel_name, channel_type, spot_ts,
           pre_spot_sessions, post_spot_sessions, incremental_lift_pct,
           CAST(ifnull(a.sessions, 0) AS BIGINT) AS attributed_sessions, budget
    FROM lifted l
    LEFT JOIN (SELECT spot_id, count(DISTINCT session_id) AS sessions FROM fact GROUP BY spot_id) a
         ON a.spot_id = l.spot_id
    LEFT JOIN campaigns c ON c.campaign_id = l.campaign_id
    LEFT JOIN channels h ON h.channel_id = l.channel_id)"""
_FEATURES = """
features AS (
    SELECT spot_id, campaign_id, channel_id, spot_ts, pre_spot_sessions, post_spot_sessions,
           incremental_lift_pct, attributed_sessions, ifnull(budget, 0) AS budget
    FROM mart)"""
_FLAGGED = """
flagged AS (
    SELECT *, CAST(spot_id % 4 = 0 AS INTEGER) AS is_abnormal_response,
           CASE WHEN incremental_lift_pct > 0 AND spot_id % 4 = 0 THEN 'Abnormal Positive Spike'
                WHEN incremental_lift_pct < 0 AND spot_id % 4 = 0 THEN 'Abnormal Negative Drop'
                WHEN incremental_lift_pct = 0 THEN 'Insufficient Baseline'
                WHEN incremental_lift_pct < 0 THEN 'Weak Response'
                WHEN incremental_lift_pct < 50 THEN 'Normal Positive Lift'
                ELSE 'High Positive Lift' END AS response_segment
    FROM features)"""
# The forest: draws and splits from the same MD5 digests as the job, levels unrolled, rows walked through the trees in SQL.
_COLUMNS = list(scoring.FEATURES)
_DEPTH = 8


def _digits(text: str, count: int = 13) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, {count}) AS BIGINT)"


def _mean_path(n: str) -> str:
    return (
        f"CASE WHEN {n} <= 1 THEN 0.0::DOUBLE WHEN {n} = 2 THEN 1.0::DOUBLE "
        f"ELSE 2 * (ln({n} - 1) + 0.5772156649015329::DOUBLE) - 2 * ({n} - 1)::DOUBLE / {n} END"
    )


def _level(d: int) -> str:
    """``level<d>``, the sampled rows that reach a depth, and ``split<d>``, what becomes of their nodes."""
    rows = "SELECT t, 1 AS place, x FROM drawn"
    if d:
        goes = f"2 * s.place + CAST(l.x[s.feature] > s.threshold AS INTEGER)"
        rows = f"SELECT l.t, {goes} AS place, l.x FROM level{d - 1} l JOIN split{d - 1} s ON s.t = l.t AND s.place = l.place WHERE s.feature > 0"
    lows, highs = (", ".join(f"{f}(x[{i + 1}])" for i in range(len(_COLUMNS))) for f in ("min", "max"))
    name = f"'{scoring.SEED}:' || t || ':' || place"
    differing = f"list_filter(range(1, {len(_COLUMNS) + 1}), lambda i: highs[i] > lows[i])"
    open_node = f"len(differing) > 0 AND {d} < (SELECT ceil(log2(greatest(least({scoring.SAMPLE}, count(*)), 2))) FROM named)"
    return f"""
level{d} AS MATERIALIZED ({rows}),
split{d} AS MATERIALIZED (
    SELECT t, place, n, feature, {d} AS depth,
           CASE WHEN lows[feature] + (highs[feature] - lows[feature]) * u >= highs[feature] THEN lows[feature]
                ELSE lows[feature] + (highs[feature] - lows[feature]) * u END AS threshold
    FROM (SELECT *, {_digits(f"{name} || ':threshold'")} / 4503599627370496.0::DOUBLE AS u,
                 CASE WHEN {open_node} THEN differing[1 + {_digits(f"{name} || ':feature'")} % len(differing)] ELSE 0 END AS feature
          FROM (SELECT *, {differing} AS differing
                FROM (SELECT t, place, count(*) AS n, [{lows}] AS lows, [{highs}] AS highs FROM level{d} GROUP BY t, place))))"""


def _walk(d: int) -> str:
    return (
        f"walk{d + 1} AS MATERIALIZED (SELECT w.name, w.t, w.x, CASE WHEN s.feature > 0 "
        f"THEN 2 * w.place + CAST(w.x[s.feature] > s.threshold AS INTEGER) ELSE w.place END AS place "
        f"FROM walk{d} w JOIN nodes s ON s.t = w.t AND s.place = w.place)"
    )


_SCORED = [
    f"""
named AS MATERIALIZED (
    SELECT *, [{", ".join(f"{c}::DOUBLE" for c in _COLUMNS)}] AS x,
           md5(concat_ws('|', {", ".join(scoring.KEY)}, {", ".join(f"{c}::DOUBLE::DECIMAL(38, 6)" for c in _COLUMNS)},
                         row_number() OVER (PARTITION BY {", ".join([*scoring.KEY, *_COLUMNS])}) - 1)) AS name
    FROM features)""",
    f"""
trees AS (
    SELECT t, 1 + {_digits(f"'{scoring.SEED}:' || t || ':slope'", 7)} AS slope, {_digits(f"'{scoring.SEED}:' || t || ':shift'", 7)} AS shift
    FROM range({scoring.TREES}) r(t))""",
    f"""
drawn AS MATERIALIZED (
    SELECT t, x FROM named, trees
    QUALIFY row_number() OVER (
        PARTITION BY t
        ORDER BY (CAST('0x' || substr(name, 1, 13) AS BIGINT) % 2147483647 * slope + shift) % 2147483647, name) <= {scoring.SAMPLE})""",
    *[_level(d) for d in range(_DEPTH + 1)],
    "nodes AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT * FROM split{d}" for d in range(_DEPTH + 1)) + ")",
    "walk0 AS (SELECT name, t, x, 1 AS place FROM named, trees)",
    *[_walk(d) for d in range(_DEPTH)],
    f"""
raw AS MATERIALIZED (
    SELECT name, round(-pow(2, -avg(depth + {_mean_path("n")}) /
           (SELECT {_mean_path(f"least({scoring.SAMPLE}, count(*))")} FROM named)), 12) AS raw_score
    FROM walk{_DEPTH} w JOIN nodes s ON s.t = w.t AND s.place = w.place GROUP BY name)""",
    f"""
rated AS (
    SELECT {", ".join(scoring.KEY)}, {", ".join(_COLUMNS)},
           round(raw_score - (SELECT quantile_cont(raw_score, {scoring.CONTAMINATION}) FROM raw), 10) + 0.0::DOUBLE AS anomaly_score
    FROM named n JOIN raw r ON r.name = n.name)""",
    """
scored AS (
    SELECT *, CAST(anomaly_score < 0 AS INTEGER) AS is_abnormal_response,
           CASE WHEN incremental_lift_pct > 0 AND anomaly_score < 0 THEN 'Abnormal Positive Spike'
                WHEN incremental_lift_pct < 0 AND anomaly_score < 0 THEN 'Abnormal Negative Drop'
                WHEN incremental_lift_pct = 0 THEN 'Insufficient Baseline'
                WHEN incremental_lift_pct < 0 THEN 'Weak Response'
                WHEN incremental_lift_pct < 50 THEN 'Normal Positive Lift'
                ELSE 'High Positive Lift' END AS response_segment
    FROM rated)""",
]
_RATES = """
rates AS (
    SELECT attributed_sessions / nullif(post_spot_sessions, 0) AS exposed,
           pre_spot_sessions / nullif(post_spot_sessions, 0) AS control
    FROM mart)"""

_RAW = [_SPOTS, _SESSIONS, _CAMPAIGNS, _CHANNELS]
_TO_BEST = [_SPOTS, _SESSIONS, _PAIRS, _BEST]
_TO_FACT = [*_RAW, _PAIRS, _BEST, _FACT]
_TO_MART = [*_TO_FACT, _AROUND, _MART]
_TO_FLAGGED = [*_TO_MART, _FEATURES, _FLAGGED]
_TO_SCORED = [*_TO_MART, _FEATURES, *_SCORED]


def _sql(parts: list[str], select: str) -> str:
    return f"WITH {','.join(parts)}\n{select}"


def _check(table: str, name: str, count: str) -> str:
    return f"SELECT '{table}' AS table_name, '{name}' AS check_name, ({count}) AS failed_rows"


def _dq(prefix: str = "") -> str:
    checks = [
        _check("raw.grp_spots", "spot_id_not_null", f"SELECT count(*) - count(spot_id) FROM {prefix}spots"),
        _check("raw.grp_spots", "campaign_id_not_null", f"SELECT count(*) - count(campaign_id) FROM {prefix}spots"),
        _check("raw.sessions", "session_id_not_null", f"SELECT count(*) - count(session_id) FROM {prefix}visits"),
        _check("raw.sessions", "session_timestamp_not_null", f"SELECT count(*) - count(session_ts) FROM {prefix}visits"),
        _check(
            "marts.fact_campaign_sessions",
            "no_duplicate_attributed_sessions",
            f"SELECT count(*) FROM (SELECT session_id FROM {prefix}fact GROUP BY ALL HAVING count(*) > 1)",
        ),
        _check(
            "marts.fact_campaign_sessions",
            "valid_attribution_window",
            f"SELECT count(*) FROM {prefix}fact WHERE minutes_after_spot NOT BETWEEN 0 AND 15",
        ),
        _check(
            "marts.mart_campaign_effectiveness",
            "non_negative_session_counts",
            f"SELECT count(*) FROM {prefix}mart WHERE least(pre_spot_sessions, post_spot_sessions) < 0",
        ),
    ]
    return " UNION ALL ".join(checks)


_DQ = _dq()
_BAD_DIMENSIONS = [
    """
bad_campaigns AS (
    SELECT * REPLACE (CASE WHEN campaign_id % 7 = 0 THEN NULL WHEN campaign_id % 5 = 0 THEN 1 ELSE campaign_id END AS campaign_id)
    FROM campaigns)""",
    """
bad_channels AS (
    SELECT * REPLACE (CASE WHEN channel_id % 7 = 0 THEN NULL WHEN channel_id % 5 = 0 THEN 1 ELSE channel_id END AS channel_id)
    FROM channels)""",
]
_BAD_EVENTS = [
    """
bad_spots AS (
    SELECT * REPLACE (CASE WHEN spot_id % 13 = 0 THEN NULL WHEN spot_id % 11 = 0 THEN 1 ELSE spot_id END AS spot_id,
                      CASE WHEN spot_id % 17 <> 1 THEN campaign_id END AS campaign_id)
    FROM spots)""",
    """
bad_visits AS (
    SELECT * REPLACE (CASE WHEN session_id % 97 = 0 THEN NULL WHEN session_id % 89 = 0 THEN session_id % 5
                           ELSE session_id END AS session_id,
                      CASE WHEN session_id % 83 <> 1 THEN session_ts END AS session_ts)
    FROM visits)""",
]
_BAD_MARTS = [
    """
bad_fact AS (
    SELECT * REPLACE (CASE WHEN session_id % 11 = 0 THEN session_id % 3 ELSE session_id END AS session_id,
                      CASE WHEN session_id % 13 = 0 THEN minutes_after_spot + 20 WHEN session_id % 7 = 0 THEN -1
                           ELSE minutes_after_spot END AS minutes_after_spot)
    FROM fact)""",
    """
bad_mart AS (
    SELECT * REPLACE (CASE WHEN spot_id % 17 = 0 THEN -1 ELSE pre_spot_sessions END AS pre_spot_sessions,
                      CASE WHEN spot_id % 19 = 0 THEN -2 ELSE post_spot_sessions END AS post_spot_sessions,
                      CASE WHEN spot_id % 23 <> 0 THEN incremental_lift_pct END AS incremental_lift_pct)
    FROM mart)""",
]
_BAD_BEST = """
bad_best AS (
    SELECT * REPLACE (CASE WHEN session_id % 7 = 0 THEN spot_ts + INTERVAL 9 DAY
                           WHEN session_id % 5 = 0 THEN spot_ts - INTERVAL 1 HOUR ELSE session_ts END AS session_ts)
    FROM best)"""


def _counted(select: str) -> str:
    return " UNION ALL ".join(
        select.format(table=t, path=p, frame=f)
        for (t, p), f in zip(BOUND_FILES.items(), ["spots", "visits", "campaigns", "channels"], strict=True)
    )


def _duplicates(table: str, frame: str, key: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{key}' AS key_column, count(*) AS duplicate_groups "
        f"FROM (SELECT {key} FROM {frame} GROUP BY {key} HAVING count(*) > 1)"
    )


def _pk(table: str, frame: str, key: str) -> str:
    nulls = f"(SELECT count(*) FROM {frame} WHERE {key} IS NULL)"
    groups = f"(SELECT count(*) FROM (SELECT {key} FROM {frame} GROUP BY {key} HAVING count(*) > 1))"
    return " UNION ALL ".join(
        f"SELECT '{check}: {table}.{key}' AS check_name, if({n} > 0, 'FAILED', 'PASSED') AS status, "
        f"if({n} > 0, '{bad}=' || {n}, '{good}') AS details"
        for check, n, bad, good in [
            ("Null check", nulls, "Null count", "No null primary keys"),
            ("Duplicate check", groups, "Duplicate key groups", "No duplicate primary keys"),
        ]
    )


def _number_check(column: str, cast: str) -> str:
    return (
        f"SELECT '{column}' AS column_name, "
        f"count(*) FILTER ({column} IS NOT NULL AND {cast} IS NULL) AS invalid_values FROM events"
    )


_FEATURE_NAMES = list(scoring.FEATURES)


def oracle_sql() -> dict[str, str]:
    return _reference_sql() | (llm.oracle_sql() if llm else {})


def _reference_sql() -> dict[str, str]:
    return {
        "stg_spots": _sql([_SPOTS], "SELECT * FROM spots"),
        "stg_sessions": _sql([_SESSIONS], "SELECT * FROM visits"),
        "stg_campaigns": _sql([_CAMPAIGNS], "SELECT * FROM campaigns"),
        "stg_channels": _sql([_CHANNELS], "SELECT * FROM channels"),
        "ingest_audit": _sql(
            _RAW,
            _counted(
                "SELECT '{table}' AS table_name, '{path}' AS file_path, count(*) AS row_count, "
                "'SUCCESS' AS status FROM {frame}"
            ),
        ),
        "table_row_counts": _sql(
            _RAW, _counted("SELECT '{table}' AS table_name, count(*) AS row_count FROM {frame}")
        ),
        "session_spot_candidates": _sql([_SPOTS, _SESSIONS, _PAIRS], "SELECT * FROM pairs"),
        "session_spot_candidates_expanded": _sql([_SPOTS, _SESSIONS, _PAIRS], "SELECT * FROM pairs"),
        "session_spot_ranges": _sql([_SPOTS, _SESSIONS, _RANGES], "SELECT * FROM ranges WHERE first < until"),
        "attributed_sessions": _sql(_TO_BEST, "SELECT * FROM best"),
        "attributed_sessions_asof": _sql(_TO_BEST, "SELECT * EXCLUDE (attribution_rank) FROM best"),
        "pre_post_spot_sessions": _sql(
            [_SPOTS, _SESSIONS, _AROUND],
            "SELECT spot_id, campaign_id, channel_id, spot_ts, pre_spot_sessions, post_spot_sessions FROM around",
        ),
        "incremental_lift": _sql(
            [_SPOTS, _SESSIONS, _AROUND],
            "SELECT spot_id, pre_spot_sessions, post_spot_sessions, incremental_lift_pct FROM lifted",
        ),
        "fact_sessions": _sql(_TO_FACT, "SELECT * FROM fact"),
        "attributed_by_spot": _sql(
            _TO_FACT, "SELECT spot_id, count(DISTINCT session_id) AS attributed_sessions FROM fact GROUP BY spot_id"
        ),
        "campaign_effectiveness": _sql(_TO_MART, "SELECT * FROM mart"),
        "odec_dataset": _sql(_TO_FACT, f"SELECT {', '.join(marts.ODEC_COLUMNS)} FROM fact"),
        "dq_results": _sql(_TO_MART, _DQ),
        "dq_total_failures": _sql(_TO_MART, f"SELECT CAST(sum(failed_rows) AS BIGINT) AS total_failures FROM ({_DQ})"),
        "duplicate_keys": _sql(
            _RAW,
            " UNION ALL ".join(
                [
                    _duplicates("raw.grp_spots", "spots", "spot_id"),
                    _duplicates("raw.grp_spots", "spots", "campaign_id"),
                    _duplicates("raw.sessions", "visits", "user_id"),
                    _duplicates("raw.campaign_master", "campaigns", "brand"),
                    _duplicates("raw.odec_mapping", "channels", "channel_type"),
                ]
            ),
        ),
        "pk_checks": _sql(
            _RAW,
            " UNION ALL ".join(
                [
                    _pk("raw.campaign_master", "campaigns", "campaign_id"),
                    _pk("raw.grp_spots", "spots", "spot_id"),
                    _pk("raw.sessions", "visits", "session_id"),
                    _pk("raw.odec_mapping", "channels", "channel_id"),
                ]
            ),
        ),
        "qa_numeric_columns": " UNION ALL ".join(
            [
                _number_check("user_id", "user_id"),
                _number_check("value", "value"),
                _number_check("event_type", "TRY_CAST(event_type AS DOUBLE)"),
                _number_check("props", "TRY_CAST(props AS DOUBLE)"),
            ]
        ),
        "qa_attribution_window": _sql(
            _TO_BEST,
            "SELECT count(*) AS invalid_rows FROM best "
            "WHERE session_ts < spot_ts OR date_diff('day', spot_ts, session_ts) > 7",
        ),
        "qa_rate_bounds": _sql(
            [*_TO_MART, _RATES],
            "SELECT count(*) AS invalid_rows FROM rates WHERE exposed NOT BETWEEN 0 AND 1 OR control NOT BETWEEN 0 AND 1",
        ),
        "qa_lift_not_null": _sql(
            _TO_MART, "SELECT count(*) - count(incremental_lift_pct) AS invalid_rows FROM mart"
        ),
        "qa_score_bounds": _sql(
            [*_TO_MART, _RATES],
            "SELECT count(*) AS invalid_rows FROM rates WHERE control IS NULL OR control NOT BETWEEN 0 AND 1",
        ),
        "damaged_dq_results": _sql([*_TO_MART, *_BAD_EVENTS, *_BAD_MARTS], _dq("bad_")),
        "damaged_dq_total_failures": _sql(
            [*_TO_MART, *_BAD_EVENTS, *_BAD_MARTS],
            f"SELECT CAST(sum(failed_rows) AS BIGINT) AS total_failures FROM ({_dq('bad_')})",
        ),
        "damaged_pk_checks": _sql(
            [*_RAW, *_BAD_DIMENSIONS, *_BAD_EVENTS],
            " UNION ALL ".join(
                [
                    _pk("raw.campaign_master", "bad_campaigns", "campaign_id"),
                    _pk("raw.grp_spots", "bad_spots", "spot_id"),
                    _pk("raw.sessions", "bad_visits", "session_id"),
                    _pk("raw.odec_mapping", "bad_channels", "channel_id"),
                ]
            ),
        ),
        "damaged_attribution_window": _sql(
            [*_TO_BEST, _BAD_BEST],
            "SELECT count(*) AS invalid_rows FROM bad_best "
            "WHERE session_ts < spot_ts OR date_diff('day', spot_ts, session_ts) > 7",
        ),
        "damaged_lift_not_null": _sql(
            [*_TO_MART, *_BAD_MARTS], "SELECT count(*) - count(incremental_lift_pct) AS invalid_rows FROM bad_mart"
        ),
        "raw_minimum_rows": _sql(
            _RAW,
            " UNION ALL ".join(
                f"SELECT 'Raw row count: {t}' AS check_name, if(count(*) < {least}, 'FAILED', 'PASSED') AS status, "
                f"if(count(*) < {least}, 'Expected at least {least}, actual=', 'Actual rows=') || count(*) AS details FROM {f}"
                for t, f, least in [
                    ("raw.grp_spots", "spots", 1),
                    ("raw.sessions", "visits", 1),
                    ("raw.campaign_master", "campaigns", 10**12),
                    ("raw.odec_mapping", "channels", 25),
                ]
            ),
        ),
        "kpi_summary": _sql(
            _TO_MART,
            "SELECT count(DISTINCT campaign_id) AS total_campaigns, "
            "CAST(sum(attributed_sessions) AS BIGINT) AS total_attributed_sessions, "
            "round(avg(incremental_lift_pct), 6) AS avg_incremental_lift_pct FROM mart",
        ),
        "budget_by_campaign": _sql(
            _TO_MART, "SELECT campaign_id, campaign_name, max(budget) AS budget FROM mart GROUP BY ALL"
        ),
        "campaign_ranking": _sql(
            _TO_MART,
            "SELECT *, rank() OVER (ORDER BY avg_lift_pct DESC, attributed_sessions DESC, campaign_id) AS campaign_rank "
            "FROM (SELECT campaign_id, campaign_name, round(avg(incremental_lift_pct), 6) AS avg_lift_pct, "
            "CAST(sum(attributed_sessions) AS BIGINT) AS attributed_sessions FROM mart GROUP BY ALL)",
        ),
        "grp_by_channel": _sql(
            [_SPOTS, _CHANNELS],
            "SELECT s.channel_id, channel_name, round(sum(grp_value), 6) AS total_grp "
            "FROM spots s LEFT JOIN channels c ON c.channel_id = s.channel_id GROUP BY ALL",
        ),
        "sessions_after_spots": _sql(
            _TO_MART, "SELECT CAST(sum(post_spot_sessions) AS BIGINT) AS sessions_after_spots FROM mart"
        ),
        "attributed_by_channel": _sql(
            _TO_FACT, "SELECT channel_id, channel_name, count(*) AS attributed_sessions FROM fact GROUP BY ALL"
        ),
        "performance_by_channel_type": _sql(
            _TO_MART,
            "SELECT channel_type, count(*) AS spots, round(avg(incremental_lift_pct), 6) AS avg_lift_pct, "
            "CAST(sum(post_spot_sessions) AS BIGINT) AS post_spot_sessions, "
            "CAST(sum(attributed_sessions) AS BIGINT) AS attributed_sessions FROM mart GROUP BY channel_type",
        ),
        "device_source_patterns": _sql(
            _TO_BEST, "SELECT device_type, session_source, count(*) AS attributed_sessions FROM best GROUP BY ALL"
        ),
        "chart_pre_post": _sql(
            _TO_MART,
            "SELECT campaign_id, channel_id, spot_id, pre_spot_sessions, post_spot_sessions, incremental_lift_pct, "
            "attributed_sessions FROM mart ORDER BY spot_id",
        ),
        "ml_features": _sql([*_TO_MART, _FEATURES], "SELECT * FROM features"),
        "feature_scaling": _sql(
            [*_TO_MART, _FEATURES],
            " UNION ALL ".join(
                f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std_pop FROM features"
                for c in _FEATURE_NAMES
            ),
        ),
        "scaled_features": _sql(
            [*_TO_MART, _FEATURES],
            "SELECT spot_id, "
            + ", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in _FEATURE_NAMES)
            + " FROM features",
        ),
        "response_segments": _sql(_TO_FLAGGED, "SELECT * FROM flagged"),
        "segment_counts": _sql(
            _TO_FLAGGED, "SELECT response_segment, campaign_id, count(*) AS spots FROM flagged GROUP BY ALL"
        ),
        "anomaly_scores": _sql(_TO_SCORED, f"SELECT {', '.join(scoring.SCORE_COLUMNS)} FROM scored"),
        "score_distribution": _sql(
            _TO_SCORED,
            "SELECT CAST(floor(anomaly_score / 0.05::DOUBLE) AS BIGINT) AS bin, count(*) AS spots, "
            "round(CAST(floor(anomaly_score / 0.05::DOUBLE) AS BIGINT) * 0.05::DOUBLE, 6) AS bin_start FROM scored GROUP BY ALL",
        ),
        "response_ranking": _sql(
            _TO_SCORED,
            "SELECT *, rank() OVER (ORDER BY avg_anomaly_score DESC, campaign_id) AS response_rank FROM "
            "(SELECT campaign_id, round(avg(anomaly_score), 6) AS avg_anomaly_score FROM scored GROUP BY campaign_id)",
        ),
        "average_response_score": _sql(_TO_SCORED, "SELECT round(avg(anomaly_score), 6) AS avg_anomaly_score FROM scored"),
        "chart_anomaly": _sql(
            _TO_SCORED,
            "SELECT spot_id, campaign_id, incremental_lift_pct, anomaly_score, is_abnormal_response, response_segment "
            "FROM scored ORDER BY spot_id, campaign_id",
        ),
    }
