from __future__ import annotations

import random
from datetime import datetime, timedelta

import brute_force
import pytest
from pyspark.sql import functions as F

from spotlift.functions.timing import days_between, minute_no, minutes_between, second_no
from spotlift.operators import reach_index
from spotlift.operators.asof import one_per_instant
from spotlift.operators.reach_index import BROADCAST_BYTES, build_index, fits
from spotlift.plans import marts

BASE = datetime(2024, 3, 10, 1, 45)  # the night clocks change in New York


def session_frame(spark, rows):
    data = [(i, f"u{i}", ts, "mobile", "direct") for i, ts in rows]
    schema = "session_id string, user_id string, session_ts timestamp_ntz, device_type string, session_source string"
    return spark.createDataFrame(data, schema)


def spot_frame(spark, rows):
    data = [(i, "C1", "TV", ts, ts.date() if ts else None, 1.5, 30) for i, ts in rows]
    schema = (
        "spot_id string, campaign_id string, channel_id string, spot_ts timestamp_ntz, spot_date date, "
        "grp_value double, spot_duration_sec int"
    )
    return spark.createDataFrame(data, schema)


def random_rows(seed, n_sessions, n_spots, span_s, step_us=1, hot=0.0):
    """Times on a grid of ``step_us``; a share ``hot`` of both sides falls on one instant."""
    rng = random.Random(seed)

    def at():
        if rng.random() < hot:
            return BASE + timedelta(seconds=1234)
        return BASE + timedelta(microseconds=rng.randrange(span_s * 1_000_000 // step_us) * step_us)

    return [(f"s{i:05}", at()) for i in range(n_sessions)], [(f"g{i:05}", at()) for i in range(n_spots)]


EDGE_SPOTS = [
    ("g_edge", BASE),  # on a bucket edge: 01:45 is a multiple of 15 minutes
    ("g_twin_b", BASE + timedelta(hours=2)),
    ("g_twin_a", BASE + timedelta(hours=2)),
    ("g_minute_1", BASE + timedelta(hours=4, seconds=5)),
    ("g_minute_2", BASE + timedelta(hours=4, seconds=20)),
    ("g_alone", BASE + timedelta(hours=9)),
    ("g_old", datetime(1969, 12, 31, 23, 59, 30, 500000)),
    ("g_no_time", None),
]
EDGE_SESSIONS = [
    ("s_at", BASE),
    ("s_last", BASE + timedelta(minutes=15)),
    ("s_late", BASE + timedelta(minutes=15, microseconds=1)),
    ("s_first", BASE - timedelta(minutes=15)),
    ("s_early", BASE - timedelta(minutes=15, microseconds=1)),
    ("s_twin", BASE + timedelta(hours=2, minutes=3)),
    ("s_same_minute", BASE + timedelta(hours=4, seconds=50)),
    ("s_between", BASE + timedelta(hours=4, seconds=10)),
    ("s_old", datetime(1969, 12, 31, 23, 59, 31)),
    ("s_new_year", datetime(1970, 1, 1, 0, 0, 1)),
    ("s_no_time", None),
]

CASES = {
    "edges": (EDGE_SESSIONS, EDGE_SPOTS),
    "sparse": random_rows(1, 300, 60, 36_000),
    "whole_seconds": random_rows(2, 500, 80, 7_200, step_us=1_000_000),
    "whole_minutes": random_rows(3, 400, 60, 14_400, step_us=60_000_000),
    "dense": random_rows(4, 400, 200, 3),
    "hot_instant": random_rows(5, 400, 90, 7_200, hot=0.34),
    "no_spots": (EDGE_SESSIONS, []),
    "no_sessions": ([], EDGE_SPOTS),
}


@pytest.fixture(params=CASES, ids=list(CASES))
def case(request):
    return CASES[request.param]


@pytest.mark.parametrize("rows_per_task", [1_000_000, 3])
def test_candidates_are_all_pairs(spark, case, rows_per_task):
    sessions, spots = case
    df = marts.session_spot_candidates(
        session_frame(spark, sessions).repartition(4), spot_frame(spark, spots), rows_per_task=rows_per_task
    )
    got = [(r.session_id, r.spot_id, r.minutes_after_spot) for r in df.collect()]
    assert sorted(got) == sorted(brute_force.pairs(sessions, spots))


@pytest.mark.parametrize("way", [{"broadcast_bytes": 0}, {"broadcast_bytes": 0, "rows_per_task": 3}, {}])
def test_nearest_spot_per_session(spark, case, way):
    sessions, spots = case
    df = marts.nearest_spots(session_frame(spark, sessions).repartition(4), spot_frame(spark, spots), **way)
    got = [(r.session_id, r.session_ts, r.spot_id) for r in df.collect()]
    assert sorted(got) == sorted(brute_force.nearest(sessions, spots))


def test_counts_around_spots(spark, case):
    sessions, spots = case
    df = marts.pre_post_spot_sessions(session_frame(spark, sessions), spot_frame(spark, spots))
    got = {(r.spot_id, r.spot_ts): (r.pre_spot_sessions, r.post_spot_sessions) for r in df.collect()}
    assert got == brute_force.around(sessions, spots)


def test_counts_of_repeated_spots_add_up(spark):
    sessions, spots = CASES["sparse"]
    repeated = spots + spots[:10] + spots[:5]
    df = marts.pre_post_spot_sessions(session_frame(spark, sessions), spot_frame(spark, repeated))
    got = {(r.spot_id, r.spot_ts): (r.pre_spot_sessions, r.post_spot_sessions) for r in df.collect()}
    assert got == brute_force.around(sessions, repeated)


def test_ranked_pairs_and_nearest_agree(spark, case):
    """Ranking every candidate pair per session gives what the as-of join gives."""
    sessions, spots = session_frame(spark, case[0]), spot_frame(spark, case[1])
    ranked = marts.attributed_sessions(marts.session_spot_candidates(sessions, spots))
    direct = marts.attributed_sessions(marts.nearest_spots(sessions, spots))
    assert sorted(map(tuple, ranked.collect())) == sorted(map(tuple, direct.collect()))


def test_repeated_session_id_keeps_fewest_minutes(spark):
    spots = spot_frame(spark, [("g1", BASE), ("g2", BASE + timedelta(hours=1))])
    sessions = session_frame(
        spark,
        [("same", BASE + timedelta(minutes=9)), ("same", BASE + timedelta(hours=1, minutes=2)), (None, BASE), (None, BASE)],
    )
    rows = marts.attributed_sessions(marts.nearest_spots(sessions, spots)).collect()
    assert sorted((r.session_id or "", r.spot_id, r.minutes_after_spot) for r in rows) == [("", "g1", 0), ("same", "g2", 2)]
    assert {r.attribution_rank for r in rows} == {1}


def test_hot_copies_are_spread_over_salts(spark):
    """Identical rows must not share one salt: they would meet in one task."""
    from spotlift.operators import salting

    copies = spark.range(0, 400, 1, 8).select(F.lit(7).cast("long").alias("key"), F.lit("x").alias("body"))
    hot = salting.hot_keys(salting.key_counts(copies, "key"), "key", rows_per_task=100)
    assert [tuple(r) for r in hot.collect()] == [(7, 4)]
    per_salt = salting.spread(copies, "key", hot).groupBy(salting.SALT).count().collect()
    assert sorted(r["count"] for r in per_salt) == [100, 100, 100, 100]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_time_numbers_ignore_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql(
            """SELECT * FROM VALUES
               (timestamp_ntz'2024-03-10 01:59:50.5', timestamp_ntz'2024-03-10 03:00:10'),
               (timestamp_ntz'1969-12-31 23:59:59.5', timestamp_ntz'1970-01-01 00:00:00') AS t(a, b)"""
        )
        rows = df.selectExpr(
            minutes_between("a", "b"),
            days_between("a", "b"),
            f"{second_no('b')} - {second_no('a')}",
            f"{minute_no('b')} * 60 - {second_no('b')}",
        ).collect()
        assert [tuple(r) for r in rows] == [(61, 0, 3620, -10), (1, 1, 1, 0)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_minute_boundaries_are_counted(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 20:30:50' a, timestamp_ntz'2024-01-01 20:31:10' b")
    assert df.selectExpr(minutes_between("a", "b")).first()[0] == 1


def executed_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_no_nested_loop_or_cartesian_join(spark, threshold):
    sessions, spots = (f(spark, rows) for f, rows in zip((session_frame, spot_frame), CASES["sparse"], strict=True))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for df in (
            marts.session_spot_candidates(sessions, spots),
            marts.attributed_sessions(marts.nearest_spots(sessions, spots)),
            marts.attributed_sessions(marts.nearest_spots(sessions, spots, broadcast_bytes=0)),
            marts.pre_post_spot_sessions(sessions, spots),
        ):
            plan = executed_plan(df)
            assert "NestedLoop" not in plan
            assert "Cartesian" not in plan
            assert "Python" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_candidates_compute_times_before_pairs(spark):
    """A pair costs two comparisons and a difference; points are dealt over all partitions, however few bytes they are."""
    sessions, spots = (f(spark, rows) for f, rows in zip((session_frame, spot_frame), CASES["sparse"], strict=True))
    plan = executed_plan(marts.session_spot_candidates(sessions, spots))
    above, join, _ = plan.partition("Join [slice")
    condition = plan[len(above) :].splitlines()[0]
    assert "REPARTITION_BY_NUM" in plan
    assert join and "INTERVAL" not in above + condition and "TIMESTAMP_NTZ" not in above + condition


def test_index_is_measured_before_it_is_broadcast(spark):
    sparse, dense = (spot_frame(spark, CASES[c][1]) for c in ("sparse", "dense"))
    sessions = session_frame(spark, CASES["sparse"][0])
    assert "Window" not in executed_plan(marts.nearest_spots(sessions, sparse)).split("BroadcastExchange")[0]
    for spots, limit in ((sparse, 1000), (dense, BROADCAST_BYTES)):  # too large; too full a minute
        plan = executed_plan(marts.nearest_spots(sessions, spots, broadcast_bytes=limit))
        assert "Window" in plan.split("BroadcastExchange")[0]


@pytest.mark.parametrize("name", ["edges", "sparse", "whole_minutes", "dense"])
def test_index_stays_within_its_announced_size(spark, name):
    instants = one_per_instant(spot_frame(spark, CASES[name][1]).drop("spot_duration_sec"), "spot_ts", ["spot_id"])
    index = build_index(instants, 900, "anchor")
    row = f"{reach_index._ROW_BYTES} + octet_length(to_json(anchor))"
    used = index.selectExpr(f"sum({row}) AS used").first().used
    most = index.groupBy("minute").count().selectExpr("max(count) AS most").first().most
    assert not fits(instants, 900, "anchor", used - 1)
    if most <= reach_index._STRETCHES_PER_MINUTE:
        assert fits(instants, 900, "anchor", 40 * used)


def test_top_attribution_is_taken_before_the_shuffle(spark):
    sessions, spots = (f(spark, rows) for f, rows in zip((session_frame, spot_frame), CASES["sparse"], strict=True))
    assert "WindowGroupLimit" in executed_plan(marts.attributed_sessions(marts.nearest_spots(sessions, spots)))


def test_many_spots_in_a_minute_are_spread(spark):
    """A grid over one minute: every pair once, none of its cells with more than a small part of them."""
    from spotlift.operators import interval_join as joins

    left = spark.range(900).selectExpr("id AS p", "timestamp_ntz'2024-01-01 10:05:00' + make_dt_interval(0, 0, 0, id % 50) AS ts")
    right = spark.range(500).selectExpr("id AS a", "timestamp_ntz'2024-01-01 10:04:00' AS at")
    pairs = joins.interval_join(left, right, "ts", "at", 0, 900, rows_per_task=1000, anchors_per_task=50)
    assert (pairs.count(), pairs.distinct().count()) == (450_000, 450_000)
    points = left.selectExpr("*", "1 AS slice")
    anchors = right.selectExpr("*", "1 AS slice")
    grid = joins._grid(points, anchors, 100, 50)
    assert tuple(grid.first()) == (1, 9, 10)
    cells = joins._placed(anchors, grid, "anchor_block", "point_block").groupBy("point_block", "anchor_block").count()
    assert cells.count() == 90 and cells.agg({"count": "max"}).first()[0] < 100


def _join_rows(plan) -> int:
    """Rows that come out of all joins of an executed plan."""
    children = plan.children()
    own = plan.metrics().get("numOutputRows").get().value() if "Join" in plan.nodeName() else 0
    return own + sum(_join_rows(children.apply(i)) for i in range(children.size()))


@pytest.mark.parametrize("way", ["joined", "from_ranges"])
def test_pairs_come_from_lists_of_spots(spark, way):
    """160,000 pairs of 400 sessions and 400 spots: a join of rows with rows would give each pair, joined to lists it gives far fewer."""
    at = [BASE + timedelta(seconds=i) for i in range(400)]
    sessions = session_frame(spark, [(f"s{i}", t + timedelta(seconds=400)) for i, t in enumerate(at)]).repartition(4)
    spots = spot_frame(spark, [(f"g{i}", t) for i, t in enumerate(at)])
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        if way == "joined":
            df = marts.session_spot_candidates(sessions, spots)
        else:
            df = marts.expanded_candidates(marts.candidate_ranges(sessions, spots), sessions)
        assert len({(r.session_id, r.spot_id) for r in df.collect()}) == 160_000
        assert _join_rows(df._jdf.queryExecution().executedPlan()) < 30_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("before_s, after_s", [(600, 300), (0, 900), (0, 0), (1, 0)])
def test_lists_hold_all_pairs(spark, seed, before_s, after_s):
    """More anchors than a list holds at one instant, both ends of the interval, rows without time, and lists cut by another column."""
    from spotlift.operators.interval_join import ANCHORS_PER_LIST, interval_join

    rng = random.Random(seed)
    ends = [timedelta(seconds=s, microseconds=us) for s in (-after_s, 0, before_s) for us in (-1, 0, 1)]
    points = [(i, BASE + timedelta(seconds=rng.randrange(2000))) for i in range(60)] + [(60, None)]
    near = [points[0][1] + e for e in ends] * 2 + [points[1][1]] * (2 * ANCHORS_PER_LIST + 1)
    drawn = [*near, *(BASE + timedelta(microseconds=rng.randrange(2_000_000_000)) for _ in range(200)), None]
    anchors = [(i, at, i % 3) for i, at in enumerate(drawn)]
    left = spark.createDataFrame(points, "p long, ts timestamp_ntz").repartition(3)
    right = spark.createDataFrame(anchors, "a long, at timestamp_ntz, kind long").repartition(3)
    want = [
        (p, a, p - kind) for p, ts in points for a, at, kind in anchors
        if ts and at and at - timedelta(seconds=before_s) <= ts <= at + timedelta(seconds=after_s)
    ]
    pairs = interval_join(left, right, "ts", "at", before_s, after_s, together=["kind"], once=["p - kind AS d"])
    assert pairs.columns == ["p", "ts", "d", "a", "at"]
    assert sorted((r.p, r.a, r.d) for r in pairs.collect()) == sorted(want)
    plain = interval_join(left, right, "ts", "at", before_s, after_s, rows_per_task=10, anchors_per_task=5)
    assert plain.columns == ["p", "ts", "a", "at", "kind"]
    assert sorted((r.p, r.a, r.p - r.kind) for r in plain.collect()) == sorted(want)
