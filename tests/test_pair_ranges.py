"""Candidate pairs as ranges against all pairs, and primary keys of several tables in one grouping."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from spotlift.operators.pair_ranges import pair_ranges
from spotlift.plans import qa_report

START = dt.datetime(2026, 4, 20, 23, 50)


def _frames(spark, points, anchors):
    return (
        spark.createDataFrame(points, "p long, t timestamp_ntz"),
        spark.createDataFrame(anchors, "a long, s timestamp_ntz, label string").repartition(3),
    )


@pytest.mark.parametrize("seed", range(3))
def test_ranges_hold_all_pairs(spark, seed):
    """Ties, instants on bucket borders and at both ends of the window, rows without time, and many rows at one instant."""
    draw = random.Random(seed)
    moments = [START + dt.timedelta(seconds=draw.choice([0, 1, 600, 899, 900, 901, 1800, draw.randrange(4000)])) for _ in range(60)]
    moments += [m + dt.timedelta(microseconds=draw.choice([-1, 0, 1])) for m in moments[:20]]
    points = [(i, draw.choice([*moments, None])) for i in range(80)]
    anchors = [(i, draw.choice([*moments, None]), "x") for i in range(70)] + [(99, moments[0], "same")] * 30
    left, right = _frames(spark, points, anchors)
    found = pair_ranges(left, right, "t", "s", 900)
    window = dt.timedelta(seconds=900)
    want = sorted((p, t, a, s, x) for p, t in points for a, s, x in anchors if t and s and t - window <= s <= t)
    assert sorted(tuple(r) for r in found.expanded(left).collect()) == want
    assert found.ranges.count() <= 2 * len({t for _, t in points if t})
    numbers = [(r["bucket"], r["number"]) for r in found.anchors.collect()]
    assert len(set(numbers)) == len(numbers) == sum(s is not None for _, s, _ in anchors)
    per_instant = {r["t"]: r["pairs"] for r in found.pair_counts().collect()}
    assert sum(per_instant[t] for _, t in points if t in per_instant) == len(want)


def test_no_rows(spark):
    left, right = _frames(spark, [(1, START)], [(1, START, "x")])
    for points, anchors in ((left.limit(0), right), (left, right.limit(0)), (left.limit(0), right.limit(0))):
        found = pair_ranges(points, anchors, "t", "s", 900)
        assert found.ranges.count() == found.expanded(points).count() == 0


def test_size_follows_the_instants(spark):
    """40,000 pairs of two crowded instants take one row."""
    left, right = _frames(spark, [(i, START) for i in range(200)], [(i, START, "x") for i in range(200)])
    found = pair_ranges(left, right, "t", "s", 900)
    assert [(r["first"], r["until"]) for r in found.ranges.collect()] == [(0, 200)]
    assert found.expanded(left).count() == 40_000


def _shuffled_rows(plan) -> int:
    metric = plan.metrics().get("shuffleRecordsWritten")
    children = plan.children()
    return (metric.get().value() if metric.isDefined() else 0) + sum(_shuffled_rows(children.apply(i)) for i in range(children.size()))


def test_listed_pairs_are_not_shuffled(spark):
    """300 points within ten seconds meet 300 anchors: 90,000 pairs from 600 rows; busy parts are cut on both sides."""
    near = [START + dt.timedelta(seconds=i % 10) for i in range(300)]
    left, right = _frames(spark, [(i, t + dt.timedelta(seconds=10)) for i, t in enumerate(near)], [(i, t, "x") for i, t in enumerate(near)])
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        found = pair_ranges(left, right, "t", "s", 900)
        pairs = found.expanded(left)
        assert len({(r["p"], r["a"]) for r in pairs.collect()}) == 90_000
        assert _shuffled_rows(pairs._jdf.queryExecution().executedPlan()) < 20_000
        cut = found.expanded(left, rows_per_task=100, anchors_per_task=20)
        assert len({(r["p"], r["a"]) for r in cut.collect()}) == cut.count() == 90_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_keys_of_several_tables(spark):
    """One shuffle for all; types do not mix, nulls are one group and minus zero is zero."""
    whole = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    text = spark.createDataFrame([("1",), ("2",), ("2",), ("x",), ("",), (None,)], "k string")
    real = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),), (1.5,)], "k double")
    none = whole.where("false")
    report = qa_report.key_checks([(n, df, "k") for n, df in (("w", whole), ("t", text), ("r", real), ("e", none))])
    got = {r["check_name"]: (r["status"], r["details"]) for r in report.collect()}
    assert got == {
        "Null check: w.k": ("FAILED", "Null count=2"),
        "Duplicate check: w.k": ("FAILED", "Duplicate key groups=2"),
        "Null check: t.k": ("FAILED", "Null count=1"),
        "Duplicate check: t.k": ("FAILED", "Duplicate key groups=1"),
        "Null check: r.k": ("PASSED", "No null primary keys"),
        "Duplicate check: r.k": ("FAILED", "Duplicate key groups=2"),
        "Null check: e.k": ("PASSED", "No null primary keys"),
        "Duplicate check: e.k": ("PASSED", "No duplicate primary keys"),
    }
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1
