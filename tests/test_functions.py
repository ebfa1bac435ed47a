from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from spotlift.functions.numeric import invalid_number, to_number
from spotlift.functions.quantile import exact_quantile
from spotlift.functions.response import clean_label, lift_pct, response_segment
from spotlift.operators.ranking import global_rank
from spotlift.operators.scaling import Scaler


def test_lift_rules(spark):
    df = spark.createDataFrame([(0, 5), (0, 0), (2, 4), (2, 1), (3, 4), (4, 0)], "pre long, post long")
    got = [r[0] for r in df.selectExpr(lift_pct("pre", "post")).collect()]
    assert got == [100.0, 0.0, 100.0, -50.0, 33.33, -100.0]


def test_segment_rules(spark):
    nan = float("nan")
    cases = [
        (10.0, 1, "Abnormal Positive Spike"),
        (-10.0, 1, "Abnormal Negative Drop"),
        (0.0, 1, "Insufficient Baseline"),
        (50.0, 0, "High Positive Lift"),
        (49.9, 0, "Normal Positive Lift"),
        (-0.1, 0, "Weak Response"),
        (0.0, 0, "Insufficient Baseline"),
        (None, 0, "Insufficient Baseline"),
        (nan, 1, "Insufficient Baseline"),
    ]
    df = spark.createDataFrame(cases, "lift double, abnormal int, want string")
    rows = df.select(response_segment("lift", "abnormal").alias("got"), "want").collect()
    assert all(r.got == r.want for r in rows)


def test_clean_label(spark):
    df = spark.createDataFrame([("  MoBile ",), (None,)], "x string")
    assert [r[0] for r in df.selectExpr(clean_label("x")).collect()] == ["mobile", None]


def test_text_to_number(spark):
    values = ["1", " 2.5 ", "1e3", "-4", "abc", "1d", "2.0f", "", "NaN", None, "inf", "{}"]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    invalid = [r[0] for r in df.select(invalid_number("x")).collect()]
    assert invalid == [False, False, False, False, True, True, True, False, False, False, False, True]
    assert [r[0] for r in df.limit(4).select(to_number("x")).collect()] == [1.0, 2.5, 1000.0, -4.0]


@pytest.mark.parametrize("values", [
    [3.0], [1.0, 2.0], [1.0, 1.0, 1.0], [-0.5, 2.5, 2.5, 9.0], list(np.linspace(-1, 0, 5001)),
    [0.0] * 4000 + list(np.random.default_rng(7).normal(size=3000)),
    [1.0, 1.0 + 2**-52, 1.0 + 2**-51, 1e12], list(np.random.default_rng(8).pareto(0.4, 4000)),
])
@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.999, 1.0])
def test_exact_quantile(spark, values, q):
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(3)
    assert exact_quantile(df, "v", q) == pytest.approx(float(np.quantile(values, q)), rel=1e-12, abs=1e-15)


def test_exact_quantile_of_nothing(spark):
    assert exact_quantile(spark.createDataFrame([(None,)], "v double"), "v", 0.5) is None


@pytest.mark.parametrize("rows_per_range", [100_000, 40, 1])
def test_global_rank_matches_a_single_window(spark, rows_per_range):
    rng = random.Random(3)
    rows = [(i, rng.randrange(5), rng.randrange(40)) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, a int, b int")
    got = {r.id: r["rank"] for r in global_rank(df, {"a": "desc", "b": "asc"}, rows_per_range=rows_per_range).collect()}
    ordered = sorted((-a, b) for _, a, b in rows)
    assert got == {i: ordered.index((-a, b)) + 1 for i, a, b in rows}


@pytest.mark.parametrize("order", [{"x": "desc", "s": "asc"}, {"s": "desc", "x": "asc"}, {"d": "asc", "x": "desc"}])
def test_global_rank_of_nulls_and_hot_values(spark, order):
    """A third of the rows share one value; nulls, NaN, text and decimals among the order's columns."""
    rng = random.Random(4)
    some = [None, float("nan"), -0.0, 0.0, 1.5, -2.5, float("inf")]
    rows = [(i, rng.choice(some) if i % 3 else 7.0, rng.choice([None, "", "b", "B", "ä"]), rng.randrange(9)) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, x double, s string, n int").selectExpr("*", "cast(n AS decimal(9, 2)) / 7 AS d")
    sort = [F.desc(c) if direction == "desc" else F.asc(c) for c, direction in order.items()]
    want = {r["id"]: r["r"] for r in df.withColumn("r", F.rank().over(Window.orderBy(*sort))).collect()}
    got = {r["id"]: r["rank"] for r in global_rank(df, order, rows_per_range=30).collect()}
    assert got == want
    assert global_rank(df.limit(0), order).count() == 0


def test_global_rank_shuffles_rows_once(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 AS a")
    plan = global_rank(df, {"a": "asc", "id": "asc"}, rows_per_range=100)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(range_no") == 2  # the rows, and the counts that the map side has combined
    assert "Exchange rangepartitioning" not in plan


def test_scaler_uses_population_deviation_and_centres_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, c double")
    scaler = Scaler.fit(df, ["x", "c"])
    assert [tuple(r) for r in scaler.transform(df).collect()] == [(-1.0, 0.0), (1.0, 0.0)]
