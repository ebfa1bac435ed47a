from __future__ import annotations

import math

import numpy as np
import pytest

from spotlift.operators.isolation_forest import draw_samples, fit_forest, mean_path_length, with_raw_score
from spotlift.plans import scoring
from spotlift.plans.scoring import ResponseModel, score_responses

N = 1200


@pytest.fixture(scope="module")
def effectiveness(spark):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(N):
        pre, post = int(rng.integers(3, 9)), int(rng.integers(3, 9))
        budget = float(rng.integers(90, 110))
        if i < 5:  # planted
            pre, post, budget = 500 + i, 900 + 7 * i, 1e6
        rows.append((i, i % 7, i % 3, pre, post, round((post - pre) * 100 / pre, 2), post // 2, budget if i % 50 else None))
    schema = (
        "spot_id long, campaign_id long, channel_id long, pre_spot_sessions long, post_spot_sessions long, "
        "incremental_lift_pct double, attributed_sessions long, budget double"
    )
    df = spark.createDataFrame(rows, schema)
    return df.selectExpr("*", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, spot_id) AS spot_ts")


@pytest.fixture(scope="module")
def scored(effectiveness):
    return score_responses(effectiveness)


def by_spot(df):
    return {r.spot_id: r.anomaly_score for r in df.collect()}


def test_same_seed_gives_same_scores_for_any_partitioning(effectiveness, scored):
    again = score_responses(effectiveness.repartition(7))[1]
    assert by_spot(again) == by_spot(scored[1])


def test_other_seed_gives_other_scores(effectiveness, scored):
    assert by_spot(score_responses(effectiveness, seed=7)[1]) != by_spot(scored[1])


def test_abnormal_share_and_flag(scored):
    rows = scored[1].collect()
    assert len(rows) == N
    assert sum(r.is_abnormal_response for r in rows) / N == pytest.approx(0.25, abs=0.02)
    assert all(r.is_abnormal_response == int(r.anomaly_score < 0) for r in rows)
    assert scored[1].columns == list(scoring.SCORE_COLUMNS)


def test_planted_outliers_score_lowest(scored):
    ordered = sorted(by_spot(scored[1]).items(), key=lambda kv: kv[1])
    assert {spot for spot, _ in ordered[:5]} == {0, 1, 2, 3, 4}


def test_saved_model_scores_the_same(spark, effectiveness, scored, tmp_path):
    model, scores = scored
    model.save(spark, str(tmp_path / "model"))
    loaded = ResponseModel.load(spark, str(tmp_path / "model"))
    assert loaded.scaler == model.scaler
    assert by_spot(loaded.score(scoring.ml_features(effectiveness))) == by_spot(scores)


def test_scores_match_a_walk_through_the_stored_trees(effectiveness, scored):
    """An independent reader of the node table arrives at the same raw score."""
    model, _ = scored
    features = scoring.ml_features(effectiveness)
    nodes = {(n.tree_id, n.node_id): n for n in model.forest.nodes.itertuples()}
    trees = sorted({t for t, _ in nodes})
    assert len(trees) == 100
    got = {r.spot_id: r.raw_score for r in with_raw_score(features, model.forest).collect()}
    for row in features.where("spot_id % 131 = 0").collect():
        x = [float(row[c]) for c in model.forest.features]
        depths = []
        for t in trees:
            node, depth = nodes[t, 0], 0
            while node.feature >= 0:
                node = nodes[t, node.left_id if x[node.feature] <= node.threshold else node.right_id]
                depth += 1
            depths.append(depth + mean_path_length(node.size))
        want = -(2.0 ** (-np.mean(depths) / mean_path_length(256)))
        assert got[row.spot_id] == pytest.approx(want, rel=1e-12)


def test_trees_hold_their_sample_and_depth_limit(scored):
    nodes = scored[0].forest.nodes
    leaves = nodes[nodes.feature < 0]
    assert (leaves.groupby("tree_id")["size"].sum() == 256).all()
    inner = nodes[nodes.feature >= 0]
    assert (inner.path < math.ceil(math.log2(256))).all()
    assert (leaves["size"] >= 1).all()


def test_every_tree_draws_distinct_rows(spark):
    df = spark.range(20_000).selectExpr("id", "cast(id AS double) AS x")
    samples = draw_samples(df, ["x"], ["id"], trees=8, sample=64, seed=1, share=0.05)
    per_tree = samples.groupBy("tree_id").agg({"x": "count"}).collect()
    assert sorted(r[1] for r in per_tree) == [64] * 8
    assert samples.select("tree_id", "x").distinct().count() == 8 * 64


def test_the_share_does_not_change_a_full_draw(spark):
    df = spark.range(3000).selectExpr("id", "cast(id AS double) AS x")
    drawn = [
        sorted(draw_samples(df, ["x"], ["id"], trees=5, sample=32, seed=3, share=share).collect()) for share in (1.0, 0.2)
    ]
    assert drawn[0] == drawn[1] and len(drawn[0]) == 5 * 32


@pytest.mark.parametrize("by_key", ["id % 50", "0"])
def test_repeated_keys_and_equal_rows_leave_no_tree_short(spark, by_key):
    df = spark.range(20_000).selectExpr(f"{by_key} AS id", "cast(id % 3 AS double) AS x", "cast(id % 7 = 0 AS double) AS y")
    forest = fit_forest(df, ["x", "y"], ["id"])
    roots = forest.nodes[forest.nodes.node_id == 0]
    assert len(roots) == 100 and (roots["size"] == 256).all()
    x = forest.nodes[(forest.nodes.feature == 0)]
    assert len(x), "copies of a row stand for themselves, so samples hold different rows"


def test_mean_path_length():
    assert [mean_path_length(n) for n in (0, 1, 2)] == [0.0, 0.0, 1.0]
    assert mean_path_length(256) == pytest.approx(10.2448, abs=1e-4)


@pytest.mark.parametrize("n", [1, 2, 4])
def test_tiny_tables(spark, effectiveness, n):
    rows = score_responses(effectiveness.where(f"spot_id < {n}"))[1].collect()
    assert len(rows) == n
    assert all(math.isfinite(r.anomaly_score) for r in rows)


def test_empty_table_is_refused(effectiveness):
    with pytest.raises(ValueError, match="No campaign effectiveness data"):
        score_responses(effectiveness.where("false"))
    with pytest.raises(ValueError, match="no rows"):
        fit_forest(effectiveness.where("false"), ["budget"], ["spot_id"])


def test_segments_run_without_python(effectiveness):
    df = scoring.with_segment(scoring.ml_features(effectiveness).selectExpr("*", "1 AS is_abnormal_response"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_python_functions_need_no_installed_package(tmp_path):
    """Executors do not have this package on their path."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from spotlift.operators import isolation_forest

    code = "import pickle, sys, numpy as np; f = pickle.load(sys.stdin.buffer); print(len(f(np.eye(2), 1, 1)))"
    result = subprocess.run(
        [sys.executable, "-I", "-c", code], input=cloudpickle.dumps(isolation_forest._grow), capture_output=True, cwd=tmp_path
    )
    assert result.stdout.strip() == b"3", result.stderr
