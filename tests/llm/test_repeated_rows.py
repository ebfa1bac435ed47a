"""Rows and ids that are repeated very often, against brute force."""

from __future__ import annotations

import re
import time

import numpy as np
import pytest

from spotlift.llm import embedding_dedup, minhash_dedup
from spotlift.llm.embedding_dedup import RangeJoin

WORDS = [f"w{i}" for i in range(400)]


def test_one_row_many_times(spark):
    """5,000 repeats of one row, near copies of it under other ids, and hundreds of near copies under one id."""
    rng = np.random.default_rng(4)
    base = list(rng.choice(WORDS, 80))

    def changed(k):
        return " ".join([*base[:k], f"x{k}", *base[k + 1 :]])

    rows = [(7, " ".join(base))] * 5000 + [(8, changed(5)), (3, changed(70)), (3, "other " + " ".join(rng.choice(WORDS, 30)))]
    rows += [(20, changed(1 + i % 78) + "  " * (i // 78)) for i in range(400)] + [(None, " ".join(base))] * 3 + [(21, None)] * 50
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    before = time.time()
    got = {tuple(r) for r in minhash_dedup.near_duplicates(frame).collect()}
    assert time.time() - before < 90
    size = lambda t: len({tuple(w[j : j + 5]) for w in [re.findall(r"\S+", t or "")] for j in range(len(w) - 4)})
    assert got == {(i, size(t), {21: 21, None: None}.get(i, 3), i in (3, 21, None)) for i, t in rows}


@pytest.mark.parametrize("config", [RangeJoin(), RangeJoin(block=1, cell=8), RangeJoin(block=3, pivots=4, cell=8)])
def test_links_of_repeated_ids(spark, config):
    """Vectors that share an id are counted one by one; blocks that got no row add nothing."""
    rng = np.random.default_rng(9)
    centre = rng.normal(size=12)
    rows = [(1, (centre + rng.normal(size=12) * 0.01).tolist(), 0) for _ in range(20)]
    rows += [(2 + i, (centre + rng.normal(size=12) * 0.02).tolist(), 0) for i in range(15)]
    rows += [(40 + i % 3, rng.normal(size=12).tolist(), i % 2) for i in range(40)] + [(5, rows[0][1], 0)] * 6 + [(6, rows[0][1], None)] * 2
    vectors = np.array([r[1] for r in rows])
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    alike = units @ units.T >= 0.98
    labels = np.array([-1 - i if r[2] is None else r[2] for i, r in enumerate(rows)])
    alike &= labels[:, None] == labels
    np.fill_diagonal(alike, False)
    component = {r[0]: r[0] for r in rows}
    for _ in range(10):
        for i, j in zip(*np.nonzero(alike), strict=True):
            component[rows[i][0]] = min(component[rows[i][0]], component[rows[j][0]])
    want = sorted((r[0], int(alike[i].sum()), component[r[0]], component[r[0]] == r[0]) for i, r in enumerate(rows))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted(tuple(r) for r in embedding_dedup.near_duplicates(frame, config).collect()) == want
