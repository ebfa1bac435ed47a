"""Mixing at a stated rate: against a plain version, and with sources, languages and documents that are scarce."""

from __future__ import annotations

import dataclasses

import numpy as np
import pytest

from spotlift.llm import mixing
from test_pipeline import _raked

LAYOUT = "doc_id long, text string, lang string, source string"


def _rows(n=1500):
    rng = np.random.default_rng(8)
    texts = ["word " * int(rng.integers(1, 40)) + ("7" if rng.random() < 0.2 else "") for _ in range(n)]
    return [(i, t, str(rng.choice(["en", "de", "fr"], p=[0.8, 0.18, 0.02])), str(rng.choice(["a", "b", "c"], p=[0.7, 0.29, 0.01]))) for i, t in enumerate(texts)]


def _probabilities(spark, rows, targets):
    return mixing.drawn(spark.createDataFrame(rows, LAYOUT), targets).toPandas()


@pytest.mark.parametrize("kept", [0.3, 0.9, 1.0])
def test_rate_against_plain_version(spark, kept):
    targets = dataclasses.replace(mixing.CORPUS, kept=kept, temper=0.5)
    got = _probabilities(spark, _rows(), targets)
    cells = got.groupby(["source", "lang", "topic"]).agg(n=("n_tokens", "sum"), p=("probability", "first")).reset_index()
    names = [sorted(set(cells[c])) for c in ("source", "lang", "topic")]
    table = np.zeros([len(n) for n in names])
    have = table.copy()
    for r in cells.itertuples():
        at = tuple(n.index(v) for n, v in zip(names, (r.source, r.lang, r.topic), strict=True))
        table[at], have[at] = r.n, r.p
    want = _raked(table, [table.sum(tuple({0, 1, 2} - {d})) ** 0.5 for d in range(3)], kept * table.sum())
    assert np.abs(np.where(table > 0, want - have, 0)).max() < 1e-5
    assert (got.probability * got.n_tokens).sum() == pytest.approx(kept * table.sum(), rel=1e-6)


def test_a_stray_document_costs_others_nothing(spark):
    rows = _rows()
    stray = (len(rows), "stray " * 20, "en", "elsewhere")
    before = _probabilities(spark, rows, mixing.CORPUS)
    after = _probabilities(spark, [*rows, stray], mixing.CORPUS)
    kept = [(g.probability * g.n_tokens).sum() for g in (before, after)]
    assert abs(kept[1] - kept[0]) <= 20
    assert after.probability[after.doc_id == len(rows)].item() == pytest.approx(1)


def test_given_shares_at_a_rate(spark):
    """Scarce names give all they have; names without a share give nothing."""
    rows = _rows()
    targets = mixing.Targets(source={"a": 0.5, "c": 0.5}, kept=0.4)
    got = _probabilities(spark, rows, targets)
    assert (got.probability[got.source == "b"] == 0).all()
    assert got.probability[got.source == "c"].min() == pytest.approx(1)
    assert (got.probability * got.n_tokens).sum() == pytest.approx(0.4 * got.n_tokens.sum(), rel=1e-6)
    beyond = _probabilities(spark, rows, dataclasses.replace(targets, kept=0.95))
    assert beyond.probability[beyond.source != "b"].min() == pytest.approx(1)


def test_rate_of_odd_rows(spark):
    rows = [(1, None, None, None), (1, None, None, None), (None, "a few words", "en", None), (2, "", "en", "a"), (3, " \n", None, "a")]
    got = _probabilities(spark, rows, mixing.CORPUS)
    assert got[got.n_tokens == 0].kept.all() and len(got) == 5
    nothing = spark.createDataFrame([], LAYOUT)
    assert mixing.mixed(nothing, mixing.CORPUS).count() == 0
    nobody = mixing.Targets(source={"z": 1.0}, kept=0.5)
    assert _probabilities(spark, rows, nobody).kept.sum() == 4  # only texts without words
