"""Phrases against counts of every n-gram on small texts."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotlift.llm import collocations
from spotlift.llm.collocations import Phrases


def plain(rows, phrases):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, phrases.longest + 1):
                f.update((lang, *words[i : i + size]) for i in range(len(words) - size + 1))
    cands = {p: a for p, a in f.items() if len(p) > 2 and a >= phrases.least}
    best = {}
    for (lang, *p), a in cands.items():
        cuts = [(10**6 * a * a // (f[lang, *p[:k]] * f[lang, *p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        longer = [b for (other, *q), b in cands.items() if other == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
        if not any(100 * b >= phrases.inside_percent * a for b in longer):
            best.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, *p[:k]], f[lang, *p[k:]]))
    found = []
    for lang, rows_of in best.items():
        for rank, (score, a, p, left, right) in enumerate(sorted(rows_of)[: phrases.per_lang], 1):
            found.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(found)


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(5)
    words = ["a", "B", "c", "É", "é", "dd", "x y", "it's", "(e)"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "?!", "\r\n"]
    rows = [(lang, "".join(w + e for w, e in zip(rng.choice(words, 300), rng.choice(ends, 300), strict=True))) for lang in ("en", None, "und", "fr") for _ in range(3)]
    rows += [("de", "new york city " * 12 + ". " + "new york . " * 3), ("de", "a a a a a a a a a a a a a"), ("es", " .\t! "), ("es", ""), ("es", None)]
    rows += [("it", "zz yy " * 100_000), ("fr", rows[0][1]), ("fr", rows[0][1])]
    return rows


@pytest.mark.parametrize("phrases", [Phrases(), Phrases(longest=2, least=3), Phrases(longest=4, least=2, inside_percent=80, per_lang=7, ranked_words=4)])
def test_phrases(spark, texts, phrases):
    docs = spark.createDataFrame([(lang, t, i, "clash", 1) for i, (lang, t) in enumerate(texts)], "lang string, text string, doc_id long, words string, w1 int")
    got = sorted(tuple(r) for r in collocations.collocations(docs, phrases).collect())
    assert got == plain(texts, phrases)
    assert len(got) > 20


def test_no_rows(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(none).count() == 0
    blank = spark.createDataFrame([("en", " "), (None, None)], "lang string, text string")
    assert collocations.collocations(blank).count() == 0


def test_large_counts_stay_exact(spark):
    big = 3_000_000_000_000_000
    rows = [("en", [1, 2], big), ("en", [1], big + 1), ("en", [2], big), ("en", [], 9 * big)]
    counts = spark.createDataFrame(rows, "lang string, numbers array<long>, f long")
    assert [tuple(r) for r in collocations.scored_phrases(counts).select("a", "l", "r", "score").collect()] == [(big, big + 1, big, 999_999)]


def test_windows_are_counted_in_one_shuffle(spark, texts):
    """Both branches read the counted windows; only the rollup is shuffled besides."""
    docs = spark.createDataFrame(texts, "lang string, text string")
    numbers = collocations.numbered_words(docs, 10, 5)
    counts = collocations.numbered_counts(docs, numbers, Phrases())
    assert {r["n"] for r in counts.groupBy("lang", "numbers").agg(F.count("*").alias("n")).collect()} == {1}
    rows = counts.collect()
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert rows and "ReusedExchange" in plan and "Expand" in plan
