"""Personal data in texts with very many matches, and the rules on overlaps against a plain version."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from spotlift.llm import pii

LAYOUT = "doc_id long, text string"


def test_a_table_of_100000_numbers(spark):
    text = ", ".join(str(10 + i % 90) for i in range(100_000)) + " and card 4111 1111 1111 1111"
    frame = spark.createDataFrame([(1, text)], LAYOUT)
    begun = time.monotonic()
    row = pii.report(frame).first()
    assert row["n_card"] == 1 and row["spans"] == f"card:{len(text) - 19}:{len(text)}"
    assert pii.masked(frame).first()["text"] == text[:-19] + "[CARD]"
    assert time.monotonic() - begun < 60


def test_many_confirmed_spans(spark):
    part = "ß🙂 jo@mail.org ssn 123-45-6789; "
    count = 20_000
    frame = spark.createDataFrame([(1, part * count)], LAYOUT)
    row = pii.report(frame).first()
    assert row["n_email"] == count
    at = [i * len(part) for i in range(count)]
    assert row["spans"] == ",".join(f"email:{a + 3}:{a + 14},ssn:{a + 19}:{a + 30}" for a in at)
    assert pii.masked(frame).first()["text"] == "ß🙂 [EMAIL] ssn [SSN]; " * count


def test_context_reaches_across_matches(spark):
    """Context words count within 40 characters before a span, whatever matches lie between."""
    near = "phone " + "1, " * 11 + "555-123-4567"
    far = "phone " + "1, " * 12 + "   555-123-4567"
    frame = spark.createDataFrame([(1, near), (2, far)], LAYOUT)
    spans = {r["doc_id"]: r["spans"] for r in pii.report(frame).collect()}
    assert spans == {1: "local_phone:39:51", 2: ""}


def _settled(spans):
    base = [s for s in spans if s[1] < len(pii.BASE)]
    return [s for s in spans if s[1] < len(pii.BASE) or not any(s[0] < b[3] and b[0] < s[3] for b in base)]


def test_added_spans_give_way(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(300):
        spans = []
        for _ in range(rnd.randrange(12)):
            start, kind = rnd.randrange(40), rnd.randrange(len(pii.KINDS))
            spans.append((start, kind, pii.KINDS[kind], start + 1 + rnd.randrange(9), 0.5))
        rows.append((i, sorted(spans)))
    frame = spark.createDataFrame(rows, f"id long, spans {pii._SPANS}").select("id", pii._settled(F.col("spans")).alias("kept"))
    got = {r["id"]: [tuple(s) for s in r["kept"]] for r in frame.collect()}
    assert got == {i: _settled(spans) for i, spans in rows}


def test_running_joins(spark):
    rnd = random.Random(6)
    rows = [(i, [rnd.randrange(100) for _ in range(n)]) for i, n in enumerate([0, 1, 2, 3, 7, 8, 9, 100])]
    frame = spark.createDataFrame(rows, "id long, v array<int>").select(
        "id", pii._running(F.col("v"), lambda x, y: x + y).alias("sums"), pii._running(F.col("v"), F.least, back=True).alias("least")
    )
    for r in frame.collect():
        v = rows[r["id"]][1]
        assert r["sums"] == [sum(v[: i + 1]) for i in range(len(v))]
        assert r["least"] == [min(v[i:]) for i in range(len(v))]


@pytest.mark.parametrize("rows", [[], [(None, "a@b.co"), (None, "a@b.co"), (3, None), (3, "")]])
def test_no_rows_repeated_rows_and_no_ids(spark, rows):
    frame = spark.createDataFrame(rows, LAYOUT)
    got = [(r["doc_id"], r["n_email"], r["spans"]) for r in pii.report(frame).collect()]
    want = [(i, int(t == "a@b.co"), "email:0:6" if t == "a@b.co" else "") for i, t in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert pii.masked(frame).count() == len(rows)


def test_clashing_columns(spark):
    frame = spark.createDataFrame([(1, "a@b.co", 7, 8, 9)], "doc_id long, text string, PII int, _pii_email int, _pii_more int")
    row = pii.with_spans(frame).first()
    assert (row["_pii_email"], row["_pii_more"], row["pii"][0]["kind"]) == (8, 9, "email")
