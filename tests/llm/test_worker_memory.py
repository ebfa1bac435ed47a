"""Python workers hold small parts of a batch, and one worker serves a task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from spotlift.llm import byte_bpe, quality


def test_statistics_copy_few_texts_at_a_time(monkeypatch):
    texts = pa.array([None if i % 50 == 0 else f"Text {i}, line one.\nline {i % 7} of it | {'word ' * (i % 40)}" for i in range(1000)])
    copied = []
    original = quality.column_bytes
    monkeypatch.setattr(quality, "column_bytes", lambda column: copied.append(len(column)) or original(column))
    in_parts = quality.Statistician().rows(texts)
    assert max(copied) <= 256 and sum(copied) == 1000
    assert np.array_equal(in_parts, np.concatenate([quality.Statistician().rows(texts.slice(i, 1)) for i in range(1000)]))
    assert quality.Statistician().rows(texts.slice(0, 0)).shape == (0, len(quality.STATISTICS))


def test_one_worker_encodes_and_decodes(spark):
    rows = [(1, "One text, two lines\n of it"), (2, None), (3, ""), (3, "again é中 " * 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    both = byte_bpe.encoded_and_decoded(docs)
    assert both._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    plain = byte_bpe.decoded(byte_bpe.encoded(docs))
    assert both.columns == plain.columns
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, plain.collect()))
    assert byte_bpe.round_trip(docs)._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
