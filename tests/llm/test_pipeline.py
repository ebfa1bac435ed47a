"""The pipeline against a plain version of each of its stages, on documents with planted cases."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from spotlift.llm import byte_bpe, mixing, toxicity

LAYOUT = "doc_id long, text string, lang string, source string, n_chars long, score long, ids string"


def _documents() -> tuple[list[tuple], set[int]]:
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(300)]
    insults = ["idiotic", "scumbag", "moronic"]
    texts, toxic = [], set()
    for i in range(300):
        text = list(rng.choice(words, 60))
        if i % 4 == 0:
            toxic.add(i)
            text[7:10] = insults  # all three: with one, so few examples teach the model too little
        if i % 5 == 1:
            text[30:30] = ["write", "to", f"jo{i}@mail.org,", "or", "4111", "1111", "1111", "1111"]
        texts.append(" ".join(text))
    copied = [t for i, t in enumerate(texts) if i not in toxic][:40]
    texts += [*copied, *[t + " more" for t in copied], *[copied[0].upper()] * 3, "", " \n", "two words", "Straße 日本 🙂 " * 400]
    rows = [(i, t, ["en", "de", None][i % 7 % 3], ["a", "a", "b", "c"][i % 4 if i % 3 else 0], len(t), i, "x") for i, t in enumerate(texts)]
    return [*rows, rows[1], (len(rows), None, "en", "a", None, 0, "x")], toxic


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, toxic = _documents()
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, LAYOUT).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int(i in toxic)) for i in range(300)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def _near_copies_gone(rows):
    sets = []
    for r in rows:
        w = [re.sub("[A-Z]", lambda m: m.group().lower(), x) for x in _words(r[1])]
        sets.append({tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set())
    least = {r[0]: r[0] for r in rows}
    links = [
        (rows[a][0], rows[b][0]) for a in range(len(rows)) for b in range(a)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    for _ in rows:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    return [r for r in rows if least[r[0]] == r[0]]  # rows that repeat a doc_id are one document


def _masked(text):
    text = re.sub(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "[EMAIL]", text)
    return text.replace("4111 1111 1111 1111", "[CARD]")


def _root(grows, goal):
    """Where a growing function passes ``goal``, or a very large number."""
    low, high = 0.0, 1e30
    if grows(high) <= goal * (1 + 1e-13):
        return high
    for _ in range(300):
        middle = (low * high) ** 0.5 if low else high / 1e3
        low, high = (middle, high) if grows(middle) < goal else (low, middle)
    return high


def _raked(table, shares, tokens):
    """Probabilities of the cells, at most one, that keep ``tokens`` in the proportion of ``shares``, as far as names have so many."""
    goals = []
    for d, share in enumerate(shares):
        have = table.sum(tuple({0, 1, 2} - {d}))
        level = _root(lambda c: np.minimum(have, c * share).sum(), tokens)
        goals.append(np.minimum(have, level * share))
    factors = [np.ones(len(g)) for g in goals]
    for _ in range(60):
        for d in range(3):
            others = np.moveaxis(np.ones(table.shape), d, 0).copy()
            rest = [factors[e] for e in range(3) if e != d]
            others *= rest[0][None, :, None] * rest[1][None, None, :]
            sizes = np.moveaxis(table, d, 0)
            factors[d] = np.array([_root(lambda f: (np.minimum(1, f * o) * n).sum(), g) for o, n, g in zip(others, sizes, goals[d], strict=True)])
    return np.minimum(1, factors[0][:, None, None] * factors[1][None, :, None] * factors[2][None, None, :])


def _mixed(rows, temper=0.85):
    cells = [(r[3] or "unknown", r[2] or "unknown", next(n for n, p in mixing.TOPICS if re.search(p, r[1] or ""))) for r in rows]
    sizes = np.array([len(_words(r[1])) for r in rows], float)
    names = [sorted({c[d] for c, n in zip(cells, sizes, strict=True) if n}) for d in range(3)]
    at = np.array([[names[d].index(c[d]) if c[d] in names[d] else 0 for d in range(3)] for c in cells])
    table = np.zeros([len(n) for n in names])
    np.add.at(table, tuple(at.T), sizes)
    weight = _raked(table, [table.sum(tuple({0, 1, 2} - {d})) ** temper for d in range(3)], 0.5 * table.sum())
    kept = []
    for r, place, n in zip(rows, at, sizes, strict=True):
        first = xxhash.xxh64_intdigest(int(r[0]).to_bytes(8, "little"), 42)
        draw = xxhash.xxh64_intdigest((r[1] or "").encode(), first)
        final = xxhash.xxh64_intdigest((13).to_bytes(4, "little"), xxhash.xxh64_intdigest(draw.to_bytes(8, "little"), 42))
        chance = final % 2**53 / 2**53
        probability = weight[tuple(place)] if n else 1.0
        assert abs(chance - probability) > 1e-5  # else a matter of rounding
        if chance < probability:
            kept.append(r)
    return kept


def test_pipeline_equals_plain_stages(spark, folder):
    rows, toxic = _documents()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.fitted(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    clean = [r for r in rows if model.score([r[1] or ""])[0] < 0.5]
    assert len({r[0] for r in rows} - {r[0] for r in clean} ^ toxic) <= 6
    single = _near_copies_gone(clean)
    assert len(single) < len(clean) - 60
    plain = [(r[0], None if r[1] is None else _masked(r[1]), *r[2:]) for r in single]
    assert any("[EMAIL]" in (r[1] or "") for r in plain)
    chosen = _mixed(plain)
    assert 0 < len(chosen) < len(plain)
    encoding = byte_bpe.Vocabulary().encoding()
    want = []
    for r in chosen:
        ids = np.array(encoding.encode_ordinary(r[1] or ""), "<u4").tobytes()
        digests = [hashlib.sha256(x).hexdigest() for x in (ids, (r[1] or "").encode())]
        want.append((r[0], r[3], r[2], len(ids) // 4, *digests, ids))
    got = [tuple(r)[:-1] + (bytes(r["ids"]),) for r in corpus_pipeline.run(spark, folder).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_stages_keep_the_columns_of_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).dtypes == docs.dtypes


def test_pipeline_without_documents(spark, tmp_path):
    spark.createDataFrame([], LAYOUT).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
