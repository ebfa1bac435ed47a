"""The training-data operators against brute force on small tables, with nulls, empty texts, ties, repeats and no rows."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spotlift.llm import (
    byte_bpe,
    components,
    embedding_dedup,
    minhash_dedup,
    mixing,
    packed_tokens,
    pii,
    quality,
    substring_dedup,
    topk_search,
    toxicity,
)

WORDS = [f"w{i}" for i in range(400)]


def _texts() -> list[tuple[int, str | None]]:
    rng = np.random.default_rng(1)
    base = [" ".join(rng.choice(WORDS, 120)) for _ in range(6)]
    near = base[0].split()
    near[60] = "changed"
    shared = " ".join(rng.choice(WORDS, 70))
    rows = [*base, base[1].upper(), " ".join(near), f"{base[2]} {shared} tail", f"head {shared}\n{base[3]}"]
    rows += [None, "", " \t\n", "one two", "ONE two", "x" * 3000, "same " * 200, "same " * 90, base[4]]
    return list(enumerate(rows))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}", i, "clash") for i, t in _texts()]
    rows.append((4, _texts()[4][1], "en", "s1", 4, "clash"))  # a repeated row
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score long, ids string")


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(50, 40), (41, 50), (60, 60), (None, 3)], "u long, v long")
    got = {r["node"]: r["component"] for r in components.connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(31)}, 40: 40, 41: 40, 50: 40, 60: 60}


@pytest.mark.parametrize("config", [minhash_dedup.MinHash(), minhash_dedup.MinHash(bucket_block=2, group_block=100)])
def test_minhash(docs, config):
    sets = {}
    for i, t in _texts():
        words = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets[i] = {tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))} if words else set()
    least = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    least[a] = min(least[a], least[b])
    got = {r["doc_id"]: tuple(r)[1:] for r in minhash_dedup.near_duplicates(docs, config).collect()}
    assert got == {i: (len(sets[i]), least[i], least[i] == i) for i in sets}


def test_minhash_keeps_one_of_a_group_and_all_columns(docs, none):
    kept = minhash_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    assert {6, 7, 14, 18}.isdisjoint(r["doc_id"] for r in kept.collect())
    assert minhash_dedup.near_duplicates(none).count() == 0


def test_repeats(docs, none):
    texts = dict(_texts())
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in texts.items()}
    first = {}
    for i in sorted(words):
        for j in range(len(words[i]) - 49):
            first.setdefault(tuple(words[i][j : j + 50]), i)
    want = {}
    for i, w in words.items():
        gone = {k for j in range(len(w) - 49) if first[tuple(w[j : j + 50])] < i for k in range(j, j + 50)}
        want[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    rows = substring_dedup.without_repeats(docs).collect()
    assert len(rows) == len(texts) + 1
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in rows} == want
    assert sum(w[1] for w in want.values()) > 200
    assert substring_dedup.without_repeats(none).count() == 0


def test_repeats_within_a_later_document(spark):
    """Passages that occur several times in the representative's document, and in another text of the same doc_id."""
    rng = np.random.default_rng(8)
    shared, before, after, between = (list(rng.choice(WORDS, n)) for n in (60, 60, 60, 30))
    passage = before + shared + after
    texts = [(1, shared), (2, passage + between + passage), (2, between + passage + between + passage), (3, passage), (3, passage)]
    first = {}
    for i, w in texts:
        for j in range(len(w) - 49):
            first.setdefault(tuple(w[j : j + 50]), i)
    want = []
    for i, w in texts:
        gone = {k for j in range(len(w) - 49) if first[tuple(w[j : j + 50])] < i for k in range(j, j + 50)}
        want.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in texts], "doc_id long, text string")
    got = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in substring_dedup.without_repeats(frame).collect()]
    assert sorted(got) == sorted(want)
    assert [w[2] for w in want] == [0, 120, 120, 180, 180]


def _vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(30, 8))
    rows = [(i, [float(x) for x in v], i % 2) for i, v in enumerate(base)]
    rows += [(100 + i, [float(x) for x in base[0] + rng.normal(size=8) * 0.04], 0) for i in range(25)]
    rows += [(200, rows[1][1], 1), (200, rows[1][1], 1), (201, [2 * x for x in rows[2][1]], 0)]
    rows += [(300, None, 0), (301, [0.0] * 8, 0), (302, [float("nan")] * 8, 0), (303, [1.0, None], 0), (304, rows[0][1], None), (None, rows[0][1], 0)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


@pytest.mark.parametrize("config", [embedding_dedup.RangeJoin(), embedding_dedup.RangeJoin(cell=8, block=6, pivots=10)])
def test_embedding_links(spark, config):
    rows, frame = _vectors(spark)
    good = [r for r in rows if r[0] is not None and r[0] < 300]
    unit = np.array([r[1] for r in good]) / np.linalg.norm([r[1] for r in good], axis=1, keepdims=True)
    labels, ids = np.array([r[2] for r in good]), np.array([r[0] for r in good])
    linked = (unit @ unit.T >= config.cosine) & (labels[:, None] == labels)
    np.fill_diagonal(linked, False)
    least = ids.copy()
    for _ in ids:
        least = np.array([min([least[i], *least[linked[i] | (ids == ids[i])]]) for i in range(len(ids))])
    want = sorted((int(i), int(n), int(c), bool(i == c)) for i, n, c in zip(ids, linked.sum(1), least, strict=True))
    got = embedding_dedup.near_duplicates(frame, config).collect()
    assert len(got) == len(rows)
    assert sorted(tuple(r) for r in got if r["vec_id"] is not None and r["vec_id"] < 300) == want
    assert all(r["n_links"] == 0 and r["kept"] for r in got if r["vec_id"] is None or r["vec_id"] >= 300)
    assert embedding_dedup.near_duplicates(frame.limit(0), config).count() == 0


@pytest.mark.parametrize("config", [topk_search.Search(), topk_search.Search(head=8, block=7, queries=2, leading=2), topk_search.Search(head=8, block=7, queries=1, ranges=3)])
def test_top_k(spark, config):
    rows, frame = _vectors(spark)
    whole = [(r[0], np.floor(np.array(r[1]) * 256)) for r in rows if r[0] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all()]
    want = []
    for q, v in whole:
        if q % 10 == 0 and q != 200:
            best = sorted((-int(v @ w), i) for i, w in whole if i != q)[:5]
            want += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    got = topk_search.top_k(frame, F.col("vec_id") % 10 == 0, config).collect()
    assert sorted(tuple(r) for r in got if r["query_id"] != 200) == sorted(want)
    assert topk_search.top_k(frame.limit(0), F.col("vec_id") % 10 == 0, config).count() == 0


def test_bpe_round_trip(docs, none):
    encoding = byte_bpe.Vocabulary().encoding()
    got = byte_bpe.decoded(byte_bpe.encoded(docs, byte_bpe.Vocabulary(part=50)))
    assert got.columns == ["doc_id", "lang", "source", "score", "n_tokens", "ids", "decoded"]
    texts = dict(_texts())
    for r in got.collect():
        text = texts[r["doc_id"]] or ""
        assert np.frombuffer(r["ids"], "<u4").tolist() == encoding.encode_ordinary(text)
        assert bytes(r["decoded"]) == text.encode()
    assert byte_bpe.round_trip(none).count() == 0


def test_token_files(docs, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packed_tokens.Layout().tokenizer)
    want, start = [], 0
    for r in sorted(docs.collect(), key=lambda r: r["doc_id"]):
        ids = np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0], "<u4")
        want.append((r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    manifest = packed_tokens.write_tokens(docs, packed_tokens.Layout(block=16, file_ids=300))
    assert sorted(tuple(r) for r in packed_tokens.read_back(manifest).collect()) == want
    file = packed_tokens.TokenFile(manifest.where("n_ids > 40").first()["path"])
    assert file.ids(0, file.n_ids)[7:39].tolist() == file.ids(7, 32).tolist()
    assert packed_tokens.written_and_read(none).count() == 0


@pytest.mark.parametrize(("most", "together"), [(1 << 20, 1 << 15), (50, 16)])
def test_pieces_encoded_together(most, together):
    """White space of all kinds at the borders of texts, bytes that are no text, and pieces that are forgotten in between."""
    rng = np.random.default_rng(3)
    marks = [" ", "  ", "\t", "\n", "\r\n", "\u0085", "\u00a0", "\u2003", "\u3000", "word", "Straße", "日本", "🙂", "it's", "42", "<|endoftext|>", "\x00", "e\u0301"]
    raw = ["".join(rng.choice(marks, rng.integers(0, 40))).encode() for _ in range(300)] + [b"", b"ok \xff\xfe bad", b" \xe2\x80 cut", b" a b \xc3"]
    encoder = packed_tokens.PieceEncoder(packed_tokens.Layout().tokenizer, most, together)
    for texts in (raw[:100], raw[100:], raw):
        offsets = np.cumsum([0, *map(len, texts)])
        ids, sizes = encoder.encode(np.frombuffer(b"".join(texts), np.uint8), offsets)
        want = [encoder.tokenizer.encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids for t in texts]
        assert sizes.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


@pytest.mark.parametrize("together", [1 << 15, 16])
def test_pieces_with_the_end_marker(together):
    """Texts that hold the marker literally, against the library as it is."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packed_tokens.Layout().tokenizer)
    rng = np.random.default_rng(6)
    marks = ["<|endoftext|>", " ", "  ", "\n", "\u3000", "word", "it's", "<|endoftext", "|>", "日本"]
    texts = ["".join(rng.choice(marks, rng.integers(0, 30))).encode() for _ in range(300)]
    encoder = packed_tokens.PieceEncoder(packed_tokens.Layout().tokenizer, together=together)
    ids, sizes = encoder.encode(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
    want = [tokenizer.encode(t.decode(), add_special_tokens=False).ids for t in texts]
    assert sizes.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]
    assert 50256 in ids


def test_pieces_around_very_long_rows(monkeypatch):
    """Rows longer than a step that share pieces, with ordinary rows between and after them."""
    monkeypatch.setattr(packed_tokens.PieceEncoder, "step", 100)
    encoder = packed_tokens.PieceEncoder(packed_tokens.Layout().tokenizer)
    ordinary = [" ".join(f"row{i}x{j}" for j in range(4)) for i in range(8)]
    long = [" ".join(f"long{j}" for j in range(60)), " ".join(f"long{j} new{j}" for j in range(60))]
    for text in (long[0], *ordinary[:4], long[1], *ordinary, long[0], *ordinary, *long):
        data = text.encode()
        ids, sizes = encoder.encode(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert (ids.tolist(), sizes.tolist()) == (want, [len(want)])


@pytest.mark.parametrize("bits", [1, 5, 8, 15, 16, 17, 31])
def test_packing(bits):
    ids = np.random.default_rng(0).integers(0, 2**bits, 1001).astype(np.uint32)
    assert packed_tokens.unpack(packed_tokens.pack(ids, bits), bits, 1001).tolist() == ids.tolist()


def test_personal_data(spark):
    texts = ["a@b.cd_x@e.fg and a@b.cd@e.fg.hi", "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.1", "4111 1111 1111 1111 4111-1111-1111-1112",
             "é😀 +1 (415) 555-2671 +12 ((", None, "", "a." * 5000 + "@b" + ".c" * 5000, "+1" * 500]
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def holds(kind, match):
        digits = [int(c) for c in match if c.isdigit() and c.isascii()]
        if kind == "ip":
            return all(int(p) <= 255 for p in match.split("."))
        if kind == "card":
            doubled = [d * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            return 14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
        return kind == "email" or 10 <= len(digits) <= 15

    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.report(frame).collect():
        spans = sorted((m.start(), n, k, m.end()) for n, (k, p) in enumerate(patterns.items()) for m in re.finditer(p, texts[r["doc_id"]] or "") if holds(k, m.group()))
        listed = ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
    more = spark.createDataFrame([(0, "iban DE89 3704 0044 0532 0130 00, ssn 123-45-6789"), (1, "DE89 3704 0044 0532 0130 01 123-45-6789")], "doc_id long, text string")
    assert [r["spans"] for r in pii.report(more).orderBy("doc_id").collect()] == ["iban:5:32,ssn:38:49", ""]
    assert [r["text"] for r in pii.masked(more).orderBy("doc_id").collect()][0] == "iban [IBAN], ssn [SSN]"


def test_raking_meets_the_targets(spark):
    rng = np.random.default_rng(5)
    rows = [(i, "word " * int(rng.integers(1, 40)) + ("7" if rng.random() < 0.3 else ""), str(rng.choice(["en", "de"], p=[0.8, 0.2])), str(rng.choice(["a", "b", "c"], p=[0.6, 0.3, 0.1]))) for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    targets = mixing.Targets(source={"a": 0.3, "b": 0.3, "c": 0.4}, lang={"en": 0.5, "de": 0.5})
    got = mixing.drawn(frame, targets).toPandas()
    got["w"] = got.probability * got.n_tokens
    total = got.w.sum()
    assert np.allclose([got.w[got.source == s].sum() / total for s in "abc"], [0.3, 0.3, 0.4], atol=1e-5)
    assert np.allclose([got.w[got.lang == s].sum() / total for s in ("en", "de")], 0.5, atol=1e-5)
    assert got.probability.max() == pytest.approx(1)
    kept = got[got.kept]
    assert abs(kept.n_tokens.sum() / total - 1) < 0.1


def test_mixing_of_many_languages(spark):
    """Shares of languages far down the ranks are met, given or tempered."""
    sizes = {f"l{i:03}": 300 - 3 * i for i in range(90)}
    rows = [(i, "word " * n, lang, "a") for i, (lang, n) in enumerate(sizes.items())]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    tempered = {k: n**0.85 for k, n in sizes.items()}
    for wanted, targets in ((tempered, mixing.Targets()), ({"l000": 1, "l089": 1}, mixing.Targets(lang={"l000": 0.5, "l089": 0.5}))):
        got = mixing.drawn(frame, targets).toPandas()
        weight = dict(zip(got.lang, got.probability * got.n_tokens, strict=True))
        assert {k: w / sum(weight.values()) for k, w in weight.items()} == pytest.approx({k: wanted.get(k, 0) / sum(wanted.values()) for k in sizes}, abs=1e-6)


def test_mixing_refuses_languages_beyond_its_bound(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LANGUAGES", 2)
    frame = spark.createDataFrame([(i, "some words", f"l{i}", "a") for i in range(3)], "doc_id long, text string, lang string, source string")
    assert mixing.drawn(frame.limit(2)).count() == 2
    with pytest.raises(ValueError, match="languages"):
        mixing.drawn(frame)


def test_mixing_of_odd_rows(docs, none):
    assert mixing.mixed(docs).columns == docs.columns
    kept = {r["doc_id"] for r in mixing.mixed(docs).collect()}
    assert {10, 11, 12} <= kept  # no words
    assert mixing.mixed(none).count() == 0


def _labelled(spark, n=400):
    rng = np.random.default_rng(9)
    insults = ["idiotic", "scumbag", "moronic"]
    rows = []
    for i in range(n):
        words = list(rng.choice(WORDS, 60)) + [f"u{int(x)}" for x in rng.integers(0, 99, 20)]
        bad = i % 3 == 0
        if bad:
            words[int(rng.integers(0, 60))] = str(rng.choice(insults))
        junk = i % 4 == 1
        rows.append((i, " ".join(w + "###" if junk else w for w in words), int(bad), int(not junk)))
    return spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame(
        [(r[0], r[3], r[2]) for r in rows], "doc_id long, quality int, toxic int"
    ), rows


def test_toxicity(spark, none):
    frame, labels, rows = _labelled(spark)
    model = toxicity.fitted(frame, labels)
    got = {r["doc_id"]: r for r in toxicity.scored(frame, model).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert {i for i, r in got.items() if r["held_out"]} == {r[0] for r in held}
    assert np.mean([got[r[0]]["predicted"] == r[2] for r in held]) > 0.95
    clean = toxicity.clean(frame.withColumn("score", frame["doc_id"]), model)
    assert clean.columns == ["doc_id", "text", "score"] and 0 < clean.count() < len(rows)
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "z" * 100000)], "doc_id long, text string")
    assert all(0 <= r["score"] <= 1 for r in toxicity.scored(odd, model).collect())
    assert toxicity.scored(none, toxicity.fitted(none, labels.limit(0))).count() == 0


def test_quality(spark, none):
    frame, labels, rows = _labelled(spark)
    model = quality.fitted(frame, labels)
    got = {r["doc_id"]: r for r in quality.scored(frame, model).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert {i for i, r in got.items() if r["held_out"]} == {r[0] for r in held}
    assert np.mean([got[r[0]]["predicted"] == r[3] for r in held]) > 0.95
    stats = quality.Statistician().rows(pa.array([r[1] for r in rows[:20]]))
    assert np.allclose(model.score(stats), [got[i]["score"] for i in range(20)])
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "z" * 100000)], "doc_id long, text string")
    assert all(0 <= r["score"] <= 1 for r in quality.scored(odd, model).collect())
    assert quality.scored(none, quality.fitted(none, labels.limit(0))).count() == 0
