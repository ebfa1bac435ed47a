"""Repeated passages over a corpus: phrases cut by content, looked up in an index of all documents.

This stands in for greedy relative Lempel-Ziv parsing, which it is not. A greedy parse takes the longest match from one word on and starts
anew behind it, so the factors of a document depend on one another, and each document would have to meet every reference block: copies of the
corpus as many as blocks. Phrases cut by content can be looked up apart, by one join. Passages found are the same, as single windows are
compared wherever phrases differ.

Words are cut into phrases by content: each window of ``window`` words belongs to the smallest hash of the ``gram``-word
sequences in it, and a phrase is a run of windows of one document that share this hash. Equal passages are therefore
cut alike, wherever they stand. The index holds every phrase of every document, spread by the phrase's hash; a document's
phrases are looked up by one join on that hash.

* A phrase that an earlier document holds word for word is a repeat as a whole.
* Where a phrase's hash occurs with other words around it a repeat may end inside the phrase. Only there are single
  windows looked up, one representative for each different phrase; what is found goes for all places of the phrase in the
  representative's document.

Word windows of 50 are what contract and licence lines repeat by; every window has exactly one phrase, so none is missed.
Hashes of phrases and windows have 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotlift.llm.shared import written
from spotlift.llm.textkernel import U, WordHasher, column_bytes, mix, row_slices, windows

_FACTORS = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_KEYS = ["doc_id", "text_key"]


@dataclass(frozen=True)
class Parsing:
    """``window`` words make a passage; ``gram`` words make the hashes that cut phrases, about two for each window."""

    window: int = 50
    gram: int = 10


def _sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    length = 1
    while length * 2 <= size:
        values = np.minimum(values[:-length], values[length:]) if len(values) > length else values[:0]
        length *= 2
    rest = size - length
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


class _Prefix:
    """Hashes of any range of words, two of 64 bits each."""

    def __init__(self, hashes: np.ndarray):
        self.sums, self.scales = [], []
        for factor in _FACTORS:
            n = len(hashes)
            power = np.cumprod(np.concatenate([[U(1)], np.full(n, U(factor))]), dtype=U)
            inverse = np.cumprod(np.concatenate([[U(1)], np.full(n, U(pow(factor, -1, 2**64)))]), dtype=U)
            self.sums.append(np.concatenate([[U(0)], np.cumsum(mix(hashes ^ U(factor)) * power[:n], dtype=U)]))
            self.scales.append(inverse)

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        return [mix((s[ends] - s[starts]) * v[starts] + (ends - starts).astype(U)) for s, v in zip(self.sums, self.scales, strict=True)]


def _phrases(config: Parsing):
    size, gram = config.window, config.gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            ids, keys = batch.column("doc_id").cast(pa.int64()).to_numpy(), batch.column("text_key").to_numpy()
            for low, high in row_slices(offsets):
                words = hasher.words(data, offsets[low : high + 1])
                least = _sliding_min(windows(words.hashes, gram, _FACTORS[0]), size - gram + 1)
                if not len(least):
                    continue
                row = np.repeat(np.arange(high - low), np.diff(words.bounds))
                at = np.flatnonzero(np.arange(len(least)) + size <= words.bounds[row[: len(least)] + 1])
                if not len(at):
                    continue
                new = np.ones(len(at), bool)
                new[1:] = (least[at[1:]] != least[at[:-1]]) | (row[at[1:]] != row[at[:-1]])
                first = np.flatnonzero(new)
                counts = np.diff(np.append(first, len(at)))
                starts = at[first]
                a, b = _Prefix(words.hashes).ranges(starts, starts + counts + size - 1)
                rows = row[starts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[low + rows]),
                        pa.array(keys[low + rows]),
                        pa.array((starts - words.bounds[rows]).astype(np.int64)),
                        pa.array(counts.astype(np.int64)),
                        pa.array(least[starts].view(np.int64)),
                        pa.array(a.view(np.int64)),
                        pa.array(b.view(np.int64)),
                    ],
                    ["doc_id", "text_key", "start", "count", "anchor", "hash_a", "hash_b"],
                )

    return run


def _windows(config: Parsing):
    """Hashes of the single windows of the listed phrases; ``place`` has the phrase's start above and the window's offset in the lower 32 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            ids, keys = batch.column("doc_id").to_numpy(), batch.column("text_key").to_numpy()
            lists = batch.column("phrases")
            for i in range(batch.num_rows):
                words = hasher.words(data, offsets[i : i + 2])
                prefix = _Prefix(words.hashes)
                spans = lists[i].values
                starts = spans.field("start").to_numpy()
                counts = spans.field("count").to_numpy()
                inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                phrase = np.repeat(starts, counts)
                a, b = prefix.ranges(phrase + inside, phrase + inside + config.window)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(phrase), ids[i])),
                        pa.array(np.full(len(phrase), keys[i])),
                        pa.array(phrase.astype(np.int64) << 32 | inside),
                        pa.array(a.view(np.int64)),
                        pa.array(b.view(np.int64)),
                    ],
                    ["doc_id", "text_key", "place", "hash_a", "hash_b"],
                )

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def factors(docs: DataFrame, config: Parsing = Parsing()) -> DataFrame:
    """``doc_id, text_key, start, end``: ranges of words whose windows all start in a document with a smaller ``doc_id`` as well.

    Whole phrases and single windows, not yet joined up; ``text_key`` is a hash of the text and tells rows of one ``doc_id`` apart. Rows
    without ``doc_id`` take no part.
    """
    size = config.window
    texts = _keyed(docs).where("doc_id IS NOT NULL")
    phrases = written(
        texts.mapInArrow(
            _phrases(config), "doc_id long, text_key long, start long, count long, anchor long, hash_a long, hash_b long"
        ),
        "phrases",
    )
    same = ["anchor", "hash_a", "hash_b"]
    index = phrases.groupBy(*same).agg(
        F.min(F.struct("doc_id", "text_key", "start", "count")).alias("first"), F.count("*").alias("n")
    )
    index = written(index, "phrase-index")
    # Word for word as in an earlier document, or again in the first one; only the latter keep the representative's place.
    repeated = index.where("n > 1").select(*same, "first.doc_id", "first.text_key", "first.start").toDF(*same, "first_doc", "first_key", "first_start")
    places = phrases.join(repeated, same).where("doc_id >= first_doc").selectExpr(
        "doc_id", "text_key", "start", "count", "IF(doc_id = first_doc, first_key, NULL) AS first_key", "IF(doc_id = first_doc, first_start, NULL) AS first_start"
    )
    places = written(places, "repeated-phrases")
    whole = places.where("first_key IS NULL").selectExpr("doc_id", "text_key", "start", f"start + count + {size - 1} AS end")
    again = places.where("first_key IS NOT NULL").selectExpr(
        "doc_id", "first_key AS text_key", "first_start AS phrase", "text_key AS again_key", "start AS again"
    ).distinct()
    # The same anchor with other words around: factors end in these phrases.
    uneven = index.groupBy("anchor").agg(
        F.min("first.doc_id").alias("least"), F.max("first.doc_id").alias("most")
    ).where("most > least").select("anchor")
    ends = index.join(uneven, "anchor", "left_semi").select("first.*")
    ends = ends.groupBy(*_KEYS).agg(F.collect_list(F.struct("start", "count")).alias("phrases"))
    single = written(
        texts.join(ends, _KEYS).mapInArrow(_windows(config), "doc_id long, text_key long, place long, hash_a long, hash_b long"),
        "windows",
    )
    earliest = single.groupBy("hash_a", "hash_b").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last"))
    earliest = earliest.where("last > first_doc").drop("last")
    found = single.join(earliest, ["hash_a", "hash_b"]).where("doc_id > first_doc").selectExpr(
        "doc_id", "text_key", "shiftright(place, 32) AS phrase", "place & 4294967295 AS inside"
    )
    # What holds for a representative holds wherever its document has the phrase, in all its texts; a phrase that occurs once has no place.
    partly = found.join(again, ["doc_id", "text_key", "phrase"], "left").selectExpr(
        "doc_id", "coalesce(again_key, text_key) AS text_key", "coalesce(again, phrase) + inside AS start"
    ).selectExpr("doc_id", "text_key", "start", f"start + {size} AS end")
    return whole.unionByName(partly)


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        spans = batch.column("spans")
        totals, removed, kept = [], [], []
        for i in range(batch.num_rows):
            words = texts[i].as_buffer().to_pybytes().split()  # splits at 0x20 and 0x09-0x0D
            totals.append(len(words))
            if spans[i].is_valid:
                steps = np.zeros(len(words) + 1, np.int64)
                np.add.at(steps, spans[i].values.field("start").to_numpy(), 1)
                np.add.at(steps, spans[i].values.field("end").to_numpy(), -1)
                stays = np.cumsum(steps[:-1]) == 0
                words = [w for w, s in zip(words, stays.tolist(), strict=True) if s]
            removed.append(totals[-1] - len(words))
            kept.append(b" ".join(words))
            if i % 256 == 255 or i == batch.num_rows - 1:
                low = i + 1 - len(totals)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, len(totals)),
                        batch.column("text_key").slice(low, len(totals)),
                        pa.array(totals, pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "text_key", "n_words", "n_removed", "kept_text"],
                )
                totals, removed, kept = [], [], []


def without_repeats(docs: DataFrame, config: Parsing = Parsing()) -> DataFrame:
    """``doc_id, text_key, n_words, n_removed, kept_text`` for every row: the words left, joined by one space.

    A word goes if a window of ``config.window`` words around it also starts in a document with a smaller ``doc_id``. All windows are judged on
    the input. A null or empty text has no words. Rows that repeat a ``doc_id`` are judged against smaller ids only; a row without
    ``doc_id`` keeps all its words.
    """
    spans = factors(docs, config).groupBy(*_KEYS).agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    rows = _keyed(docs).join(spans, _KEYS, "left")
    return rows.mapInArrow(_without, "doc_id long, text_key long, n_words long, n_removed long, kept_text string")
