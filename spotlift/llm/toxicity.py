"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A text is read as passages of ``passage`` words. Every character n-gram of a passage, and every whole word, has an
embedding, picked by a hash; the passage's vector is their average, and a linear softmax over two classes gives its
probability. A document is as toxic as its worst passage, so a few insults are not diluted by a long text. Embeddings and
softmax are trained together in numpy on a bounded sample, with the gradient going through each document's worst
passage. Misspellings share most of their n-grams with the word they were made from.

Because everything after the average is linear, scoring needs one number per n-gram: executors sum those, vectorised
over whole Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotlift.llm.labelled import fold, labelled_sample
from spotlift.llm.textkernel import U, mix

_M = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Settings:
    """``rows_per_class`` and ``most_chars`` bound the sample that is learnt from; all else scores every text alike."""

    passage: int = 32
    shortest: int = 3
    longest: int = 6
    per_word: int = 16
    slots: int = 1 << 20
    width: int = 8
    epochs: int = 10
    rate: float = 1.0
    damping: float = 1e-3
    clean_weight: float = 4.0
    least_docs: int = 4
    rows_per_class: int = 1500
    most_chars: int = 3_000_000
    folds: int = 5
    held_out: int = 0
    threshold: float = 0.5
    seed: int = 11


def passages(texts: list[str], settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every n-gram its slot and passage, for every passage its document, and what each passage's sum is divided by."""
    lowered = [" " + t.lower() + " " for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) for t in lowered])
    doc = np.repeat(np.arange(len(texts)), sizes)
    plain = points < 128
    letters = np.zeros(128, bool)
    letters[[*range(48, 58), *range(97, 123), *b"@$*"]] = True
    inside = np.where(plain, letters[np.minimum(points, 127)], True)
    values = mix(np.where(inside, points, 1).astype(U) * U(_M))
    begins = inside & ~np.concatenate([[False], inside[:-1]])
    ordinal = np.cumsum(begins)  # words so far, counted over all texts
    first_char = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    before = ordinal[first_char] - begins[first_char] if len(texts) else np.zeros(0, np.int64)
    within = np.maximum(ordinal - before[doc] - 1, 0) // settings.passage
    codes = doc * (int(within.max(initial=0)) + 1) + within
    new = np.ones(len(codes), bool)
    new[1:] = codes[1:] != codes[:-1]
    passage = np.cumsum(new) - 1
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]])) + 1
    power = np.cumprod(np.concatenate([[U(1)], np.full(len(points), U(_M))]), dtype=U)
    inverse = np.cumprod(np.concatenate([[U(1)], np.full(len(points), U(pow(_M, -1, 2**64)))]), dtype=U)
    summed = np.concatenate([[U(0)], np.cumsum(values * power[:-1], dtype=U)])
    words = mix((summed[ends] - summed[starts]) * inverse[starts] ^ U(99))
    # A word counts once in a passage, however often it is repeated there.
    fresh = np.zeros(len(starts) + 1, bool)
    fresh[1 + np.unique(mix(words ^ passage[starts].astype(U)), return_index=True)[1]] = True
    slots, homes = [], []
    rolled = values
    clean = ~inside
    broken = np.zeros(len(points), bool)  # a boundary strictly inside the n-gram
    for n in range(2, settings.longest + 1):
        rolled = rolled[:-1] * U(_M) + values[n - 1 :]
        broken = broken[:-1] | (clean[1 : len(points) - n + 2] if n > 2 else False)
        if n >= settings.shortest:
            # n - 2 inner places are checked; of the ends either may be a boundary, not both of a short one
            good = np.flatnonzero(~broken[: len(rolled)] & fresh[ordinal[n - 2 : len(points) - 1]])
            slots.append((mix(rolled[good] ^ U(n)) % U(settings.slots)).astype(np.int32))
            homes.append(passage[good + n - 1])
    first = fresh[1:]
    slots.append((words[first] % U(settings.slots)).astype(np.int32))
    homes.append(passage[starts[first]])
    slot = np.concatenate(slots) if slots else np.zeros(0, np.int32)
    home = np.concatenate(homes) if homes else np.zeros(0, np.int64)
    count = int(passage[-1]) + 1 if len(passage) else 0
    # A short passage is averaged as if blanks, which have no vector, filled it up; else a word of it would outweigh one of a long passage.
    return slot, home, doc[new], np.maximum(np.bincount(home, minlength=count), settings.passage * settings.per_word)


@dataclass
class Model:
    """One number for each n-gram slot and the softmax's offset, all as differences between the two classes."""

    slots: np.ndarray
    offset: float
    settings: Settings

    def score(self, texts: list[str]) -> np.ndarray:
        slot, home, doc, counts = passages(texts, self.settings)
        sums = np.bincount(home, weights=self.slots[slot], minlength=len(doc))
        logits = np.full(len(texts), -np.inf)
        np.maximum.at(logits, doc, sums / counts + self.offset)
        return 1 / (1 + np.exp(-np.clip(logits, -500, 500)))


def _bags(texts: list[str], settings: Settings, most: int = 1 << 17) -> list[np.ndarray]:
    """Distinct n-grams of every passage with their shares of its sum, taken up ``most`` characters at a time to keep the driver small.

    The last array counts the documents of every slot; n-grams of few documents say nothing and stay out.
    """
    found, low, n_passages = [], 0, 0
    in_docs = np.zeros(settings.slots, np.int32)
    while low < len(texts):
        high, size = low, 0
        while high < len(texts) and (high == low or size < most):
            size += len(texts[high])
            high += 1
        slot, home, doc, counts = passages(texts[low:high], settings)
        pairs, uses = np.unique(home.astype(np.int64) * settings.slots + slot, return_counts=True)
        home, slot = pairs // settings.slots, pairs % settings.slots
        in_docs += np.bincount(np.unique(doc[home] * settings.slots + slot) % settings.slots, minlength=settings.slots).astype(np.int32)
        weights = (uses / counts[home]).astype(np.float32)
        found.append([slot.astype(np.int32), (home + n_passages).astype(np.int32), weights, (doc + low).astype(np.int32)])
        low, n_passages = high, n_passages + len(doc)
    common = in_docs >= min(settings.least_docs, len(texts))
    for part in found:
        stays = common[part[0]]
        part[:3] = [x[stays] for x in part[:3]]
    return [*(np.concatenate([part[i] for part in found]) for i in range(4)), common]


def train(texts: list[str], marks: list[int], settings: Settings = Settings()) -> Model:
    """Without both labels every text gets the share of the only one, or one half without any."""
    wanted = np.array(marks, float)
    if not len(wanted) or wanted.min() == wanted.max():
        share = float(np.clip(wanted.mean(), 0.01, 0.99)) if len(wanted) else 0.5
        return Model(np.zeros(settings.slots, np.float32), float(np.log(share / (1 - share))), settings)
    rng = np.random.default_rng(settings.seed)
    slot, home, weights, doc, common = _bags(texts, settings)
    border = np.searchsorted(home, np.arange(len(doc) + 1))
    by_doc = np.searchsorted(doc, np.arange(len(texts) + 1))
    vectors = rng.uniform(-0.01, 0.01, (settings.slots, settings.width)).astype(np.float32)
    linear = rng.uniform(-0.5, 0.5, (settings.width, 2)).astype(np.float32)
    offset = np.zeros(2, np.float32)
    square_v, square_l = np.full(settings.slots, settings.damping, np.float32), 1e-3
    passage_target = wanted[doc]
    for epoch in range(settings.epochs):
        # The worst passage speaks for its document; clean documents are clean in every passage.
        single, logit = vectors @ (linear[:, 1] - linear[:, 0]), np.zeros(len(doc))
        for low in range(0, len(home), 1 << 19):
            some = slice(low, low + (1 << 19))
            logit += np.bincount(home[some], weights=weights[some] * single[slot[some]], minlength=len(doc))
        worst = np.array([a + int(np.argmax(logit[a:b])) for a, b in zip(by_doc[:-1], by_doc[1:], strict=True)])
        some = rng.random(len(doc)) < 0.25
        chosen = np.flatnonzero((some & (passage_target == 0)) | np.isin(np.arange(len(doc)), worst)) if epoch > 1 else np.arange(len(doc))
        rng.shuffle(chosen)
        for low in range(0, len(chosen), 128):
            rows = chosen[low : low + 128]
            spans = [np.arange(border[r], border[r + 1]) for r in rows]
            at = np.concatenate(spans)
            owner = np.repeat(np.arange(len(rows)), [len(s) for s in spans])
            bag = np.zeros((len(rows), settings.width), np.float32)
            taken = vectors[slot[at]] * weights[at, None]
            for k in range(settings.width):
                bag[:, k] = np.bincount(owner, weights=taken[:, k], minlength=len(rows))
            z = bag @ linear + offset
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            error = p - np.eye(2, dtype=np.float32)[passage_target[rows].astype(int)]
            error = (error * np.where(passage_target[rows] == 0, settings.clean_weight, 1)[:, None]).astype(np.float32)
            back = error @ linear.T
            grad_l = bag.T @ error / len(rows)
            # Steps shrink as a slot's gradients add up; the damping keeps slots of few documents from moving far.
            names, place = np.unique(slot[at], return_inverse=True)
            grad_v = np.empty((len(names), settings.width), np.float32)
            for k in range(settings.width):
                grad_v[:, k] = np.bincount(place, weights=back[owner, k] * weights[at], minlength=len(names))
            square_v[names] += (grad_v**2).mean(axis=1)
            vectors[names] -= settings.rate * grad_v / np.sqrt(square_v[names])[:, None]
            square_l += float((grad_l**2).mean())
            linear -= settings.rate * grad_l / np.sqrt(square_l)
            offset -= settings.rate * 0.1 * error.mean(axis=0)
    difference = linear[:, 1] - linear[:, 0]
    return Model(np.where(common, vectors @ difference, 0).astype(np.float32), float(offset[1] - offset[0]), settings)


def _scores(model: Model, texts: pa.Array, most: int = 1 << 18) -> np.ndarray:
    """Scores of a column of texts, ``most`` characters or one longer text at a time."""
    found, low = [], 0
    while low < len(texts):
        size, part = 0, []
        while low < len(texts) and (not part or size < most):
            part.append(texts[low].as_py() or "")
            size += len(part[-1])
            low += 1
        found.append(model.score(part))
    return np.concatenate(found) if found else np.zeros(0)


def _rating(model: Model):
    """The score of a text column as a vectorised function."""

    @F.arrow_udf("double")
    def rating(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(_scores(model, texts), pa.float64())
            del texts
            pa.default_memory_pool().release_unused()  # else an idle worker keeps its largest batch

    return rating


def fitted(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    usable = fold("doc_id", settings.folds) != settings.held_out
    return train(*labelled_sample(docs, labels, "toxic", usable, settings.rows_per_class, settings.most_chars), settings)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; a null or empty text gets the score of an empty bag."""
    settings = model.settings
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.select("doc_id", _rating(model)("text").alias("score")).select(
        "doc_id",
        F.coalesce(fold("doc_id", settings.folds) == settings.held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= settings.threshold).cast("int").alias("predicted"),
    )


def clean(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows that the model calls toxic; all columns stay, whatever their names.

    Only texts go to Python and only scores come back; rows wait in the JVM, where their queue can spill.
    """
    text = next(n for n in docs.columns if n.lower() == "text")
    column = F.col(f"`{text.replace('`', '``')}`").cast("string")
    return docs.where(_rating(model)(column) < model.settings.threshold)
