"""Quality classifier as a sparse rule ensemble.

Texts are reduced to statistics of their bytes, words and lines, vectorised over Arrow batches. Small trees are grown on a
bounded labelled sample; every path from a root becomes a rule, a conjunction of comparisons; a logistic regression with a lasso
penalty keeps few of the rules. The kept rules are compiled into a Spark column expression, so scoring runs inside the JVM once the
statistics are there, and the model can be read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotlift.llm.labelled import fold, labelled_sample
from spotlift.llm.textkernel import WordHasher, column_bytes, mix, row_slices, U

#: Statistics of a text, in the order of the arrays below. Shares are of bytes unless the name says words or lines.
STATISTICS = (
    "n_bytes", "n_words", "mean_word", "longest_word", "upper_share", "digit_share", "symbol_share", "stop_share",
    "comma_share", "bang_share", "bar_share", "blank_share", "foreign_share", "distinct_words", "repeated_next",
    "top_word", "lines_per_word", "distinct_lines", "distinct_triples", "capital_words",
)


@dataclass(frozen=True)
class Settings:
    """``rows_per_class`` and ``most_chars`` bound the sample that is learnt from; all else holds for every text."""

    rows_per_class: int = 3000
    most_chars: int = 12_000_000
    trees: int = 60
    depth: int = 3
    cuts: int = 24
    leaf: int = 8
    penalty: float = 2e-3
    steps: int = 400
    folds: int = 4
    held_out: int = 2
    threshold: float = 0.7
    seed: int = 5


def _classes() -> np.ndarray:
    """For every byte the kinds it belongs to."""
    table = np.zeros((7, 256), bool)
    table[0, 65:91] = True
    table[1, 48:58] = True
    table[2, [c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:!?'\"-()|"]] = True
    table[3, [ord(c) for c in ".?"]] = True
    table[4, [ord(c) for c in ",;:"]] = True
    table[5, ord("!")] = True
    table[6, ord("|")] = True
    return table


class Statistician:
    def __init__(self):
        self.hasher, self.kinds = WordHasher(), _classes()

    def rows(self, column: pa.Array, most: int = 256) -> np.ndarray:
        """Statistics of every text; only ``most`` texts are copied at a time."""
        parts = []
        for at in range(0, len(column), most):
            data, offsets = column_bytes(column.slice(at, most))
            parts += [self._slice(data, offsets[low : high + 1]) for low, high in row_slices(offsets)]
        return np.concatenate(parts) if parts else np.zeros((0, len(STATISTICS)))

    def _slice(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        part, cuts = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        words = self.hasher.words(data, offsets)
        sizes, counts = np.diff(cuts), np.diff(words.bounds)
        per_byte, per_word = np.maximum(sizes, 1), np.maximum(counts, 1)

        def share(flags: np.ndarray) -> np.ndarray:
            summed = np.concatenate([[0], np.cumsum(flags)])
            return (summed[cuts[1:]] - summed[cuts[:-1]]) / per_byte

        shares = [share(kind[part]) for kind in self.kinds]
        lines = part == 10
        n_lines = np.concatenate([[0], np.cumsum(lines)])
        n_lines = n_lines[cuts[1:]] - n_lines[cuts[:-1]] + 1
        lengths = words.ends - words.starts
        capitals = self.kinds[0][part[words.starts]] if len(words.starts) else np.zeros(0, bool)
        capitals = np.concatenate([[0], np.cumsum(capitals)])
        loose = np.zeros((len(sizes), 7))
        breaks = np.flatnonzero(lines)
        for i, (a, b) in enumerate(zip(words.bounds[:-1], words.bounds[1:], strict=True)):
            if b == a:
                continue
            own = words.hashes[a:b]
            _, uses = np.unique(own, return_counts=True)
            loose[i, 0] = lengths[a:b].max()
            loose[i, 1] = len(uses) / (b - a)
            loose[i, 2] = (own[1:] == own[:-1]).mean() if b - a > 1 else 0
            loose[i, 3] = uses.max() / (b - a)
            # A line's hash is the sum of its mixed words' hashes with their places.
            inner = breaks[np.searchsorted(breaks, cuts[i]) : np.searchsorted(breaks, cuts[i + 1])]
            first = np.unique(np.searchsorted(words.starts[a:b], np.concatenate([[cuts[i]], inner])))
            first = first[first < b - a]
            place = np.arange(b - a) - np.repeat(first, np.diff(np.append(first, b - a)))
            sums = np.add.reduceat(mix(own + place.astype(U) * U(0x9E3779B97F4A7C15)), first)
            loose[i, 4] = len(np.unique(sums)) / len(sums)
            triples = own[2:] * U(9) + own[1:-1] * U(3) + own[:-2]
            loose[i, 5] = len(np.unique(triples)) / len(triples) if len(triples) else 1
        columns = [
            sizes, counts, (np.add.reduceat(np.append(lengths, 0), np.minimum(words.bounds[:-1], len(lengths))) * (counts > 0)) / per_word,
            loose[:, 0], shares[0], shares[1], shares[2], shares[3], shares[4], shares[5], shares[6],
            1 - (share(~self.hasher.space[part])), share(part >= 128), loose[:, 1], loose[:, 2], loose[:, 3],
            n_lines / per_word, loose[:, 4], loose[:, 5], (capitals[words.bounds[1:]] - capitals[words.bounds[:-1]]) / per_word,
        ]
        return np.column_stack(columns).astype(float)


#: A comparison: statistic, whether it is at most (else above), limit. A rule is a set of them.
Comparison = tuple[int, bool, float]


@dataclass
class Model:
    rules: list[tuple[tuple[Comparison, ...], float]]
    offset: float
    settings: Settings

    def score(self, stats: np.ndarray) -> np.ndarray:
        z = np.full(len(stats), self.offset)
        for rule, weight in self.rules:
            z += weight * _holds(rule, stats)
        return 1 / (1 + np.exp(-z))

    def column(self, prefix: str = "") -> Column:
        """The score as an expression over columns named as the statistics."""

        def compare(c: Comparison) -> Column:
            value = F.col(prefix + STATISTICS[c[0]])
            return value <= F.lit(c[2]) if c[1] else value > F.lit(c[2])

        total = F.lit(self.offset)
        for rule, weight in self.rules:
            condition = compare(rule[0])
            for c in rule[1:]:
                condition = condition & compare(c)
            total = total + F.when(condition, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _holds(rule: tuple[Comparison, ...], stats: np.ndarray) -> np.ndarray:
    held = np.ones(len(stats), bool)
    for stat, below, limit in rule:
        held &= stats[:, stat] <= limit if below else stats[:, stat] > limit
    return held


def _grow(stats, target, rows, depth, settings, rng, path, rules) -> None:
    """A regression tree on the residual ``target``; every inner path goes to ``rules``."""
    if depth == 0 or len(rows) < 2 * settings.leaf:
        return
    best = (1e-9, 0, 0.0)
    total = target[rows].sum()
    for stat in rng.choice(stats.shape[1], max(1, stats.shape[1] // 2), replace=False):
        values = stats[rows, stat]
        for limit in np.unique(np.quantile(values, np.linspace(0, 1, settings.cuts + 2)[1:-1])):
            low = values <= limit
            n = int(low.sum())
            if settings.leaf <= n <= len(rows) - settings.leaf:
                s = target[rows][low].sum()
                gain = s * s / n + (total - s) ** 2 / (len(rows) - n) - total**2 / len(rows)
                if gain > best[0]:
                    best = (gain, int(stat), float(limit))
    if best[0] <= 1e-9:
        return
    _, stat, limit = best
    for below in (True, False):
        step = (*path, (stat, below, limit))
        rules.add(tuple(sorted(step)))
        side = stats[rows, stat] <= limit
        _grow(stats, target, rows[side == below], depth - 1, settings, rng, step, rules)


def train(stats: np.ndarray, marks: list[int], settings: Settings = Settings()) -> Model:
    """Without both labels every text gets the share of the only one, or one half without any."""
    y = np.array(marks, float)
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
        return Model([], float(np.log(share / (1 - share))), settings)
    rng = np.random.default_rng(settings.seed)
    found: set[tuple[Comparison, ...]] = set()
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for _ in range(settings.trees):
        rows = rng.choice(len(y), min(len(y), 1500), replace=False)
        _grow(stats, (y - y.mean()) * balance, rows, settings.depth, settings, rng, (), found)
    rules = sorted(found)
    held = np.column_stack([_holds(r, stats) for r in rules]).astype(float)
    _, first = np.unique(held, axis=1, return_index=True)  # rules that always agree count once
    first.sort()
    rules, held = [rules[i] for i in first], held[:, first]
    centre, spread = held.mean(axis=0), np.maximum(held.std(axis=0), 1e-6)
    x = (held - centre) / spread
    weights, ahead = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    offset, t = float(np.log(y.mean() / (1 - y.mean()))), 1.0
    step = 4.0 / (np.linalg.norm(x, 2) ** 2 / len(y) + 1)
    for _ in range(settings.steps):  # accelerated proximal gradient
        error = 1 / (1 + np.exp(-(x @ ahead + offset))) - y
        moved = ahead - step * (x.T @ error) / len(y)
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * settings.penalty, 0)
        offset -= step * float(error.mean())
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, weights, t = new + (t - 1) / t_next * (new - weights), new, t_next
    kept = np.flatnonzero(np.abs(weights) > 1e-9)
    real = weights / spread
    return Model([(rules[i], float(real[i])) for i in kept], float(offset - (real * centre)[kept].sum()), settings)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    statistician = Statistician()
    for batch in batches:
        stats = statistician.rows(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(stats[:, i]) for i in range(len(STATISTICS))]], ["doc_id", *STATISTICS]
        )
        del batch, stats
        pa.default_memory_pool().release_unused()  # else an idle worker keeps its largest batch


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of every whole text; a null text counts as the empty one."""
    layout = "doc_id long, " + ", ".join(f"{name} double" for name in STATISTICS)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_measure, layout)


def fitted(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    usable = fold("doc_id", settings.folds) != settings.held_out
    texts, marks = labelled_sample(docs, labels, "quality", usable, settings.rows_per_class, settings.most_chars)
    stats = Statistician().rows(pa.array(texts, pa.string())) if texts else np.zeros((0, len(STATISTICS)))
    return train(stats, marks, settings)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; the empty text is scored by its statistics like any other."""
    settings = model.settings
    return statistics(docs).select(
        "doc_id",
        F.coalesce(fold("doc_id", settings.folds) == settings.held_out, F.lit(False)).alias("held_out"),
        model.column().alias("score"),
    ).withColumn("predicted", (F.col("score") >= settings.threshold).cast("int"))
