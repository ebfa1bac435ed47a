"""Mixing sources to target weights by iterative proportional fitting.

Tokens are counted by source, language and topic. Raking finds a factor for every source, language and topic so that the weighted
counts meet all three targets; a document is then kept with a probability proportional to the product of its factors, drawn from
a hash, so expected tokens have the target shares exactly.

How much is kept is a target too (``kept``, a share of all tokens). A name that has less than its share of that gives all it has, and the
others fill up in proportion to their shares; a cell whose probability would pass one stays at one, and the factors are raked on
around it. So a scarce source costs no other source its documents. Without ``kept`` shares are met exactly and the scarcest cell
sets the rate.

Sources may be many: their counts and factors stay in a table, a row for each source, and a sweep is one aggregation over it.
Languages and topics are few, and only sums over them reach the driver; more than ``LANGUAGES`` languages are refused.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotlift.llm.shared import materialised

#: Topics by the first pattern that a text holds; the last takes the rest.
TOPICS = (("tabular", r" \| "), ("licence", r"(?i)licen[sc]ed?\b"), ("contact", r"@|\[EMAIL\]"), ("figures", "[0-9]"), ("prose", ""))


#: Sums of so many languages fit the driver, some 8 times the languages there are.
LANGUAGES = 1 << 16


@dataclass(frozen=True)
class Targets:
    """Wanted shares of tokens by source, language and topic.

    A dimension without shares gets the tempered ones it has, its shares raised to ``temper`` and scaled to one, which lifts
    the rare and lowers the frequent. Names without a given share have none. ``kept`` is the share of all tokens to keep, as far as
    names with a share hold as many; None keeps what exact shares allow.
    """

    source: dict[str, float] = field(default_factory=dict)
    lang: dict[str, float] = field(default_factory=dict)
    topic: dict[str, float] = field(default_factory=dict)
    temper: float = 0.85
    sweeps: int = 100
    tolerance: float = 1e-7
    seed: int = 13
    kept: float | None = None


#: What the registered query and the pipeline ask for.
CORPUS = Targets(kept=0.5)
#: The factor of a name that gives all it has.
_ALL = 1e30


def topic_of(text: Column) -> Column:
    chosen = F.lit(TOPICS[-1][0])
    for name, pattern in reversed(TOPICS[:-1]):
        chosen = F.when(text.rlike(pattern), name).otherwise(chosen)
    return chosen


def _marked(docs: DataFrame) -> DataFrame:
    """The columns that mixing reads, under its own names, and the whole row."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))

    def named(column: str) -> Column:
        return F.coalesce(docs[column].cast("string"), F.lit("unknown")) if column in docs.columns else F.lit("unknown")

    return docs.select(
        F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("row"),
        docs["doc_id"].alias("doc_id"),
        named("source").alias("source"),
        named("lang").alias("lang"),
        topic_of(text).alias("topic"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_tokens"),
        F.xxhash64(docs["doc_id"], text).alias("draw"),
    )


def _tempered(sums: dict[str, float], given: dict[str, float], temper: float) -> dict[str, float]:
    wanted = {k: given.get(k, 0.0) for k in sums} if given else {k: v**temper for k, v in sums.items()}
    total = sum(wanted.values())
    return {k: v / total for k, v in wanted.items()} if total else wanted


def _level(rest: float, weight: float) -> float:
    return rest / weight if weight else 0.0


def _filled(shares: np.ndarray, have: np.ndarray, tokens: float) -> np.ndarray:
    """``tokens`` in proportion to ``shares``, none above what it has."""
    full = np.zeros(len(have), bool)
    while True:
        level = _level(tokens - have[full].sum(), shares[~full].sum())
        more = full | (level * shares >= have)
        if (more == full).all():
            return np.where(full, have, level * shares)
        full = more


def _filled_sources(sources: DataFrame, tokens: float) -> DataFrame:
    """``sources`` with ``wanted`` as tokens in proportion to what it was, none above ``have``; a pass for each step of the level."""
    full, level = 0, _level(tokens, sources.agg(F.sum("wanted")).first()[0] or 0.0)
    while True:
        is_full = F.col("wanted") * level >= F.col("have")
        n, held, weight = sources.agg(F.count_if(is_full), F.sum(F.when(is_full, F.col("have"))), F.sum(F.when(~is_full, F.col("wanted")))).first()
        if n == full:
            return sources.withColumn("wanted", F.least("have", F.col("wanted") * level))
        full, level = n, max(level, _level(tokens - (held or 0.0), weight or 0.0))


def _doubles(values: np.ndarray) -> Column:
    """``values`` as one constant, however many."""
    return F.split(F.lit(",".join(map(repr, values.tolist()))), ",").cast("array<double>")


@dataclass
class Mix:
    """Factors: ``sources`` has ``source, factor``; languages and topics by name; ``most`` is the largest product of three."""

    sources: DataFrame
    lang: dict[str, float]
    topic: dict[str, float]
    most: float
    sweeps: int


def _refitted(factor: np.ndarray, goal: np.ndarray, full: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """Factors that bring ``reach`` to what ``goal`` leaves beside the cells at one; those with nothing left to give shrink in proportion."""
    some = np.where(reach > 0, reach, 1)
    fitted = np.where(reach > 0, (goal - full) / some, np.where(full > 0, factor, 0))
    shrunk = factor * goal / np.maximum(full + reach * factor, 1e-300)
    return np.where(factor >= _ALL, factor, np.where(goal > full, fitted, shrunk))


def rake(docs: DataFrame, targets: Targets = Targets()) -> Mix:
    """Factors that meet the targets; sources that hold tokens only where nothing is wanted get none.

    Without any token there is nothing to rake, and all factors are one.
    """
    counted = _marked(docs).groupBy("source", "lang", "topic").agg(F.sum("n_tokens").cast("double").alias("n")).where("n > 0")
    counted = materialised(counted)
    by_lang = counted.groupBy("lang").agg(F.sum("n").alias("n")).limit(LANGUAGES + 1).collect()
    if len(by_lang) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages: the column lang holds something else")
    by_topic = counted.groupBy("topic").agg(F.sum("n").alias("n")).collect()
    total = sum(r["n"] for r in by_topic)
    if not total:
        return Mix(docs.sparkSession.createDataFrame([], "source string, factor double"), {}, {}, 1.0, 0)
    bounded = targets.kept is not None
    for name, given in (("source", targets.source), ("lang", targets.lang), ("topic", targets.topic)):
        if bounded and given:  # nothing else is wanted, so nothing else counts
            counted = counted.where(F.col(name).isin([k for k, v in given.items() if v > 0]))
    by_lang = counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()
    by_topic = counted.groupBy("topic").agg(F.sum("n").alias("n")).collect()
    langs = {r["lang"]: r["n"] for r in by_lang}
    if not langs:  # no token is wanted
        return Mix(docs.sparkSession.createDataFrame([], "source string, factor double"), {}, {}, 1.0, 0)
    names = sorted(langs)
    topics = [t for t, _ in TOPICS]
    topic_sums = {r["topic"]: r["n"] for r in by_topic}
    tokens = min(targets.kept * total, sum(langs.values())) if bounded else 1.0
    want_l = _tempered(langs, targets.lang, targets.temper)
    want_t = _tempered(topic_sums, targets.topic, targets.temper)
    goal_l = np.array([want_l[name] for name in names])
    goal_t = np.array([want_t.get(t, 0.0) for t in topics])
    lang_f, topic_f = np.ones(len(names)), np.ones(len(topics))
    if bounded:
        have_l, have_t = np.array([langs[n] for n in names]), np.array([topic_sums.get(t, 0.0) for t in topics])
        goal_l, goal_t = _filled(goal_l, have_l, tokens), _filled(goal_t, have_t, tokens)
        lang_f[goal_l >= have_l * (1 - 1e-12)] = _ALL
        topic_f[goal_t >= have_t * (1 - 1e-12)] = _ALL

    places = docs.sparkSession.createDataFrame([(name, i) for i, name in enumerate(names)], "lang string, place int")
    cell = (F.col("place") * len(topics) + F.array_position(F.array(*[F.lit(t) for t in topics]), F.col("topic")).cast("int")).alias("k")
    cells = counted.join(F.broadcast(places), "lang").groupBy("source", cell).agg(F.sum("n").alias("n"))
    wanted = F.map_from_entries(F.array(*[F.struct(F.lit(k), F.lit(float(v))) for k, v in targets.source.items()])) if targets.source else None
    power = F.coalesce(F.try_element_at(wanted, F.col("source")), F.lit(0.0)) if targets.source else F.pow(F.sum("n"), F.lit(targets.temper))
    sources = cells.groupBy("source").agg(
        F.collect_list(F.struct("k", "n")).alias("cells"), power.alias("wanted"), F.sum("n").alias("have")
    )
    sources = materialised(sources)
    if bounded:
        sources = _filled_sources(sources, tokens)
    else:
        scale = sources.agg(F.sum("wanted")).first()[0] or 1.0
        sources = sources.withColumn("wanted", F.col("wanted") / scale)

    def with_factor() -> DataFrame:
        """``factor`` gives each source its wanted tokens under the factors of languages and topics."""
        factors = _doubles(np.outer(lang_f, topic_f).ravel())
        weighted = F.transform("cells", lambda c: F.struct(F.element_at(factors, c["k"]).alias("w"), c["n"].alias("n")))
        if not bounded:
            reach = F.aggregate(weighted, F.lit(0.0), lambda s, c: s + c["n"] * c["w"])
            return sources.withColumn("factor", F.when(reach > 0, F.col("wanted") / reach).otherwise(0.0))

        # From the lightest cell on: a cell stays below one if a factor that brings it to one gives the source too much.
        def added(s: Column, c: Column) -> Column:
            reach, below = s["reach"] + c["n"] * c["w"], s["below"] + c["n"]
            under = reach / c["w"] + F.col("have") - below > F.col("wanted") * (1 + 1e-12)
            return F.struct(
                reach.alias("reach"),
                below.alias("below"),
                F.when(under, reach).otherwise(s["open_reach"]).alias("open_reach"),
                F.when(under, below).otherwise(s["open"]).alias("open"),
            )

        begun = F.struct(*[F.lit(0.0).alias(n) for n in ("reach", "below", "open_reach", "open")])
        parted = sources.withColumn("_parted", F.aggregate(F.array_sort(F.filter(weighted, lambda c: c["w"] > 0)), begun, added))
        rest = F.col("wanted") - (F.col("have") - F.col("_parted.open"))
        factor = F.when(F.col("_parted.open_reach") > 0, rest / F.col("_parted.open_reach")).otherwise(_ALL)
        return parted.withColumn("factor", F.when(F.col("wanted") > 0, factor).otherwise(0.0)).drop("_parted")

    sweep = 0
    for sweep in range(1, targets.sweeps + 1):
        factors = _doubles(np.outer(lang_f, topic_f).ravel())
        held = with_factor().select("factor", F.explode("cells").alias("c"))
        full = F.col("factor") * F.element_at(factors, F.col("c.k")) >= (1.0 if bounded else float("inf"))
        sums = held.groupBy("c.k").agg(
            F.sum(F.when(~full, F.col("factor") * F.col("c.n"))).alias("rest"), F.sum(F.when(full, F.col("c.n"))).alias("full")
        )
        table, fixed = np.zeros((2, len(names) * len(topics)))
        for row in sums.collect():
            table[row["k"] - 1], fixed[row["k"] - 1] = row["rest"] or 0.0, row["full"] or 0.0
        table, fixed = table.reshape(len(names), len(topics)), fixed.reshape(len(names), len(topics))
        now = table * np.outer(lang_f, topic_f) + fixed
        off = max(np.abs(now.sum(1) - goal_l).max(initial=0), np.abs(now.sum(0) - goal_t).max(initial=0))
        if off < targets.tolerance * tokens:
            break
        lang_f = _refitted(lang_f, goal_l, fixed.sum(1), table @ topic_f)
        topic_f = _refitted(topic_f, goal_t, fixed.sum(0), table.T @ lang_f)
    factors = _doubles(np.outer(lang_f, topic_f).ravel())
    final = materialised(with_factor())
    most = final.select(F.max(F.col("factor") * F.aggregate("cells", F.lit(0.0), lambda m, c: F.greatest(m, F.element_at(factors, c["k"]))))).first()[0]
    most = 1.0 if bounded else most
    return Mix(final.select("source", "factor"), dict(zip(names, lang_f.tolist(), strict=True)), dict(zip(topics, topic_f.tolist(), strict=True)), most or 1.0, sweep)


def drawn(docs: DataFrame, targets: Targets = Targets()) -> DataFrame:
    """``row`` (the columns of ``docs``), ``doc_id, source, lang, topic, n_tokens, probability, kept`` for every row.

    A null source or language is called ``unknown``. A text without words has no weight in the mix and is kept. Equal rows are
    drawn alike.
    """
    mix = rake(docs, targets)
    rows = _marked(docs).join(mix.sources.withColumnRenamed("factor", "_factor"), "source", "left")
    langs = docs.sparkSession.createDataFrame(list(mix.lang.items()), "lang string, _lang double")
    rows = rows.join(F.broadcast(langs), "lang", "left")
    topic = F.lit(0.0)
    for name, factor in mix.topic.items():
        topic = F.when(F.col("topic") == name, factor).otherwise(topic)
    product = F.coalesce("_factor", F.lit(0.0)) * F.coalesce("_lang", F.lit(0.0)) * topic / F.lit(mix.most)
    chance = F.pmod(F.xxhash64("draw", F.lit(targets.seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    probability = F.when(F.col("n_tokens") == 0, 1.0).otherwise(F.least(product, F.lit(1.0)))
    return rows.withColumn("probability", probability).withColumn("kept", chance < F.col("probability")).drop("_factor", "_lang", "draw")


def mixed(docs: DataFrame, targets: Targets = Targets()) -> DataFrame:
    """The rows of ``docs`` that are drawn, with their columns as they were."""
    kept = drawn(docs, targets).where("kept")
    return kept.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])


def report(docs: DataFrame, targets: Targets = Targets()) -> DataFrame:
    rows = drawn(docs.select("doc_id", "text", *[c for c in ("source", "lang") if c in docs.columns]), targets)
    return rows.select("doc_id", "source", "lang", "topic", "n_tokens", F.round("probability", 9).alias("probability"), "kept")
