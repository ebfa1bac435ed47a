"""Phrase collocations by marginalising the counts of the longest windows.

Texts are cut into pieces at punctuation, pieces into words. Every word starts one window of ``longest`` words: lead columns hold
the words that follow in its piece, padded with nulls at the end of the piece. Only these windows are counted. As every occurrence of a
shorter phrase starts exactly one window, its count is the sum over the windows that begin with it: a ROLLUP over the lead columns
gives the counts of all shorter phrases, and of all words of a language, without another pass over the texts or another
explosion into n-grams.

Windows hold words as numbers: every word has a 64-bit hash that no other word of the corpus has, and the most frequent ones have
their rank instead, which makes the shuffled rows a third as long. Phrases get their words back at the end.

Both aggregations combine on the map side, so a word, phrase or language that holds much of the corpus arrives as one row for each task.
The counted windows are read twice from one shuffle. Only phrases with ``least`` occurrences go on: every part of such a
phrase has at least as many, so all counts that a score needs are among them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spotlift.llm.shared import written
from spotlift.llm.url_filter import lowered

MILLION = 1_000_000
#: Ranks are below 2^21, so that three of them share a column.
RANK_BITS = 21


@dataclass(frozen=True)
class Phrases:
    """``inside_percent``: a phrase is dropped where a longer one that holds it has this share of its occurrences. ``ranked_words`` bounds a broadcast, see
    ``numbered_words``; it has no influence on results."""

    longest: int = 3
    least: int = 10
    inside_percent: int = 50
    per_lang: int = 2000
    ranked_words: int = 1 << 20


def _leads(longest: int) -> list[str]:
    return [f"w{i}" for i in range(1, longest + 1)]


def pieces(docs: DataFrame) -> DataFrame:
    """``lang, words``: the words of every piece that has any."""
    # Piece by piece, so that a very long text is not held as windows at once.
    cut = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.explode(F.split(F.col("text").cast("string"), r"[.,;:!?\x0A-\x0D]")).alias("piece"),
    )
    words = F.array_remove(F.split(F.replace(lowered(F.col("piece")), F.lit("\t"), F.lit(" ")), " "), "")
    return cut.select("lang", words.alias("words")).where("size(words) > 0")


@dataclass(frozen=True)
class Numbers:
    """Words as numbers, so that windows are short rows: ``seed`` gives every word a hash of its own, and ``ranks`` (``hash, rank``)
    turns those of the most frequent words into small numbers, which compress well. ``vocabulary`` has ``word, hash, f``. ``complete`` tells
    whether every word that occurs often enough to be in a phrase has a rank."""

    seed: int
    ranks: DataFrame
    vocabulary: DataFrame
    complete: bool

    def name(self, words: str) -> Column:
        return F.transform(words, lambda word: F.xxhash64(word, F.lit(self.seed)))


def numbered_words(docs: DataFrame, least: int, most: int) -> Numbers:
    """Counts all words, looks for a seed by which no two of them share a hash and none looks like a rank, and ranks the ``most`` frequent
    ones with ``least`` occurrences.

    A 64-bit hash is shared in a vocabulary of 10^8 words with a chance of 1 to 3,700; then the next seed is tried. Results do not depend on
    the seed nor on ``most``, which bounds what is broadcast: 16 bytes for each ranked word.
    """
    counted = pieces(docs).select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("f"))
    counted = written(counted, "words")
    for seed in range(1, 100):
        vocabulary = counted.withColumn("hash", F.xxhash64("word", F.lit(seed)))
        if vocabulary.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where(f"n > 1 OR hash BETWEEN 1 AND {int(most)}").isEmpty():
            break
    else:
        raise ValueError("no seed gives every word a hash of its own")
    if most >= 1 << RANK_BITS:
        raise ValueError(f"at most {(1 << RANK_BITS) - 1} words can have a rank")
    frequent = vocabulary.where(F.col("f") >= least)
    first = frequent.orderBy(F.desc("f"), "hash").limit(most)  # short: Spark keeps the first rows of every task
    ranks = first.select("hash", F.row_number().over(Window.orderBy(F.desc("f"), "hash")).cast("long").alias("rank"))
    return Numbers(seed, written(ranks, "word-ranks"), vocabulary, frequent.count() <= most)


def windows(docs: DataFrame, numbers: Numbers, longest: int) -> DataFrame:
    """``lang, w1, w2, ...``: for every word the numbers of the words from it on, null beyond the end of its piece.

    Where the ranks are complete, a word without one is too rare for any phrase: it ends a window like the end of a piece, and
    windows that differ only behind it are one. Either way the counts of phrases that occur often enough are the same.
    """
    named = pieces(docs).select("lang", numbers.name("words").alias("w"))
    leads = _leads(longest)
    shifted = ", ".join(["w", *(f"slice(w, {i}, size(w))" for i in range(2, longest + 1))])
    rows = named.selectExpr("lang", f"inline(arrays_zip({shifted})) AS ({', '.join(leads)})")
    for lead in leads:
        rank = F.broadcast(numbers.ranks.select(F.col("hash").alias(lead), F.col("rank").alias(f"{lead}_rank")))
        rows = rows.join(rank, lead, "left")
    number = {w: F.col(f"{w}_rank") if numbers.complete else F.coalesce(f"{w}_rank", w) for w in leads}
    shown = []
    for i, lead in enumerate(leads):
        before = [number[w].isNotNull() for w in leads[:i]]
        shown.append((F.when(reduce(and_, before), number[lead]) if before else number[lead]).alias(lead))
    return rows.select("lang", *shown)


def _packed(leads: list[str], per_key: int) -> list[Column]:
    """The numbers of a window in fewer columns: ranks need ``RANK_BITS`` each, and nulls become zero. Whole hashes keep a column each."""
    if per_key == 1:
        return [F.col(w).alias(f"key{i}") for i, w in enumerate(leads)]
    shifted = [F.shiftleft(F.coalesce(w, F.lit(0).cast("long")), RANK_BITS * (i % per_key)) for i, w in enumerate(leads)]
    return [reduce(lambda x, y: x.bitwiseOR(y), shifted[i : i + per_key]).alias(f"key{i // per_key}") for i in range(0, len(leads), per_key)]


def _unpacked(leads: list[str], per_key: int) -> list[Column]:
    if per_key == 1:
        return [F.col(f"key{i}").alias(w) for i, w in enumerate(leads)]
    mask = F.lit((1 << RANK_BITS) - 1).cast("long")
    parts = [F.shiftright(f"key{i // per_key}", RANK_BITS * (i % per_key)).bitwiseAND(mask) for i in range(len(leads))]
    return [F.nullif(part, F.lit(0).cast("long")).alias(w) for part, w in zip(parts, leads, strict=True)]


def numbered_counts(docs: DataFrame, numbers: Numbers, phrases: Phrases) -> DataFrame:
    """``lang, numbers, f`` for every phrase of up to ``longest`` words with ``least`` occurrences, and one row without words for all words."""
    leads = _leads(phrases.longest)
    per_key = 63 // RANK_BITS if numbers.complete else 1
    keys = _packed(leads, per_key)
    top = windows(docs, numbers, phrases.longest).select("lang", *keys)
    top = top.groupBy(*top.columns).agg(F.count(F.lit(1)).alias("n")).select("lang", *_unpacked(leads, per_key), "n")
    # The condition hangs on the count, so that it stays above the shuffle and both branches read the same one.
    whole = F.when(F.col(leads[-1]).isNotNull(), F.col("n"))
    full = top.where(whole >= phrases.least).select("lang", F.array(*leads).alias("numbers"), F.col("n").alias("f"))
    rolled = docs.sparkSession.sql(
        f"SELECT lang, {', '.join(leads[:-1])}, sum(n) AS f, grouping_id() AS left_out FROM {{top}} GROUP BY lang, ROLLUP({', '.join(leads[:-1])})", top=top
    )
    # grouping_id has a set bit for every column that is rolled up, from the last one on.
    shown = F.when((F.col("left_out") == (1 << (phrases.longest - 1)) - 1), F.array().cast("array<bigint>"))
    for size in range(1, phrases.longest):
        usable = F.col(leads[size - 1]).isNotNull() & (F.col("f") >= phrases.least)
        shown = shown.when((F.col("left_out") == (1 << (phrases.longest - 1 - size)) - 1) & usable, F.array(*leads[:size]))
    return full.unionByName(rolled.select("lang", shown.alias("numbers"), "f").where("numbers IS NOT NULL"))


def spelled(rows: DataFrame, numbers: Numbers, least: int) -> DataFrame:
    """``rows`` with the text ``phrase`` instead of ``numbers``. Only words with enough occurrences are looked up: each is the one word of its number."""
    names = numbers.vocabulary.where(F.col("f") >= least).join(numbers.ranks, "hash", "left")
    names = names.select(F.coalesce("rank", "hash").alias("number"), "word")
    places = rows.select("*", F.posexplode("numbers").alias("at", "number")).join(names, "number")
    # At most ``longest`` rows make one phrase.
    words = F.sort_array(F.collect_list(F.struct("at", "word")))
    return places.groupBy(*rows.columns).agg(F.array_join(words["word"], " ").alias("phrase")).drop("numbers")


def scored_phrases(counts: DataFrame) -> DataFrame:
    """``lang, numbers`` of the candidates among ``lang, numbers, f`` with ``a, l, r, score`` of their lowest-scoring cut; of equal scores the earliest.

    Whole numbers of 38 digits are used, so a product is exact or, for counts beyond 3 * 10^15, an error. A word that begins
    or ends very many phrases is a hot key on one side only; adaptive execution splits it.
    """
    cuts = counts.where("size(numbers) > 1").select("lang", "numbers", F.col("f").alias("a"), F.explode(F.expr("sequence(1, size(numbers) - 1)")).alias("k"))
    cuts = cuts.withColumn("first", F.expr("slice(numbers, 1, k)")).withColumn("rest", F.expr("slice(numbers, k + 1, size(numbers) - k)"))
    parts = counts.where("size(numbers) > 0")
    cuts = cuts.join(parts.select("lang", F.col("numbers").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(parts.select("lang", F.col("numbers").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    wide = "cast({} AS decimal(19, 0))".format
    score = f"(cast({MILLION} AS decimal(7, 0)) * {wide('a')} * {wide('a')}) div ({wide('l')} * {wide('r')})"
    cut = F.struct(F.expr(score).alias("score"), "k", "l", "r")
    lowest = cuts.groupBy("lang", "numbers", "a").agg(F.min(cut).alias("cut"))
    return lowest.select("lang", "numbers", "a", "cut.l", "cut.r", "cut.score")


def held_by_longer(counts: DataFrame) -> DataFrame:
    """``lang, numbers, longer``: for every phrase inside a longer candidate the occurrences of the most frequent such one."""
    longer = counts.where("size(numbers) > 2").withColumn("size", F.explode(F.expr("sequence(2, size(numbers) - 1)")))
    longer = longer.withColumn("at", F.explode(F.expr("sequence(1, size(numbers) - size + 1)")))
    inner = longer.select("lang", F.expr("slice(numbers, at, size)").alias("numbers"), "f")
    return inner.groupBy("lang", "numbers").agg(F.max("f").alias("longer"))


def collocations(docs: DataFrame, phrases: Phrases = Phrases()) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``per_lang`` phrases of each language (``text`` and ``lang`` are read).

    Phrases have 2 to ``longest`` words, occur ``least`` times or more within pieces, and are not mostly part of one longer phrase. Order:
    score, then occurrences, both falling, then the phrase by its bytes. A null language is ``und``; a null or empty text, or one of blanks
    and punctuation only, has no words; repeated rows count again. A table without words gives no rows.
    """
    numbers = numbered_words(docs, phrases.least, phrases.ranked_words)
    counts = written(numbered_counts(docs, numbers, phrases), "phrases")
    held = held_by_longer(counts)
    free = scored_phrases(counts).join(held, ["lang", "numbers"], "left")
    free = free.where(f"longer IS NULL OR 100 * longer < {int(phrases.inside_percent)} * a")
    # Numbers become words again only where a phrase can still be among the first: equal scores stay until their texts decide.
    fit = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    # Spark keeps the first rows of a language within each task before it brings them together.
    near = free.drop("longer").withColumn("near", F.rank().over(fit)).where(F.col("near") <= phrases.per_lang).drop("near")
    best_first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    first = spelled(near, numbers, phrases.least).withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= phrases.per_lang)
    totals = counts.where("size(numbers) = 0").select("lang", F.col("f").alias("n"))
    return first.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
