"""Personal data: regular expressions propose spans, checksums and ranges confirm them, nearby words adjust a score.

Everything is built from SQL functions. A pattern's matches come from ``regexp_extract_all``; splitting the text at the same pattern
gives what lies between them, so running sums of lengths give the offsets, in code points. Possessive quantifiers and an anchor at the
beginning of a run keep the work linear in long runs of letters or digits without changing which matches are found.

Running sums, maxima and minima over the matches of one text are taken by doubling, so a text of n matches costs n log n: a number table of
any length is one text like any other. A lambda's body is evaluated anew for each element, so whatever it reads is bound to a name before.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotlift.llm.shared import without

#: The kinds whose definition is fixed, in their order, and the kinds added here.
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "local_phone")
KINDS = BASE + ADDED

#: Code points of a block of text that cuts are made in.
_BLOCK = 1024
_SPANS = "array<struct<start:int,kind_no:int,kind:string,end:int,score:double>>"

# A match begins at the first character of its run or where the last match ended.
_MAIL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_MAIL}]))[{_MAIL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3}+)?+(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "local_phone": r"(?<![0-9+.)(-])(?:\([0-9]{3}\)\x20|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}(?![0-9-])",
}
#: A cheap look at the text that every match passes.
HINTS = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"),
    "phone": lambda t: F.contains(t, F.lit("+")),
    "iban": lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}"),
    "ssn": lambda t: t.rlike(r"[0-9]-[0-9]{2}-[0-9]"),
    "local_phone": lambda t: t.rlike(r"[0-9]{3}[-.\x20][0-9]{4}"),
}
#: Words that make a kind likelier when they stand shortly before the span.
CONTEXT = {
    "email": "(?i)mail|contact|write to",
    "ip": r"(?i)\bip\b|address|host|server",
    "card": "(?i)card|visa|credit|payment",
    "phone": r"(?i)phone|\btel|call|fax|mobile",
    "iban": "(?i)iban|account|bank|konto|cuenta|compte",
    "ssn": r"(?i)\bssn\b|social security",
    "local_phone": r"(?i)phone|\btel|call|fax|mobile",
}
#: What a confirmed match scores alone. Kinds without a checksum need a context word to pass.
SCORES = {"email": 0.9, "ip": 0.7, "card": 0.9, "phone": 0.7, "iban": 0.95, "ssn": 0.3, "local_phone": 0.3}


@dataclass(frozen=True)
class Search:
    """``reach`` characters before a span are searched for context words, which add ``bonus``; added kinds need ``least``."""

    reach: int = 40
    bonus: float = 0.3
    least: float = 0.5


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    """Whether the digits' Luhn sum is a multiple of ten."""
    ordered = F.reverse(_digits(match))
    doubled = F.translate(ordered, "0123456789", "0246813579")  # twice the digit, its digits added up
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(ordered)),
        F.lit(0),
        lambda total, i: total + F.substr(F.when(i % 2 == 0, doubled).otherwise(ordered), i, F.lit(1)).cast("int"),
    )
    return total % 10 == 0


def _mod97(match: Column) -> Column:
    """Whether an IBAN's number, country and check digits last and letters as 10 to 35, leaves 1 modulo 97."""
    plain = F.regexp_replace(match, r"\x20", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
    rest = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda rest, c: F.when(c.rlike("^[0-9]$"), (rest * 10 + F.try_to_number(c, F.lit("9")).cast("int")) % 97)
        .when(c.rlike("^[A-Z]$"), (rest * 100 + F.ascii(c) - 55) % 97)
        .otherwise(rest),
    )
    return F.length(plain).between(15, 34) & (rest == 1)


def _confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        part = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]?)"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        size = F.length(_digits(match))
        return F.when(size.between(14, 19), _luhn(match)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    if kind == "iban":
        return _mod97(match)
    if kind == "ssn":
        return ~match.rlike("^(?:000|666|9)") & ~match.rlike("-00-|0000$")
    return F.lit(True)


def _bound(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(values: Column, joined, back: bool = False) -> Column:
    """Each element joined with all before it (behind it, with ``back``), by doubling the distance."""
    sign = -1 if back else 1

    def farther(so_far: Column, step: Column) -> Column:
        return F.transform(so_far, lambda x, i: F.coalesce(joined(x, F.get(so_far, i - step * sign)), x))

    steps = F.array(*[F.lit(1 << k) for k in range(31)])
    return _bound(
        values, lambda v: _bound(F.size(v), lambda n: F.aggregate(F.filter(steps, lambda step: step < n), v, farther))
    )


def _found(text: Column, kind: str, search: Search) -> Column:
    """Confirmed spans of one kind, in order."""
    pattern = F.lit(PATTERNS[kind])
    number = KINDS.index(kind)
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"))
    pieces = F.filter(pairs, lambda p: p["match"].isNotNull())
    nearest = search.reach // 2  # a match has two characters at least

    def spans(pieces: Column) -> Column:
        # Lengths between matches and of matches, added up, are where matches end.
        ends = _running(F.transform(pieces, lambda p: F.length(p["gap"]) + F.length(p["match"])), lambda x, y: x + y)
        laid = F.transform(F.arrays_zip(pieces.alias("p"), ends.alias("end")), lambda x, i: F.struct(x["p"].alias("p"), x["end"].alias("end"), i.alias("no")))
        return F.transform(F.filter(laid, lambda x: _confirmed(kind, x["p"]["match"])), lambda x: rated(pieces, x))

    def rated(pieces: Column, found: Column) -> Column:
        earlier = F.slice(pieces, F.greatest(found["no"] - nearest, F.lit(0)) + 1, F.least(found["no"], F.lit(nearest)))
        parts = F.transform(earlier, lambda p: F.right(F.concat(p["gap"], p["match"]), F.lit(search.reach)))
        before = F.right(F.concat(F.array_join(parts, ""), found["p"]["gap"]), F.lit(search.reach))
        score = F.lit(SCORES[kind]) + F.when(before.rlike(CONTEXT[kind]), F.lit(search.bonus)).otherwise(F.lit(0.0))
        return F.struct(
            (found["end"] - F.length(found["p"]["match"])).alias("start"),
            F.lit(number).alias("kind_no"),
            F.lit(kind).alias("kind"),
            found["end"].alias("end"),
            F.least(score, F.lit(1.0)).alias("score"),
        )

    found = _bound(pieces, spans)
    if kind in ADDED:
        found = F.filter(found, lambda s: s["score"] >= search.least)
    return F.when(HINTS[kind](text), found.cast(_SPANS)).otherwise(F.array().cast(_SPANS))


def _settled(spans: Column) -> Column:
    """``spans``, sorted, without the added ones that overlap a base span."""
    least, most = F.lit(-1), F.lit((1 << 31) - 1)
    added = F.lit(len(BASE))
    reached = _running(F.transform(spans, lambda s: F.when(s["kind_no"] < added, s["end"]).otherwise(least)), F.greatest)
    begun = _running(F.transform(spans, lambda s: F.when(s["kind_no"] < added, s["start"]).otherwise(most)), F.least, back=True)
    beside = F.arrays_zip(spans.alias("span"), reached.alias("reached"), begun.alias("begun"))
    free = F.filter(
        beside,
        lambda x: (x["span"]["kind_no"] < added)
        | ((x["reached"] <= x["span"]["start"]) & (x["begun"] >= x["span"]["end"])),
    )
    return F.when(F.exists(spans, lambda s: s["kind_no"] >= added), F.transform(free, lambda x: x["span"])).otherwise(spans)


def with_spans(docs: DataFrame, search: Search = Search()) -> DataFrame:
    """``docs`` with ``pii``, all spans by start and kind, and ``pii_base``, those of the fixed kinds; a null text has none.

    A span has ``start``, ``end`` (code points, end exclusive), ``kind`` and ``score``. Added kinds that overlap a base span give way.
    Columns of these two names in ``docs`` give way. Equal rows get equal spans.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    spans = F.array_sort(reduce(F.concat, [_found(text, kind, search) for kind in KINDS]))
    rows = without(docs, ["pii", "pii_base"]).select("*", _bound(spans, _settled).alias("pii"))
    return rows.select("*", F.filter("pii", lambda s: s["kind_no"] < len(BASE)).alias("pii_base"))


def _written(spans: str) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _is(kind: str):
    return lambda span: span["kind"] == kind


def report(docs: DataFrame, search: Search = Search()) -> DataFrame:
    """Counts by base kind, a digest of the base spans and all spans as text, for every row."""
    rows = with_spans(docs.select("doc_id", "text"), search)
    counts = [F.size(F.filter("pii_base", _is(k))).cast("long").alias(f"n_{k}") for k in BASE]
    return rows.select(
        "doc_id", *counts, F.sha2(_written("pii_base"), 256).alias("base_sha256"), _written("pii").alias("spans")
    )


def masked(docs: DataFrame, search: Search = Search()) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; a null text stays null, all other columns as they are.

    Of overlapping spans the first begins the mask and the last ends it. ``n_chars``, if there is one, follows the new text.
    """
    names = docs.columns
    rows = with_spans(docs.select(F.struct(*[docs[n].alias(f"c{i}") for i, n in enumerate(names)]).alias("row"), docs["text"].alias("text")), search)
    text = F.col("text").cast("string")
    # Cutting a text at a place reads it from its beginning: cuts are made in blocks of it instead.
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0))

    def cut(blocks: Column, low: Column, high: Column) -> Column:
        first = F.floor(low / _BLOCK).cast("int")
        last = F.floor((high - 1) / _BLOCK).cast("int")
        part = F.array_join(F.slice(blocks, first + 1, last - first + 1), "")
        return F.when(high > low, F.substr(part, low - first * _BLOCK + 1, high - low)).otherwise("")

    def built(spans: Column, blocks: Column, reached: Column) -> Column:
        beside = F.transform(spans, lambda s, i: F.struct(s.alias("span"), F.coalesce(F.get(reached, i - 1), F.lit(0)).alias("at")))
        begun = F.filter(beside, lambda x: x["span"]["start"] >= x["at"])
        parts = F.transform(begun, lambda x: F.concat(cut(blocks, x["at"], x["span"]["start"]), F.lit("["), F.upper(x["span"]["kind"]), F.lit("]")))
        return F.concat(F.array_join(parts, ""), cut(blocks, F.element_at(reached, -1), F.length(text)))

    def joined(spans: Column) -> Column:
        ends = _running(F.transform(spans, lambda s: s["end"]), F.greatest)
        return _bound(blocks, lambda b: _bound(ends, lambda reached: built(spans, b, reached)))

    new = F.when(F.size("pii") > 0, _bound(F.col("pii"), joined)).otherwise(text)
    rows = rows.select("row", new.alias("text"))

    def column(i: int, name: str) -> Column:
        if name.lower() == "text":
            return F.col("text").alias(name)
        if name.lower() == "n_chars":
            return F.coalesce(F.length("text").cast(docs.schema[i].dataType), F.col(f"row.c{i}")).alias(name)
        return F.col(f"row.c{i}").alias(name)

    return rows.select(*[column(i, n) for i, n in enumerate(names)])
