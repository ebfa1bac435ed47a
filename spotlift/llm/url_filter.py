"""URL filter by host rules and a weighted vocabulary of URL terms.

Two judges, in this order:

* *Rules* allow or block a host with all its subdomains below a path prefix; the longest rule that fits decides.
* *Terms* decide about all other URLs. One pass of an Aho-Corasick automaton over the lower-cased URL finds every term; a hit counts
  only if no ASCII letter or digit stands right before or after it, so that ``essex`` holds no ``sex``. One strict term rejects, and so do
  soft terms whose weights, each distinct term counted once, reach ``reject_at``.

Rules and terms are parameters and travel with the tasks; URLs are judged one by one, without any shuffle, and the pages themselves are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"

# Host rules, as (host and path prefix, verdict).
RULES = (
    ("com/", ALLOW),
    ("example.com/en/", BLOCK),
    ("www.example.com/en/", ALLOW),
    ("net/es/", BLOCK),
    ("net/fr/", BLOCK),
)

# Terms that reject alone.
STRICT = (
    "bdsm", "camgirl", "camgirls", "camsex", "creampie", "cumshot", "escorts", "fetish-videos", "gangbang", "hardcore-porn", "hentai", "milf",
    "porn", "porno", "pornhub", "pornstar", "sexcam", "sexchat", "sextube", "webcamsex", "xhamster", "xnxx", "xvideos", "xxx",
)

# Terms that reject only together, with their weights.
SOFT = {
    "18plus": 2, "adult": 1, "bet": 1, "betting": 1, "bonus": 1, "cams": 1, "casino": 2, "cialis": 2, "crack": 1, "dating": 1, "download-free": 1,
    "erotic": 2, "escort": 2, "free-spins": 2, "gambling": 1, "girls": 1, "hookup": 1, "hot": 1, "jackpot": 1, "keygen": 2, "loans": 1, "naked": 1,
    "nude": 2, "nudes": 2, "payday": 1, "pills": 1, "poker": 1, "serial-key": 1, "sex": 2, "sexy": 1, "slots": 1, "torrent": 1, "viagra": 2, "warez": 2,
}


_JUDGED = pa.struct(
    [("rule", pa.string()), ("verdict", pa.string()), ("strict_hits", pa.list_(pa.string())), ("soft_hits", pa.list_(pa.string()))]
)


@dataclass(frozen=True)
class UrlPolicy:
    """Terms are in lower case. ``rules`` give host and path prefix in one string, cut at its first slash."""

    rules: tuple[tuple[str, str], ...] = RULES
    strict: tuple[str, ...] = STRICT
    soft: dict[str, int] = field(default_factory=lambda: dict(SOFT))
    reject_at: int = 3


class RuleBook:
    """The longest rule that fits a URL, by look-ups of the host's suffixes. Of rules of equal length the one with the longer host wins."""

    def __init__(self, rules: tuple[tuple[str, str], ...]):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for rule, verdict in rules:
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host, []).append((slash + path, rule, verdict))
        for found in self.by_host.values():
            found.sort(key=lambda entry: -len(entry[0]))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        best = None
        while True:  # from the whole host to its last label
            for prefix, rule, verdict in self.by_host.get(host, ()):
                if path.startswith(prefix):
                    if best is None or len(rule) > len(best[0]):
                        best = rule, verdict
                    break
            dot = host.find(".")
            if dot < 0:
                return best
            host = host[dot + 1 :]


class TermScanner:
    """All terms of a text that stand alone."""

    def __init__(self, terms: set[str]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for term in terms:
            self.automaton.add_word(term, term)
        self.empty = not terms
        if terms:
            self.automaton.make_automaton()

    def hits(self, text: str) -> set[str]:
        if self.empty:
            return set()
        return {term for end, term in self.automaton.iter(text) if _free(text, end - len(term)) and _free(text, end + 1)}


def _free(text: str, at: int) -> bool:
    """Whether no ASCII letter or digit of the lower-cased ``text`` is at this place."""
    return not 0 <= at < len(text) or not (text[at].isascii() and text[at].isalnum())


def lowered(text: Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, capitals, capitals.lower()))


def address(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty where it is null or has no ``://``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)", 1), F.lit(""))
    return lowered(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def judgement(host: Column, path: Column, url: Column, policy: UrlPolicy = UrlPolicy()) -> Column:
    """``rule``, ``verdict``, ``strict_hits`` and ``soft_hits`` of a URL, as one struct; the automaton is built once for each task."""
    strict = set(policy.strict)

    @F.arrow_udf("rule string, verdict string, strict_hits array<string>, soft_hits array<string>")
    def judge(parts: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        book, scanner = RuleBook(policy.rules), TermScanner(strict | set(policy.soft))
        for hosts, paths, texts in parts:
            found = []
            for own_host, own_path, text in zip(hosts.to_pylist(), paths.to_pylist(), texts.to_pylist(), strict=True):
                hits = scanner.hits(text)
                sharp, mild = sorted(hits & strict), sorted(hits - strict)
                rejected = sharp or sum(policy.soft[term] for term in mild) >= policy.reject_at
                rule, verdict = book.find(own_host, own_path) or (None, BLOCK if rejected else ALLOW)
                found.append({"rule": rule, "verdict": verdict, "strict_hits": sharp, "soft_hits": mild})
            yield pa.array(found, _JUDGED)

    escapes_apart = F.regexp_replace(lowered(F.coalesce(url, F.lit(""))), "%[0-9a-f]{2}", " ")
    return judge(host, path, escapes_apart)


def judged(pages: DataFrame, policy: UrlPolicy = UrlPolicy()) -> DataFrame:
    """``page_id, host, path, rule, verdict, strict_hits, soft_hits`` for every row of ``pages`` (``page_id`` and ``url`` are read).

    Host is what follows the first ``://`` up to a slash, question mark, hash or the end, with A-Z lower-cased; path what follows up to a
    question mark, hash or the end. A null URL and one without ``://`` have both empty; no rule fits an empty host, and terms are looked
    for in what text there is. Percent escapes separate terms like any other sign. Rows are judged one by one: repeated rows, equal ids and
    null ids give a row each; a URL of any length is scanned whole.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    host, path = address(F.col("url"))
    rows = rows.select("page_id", "url", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("found", judgement(F.col("host"), F.col("path"), F.col("url"), policy))
    return rows.select("page_id", "host", "path", "found.*")


def allowed(pages: DataFrame, policy: UrlPolicy = UrlPolicy()) -> DataFrame:
    """The pages whose URL is allowed, all columns as they were: each is judged where it is, nothing is joined or shuffled."""
    url = pages["url"].cast("string")
    return pages.where(judgement(*address(url), url, policy)["verdict"] == ALLOW)
