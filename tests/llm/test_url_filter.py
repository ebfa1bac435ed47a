"""URL rules and terms against a plain version, with planted URLs."""

from __future__ import annotations

import re

import pytest

from spotlift.llm import url_filter
from spotlift.llm.url_filter import ALLOW, BLOCK, UrlPolicy

URLS = [
    "http://example.com/en/1", "https://www.EXAMPLE.com/en/2?x=1", "http://m.www.example.com/en/", "http://blog.example.com/en", "http://example.com",
    "http://notexample.com/en/3", "http://a.net/es/1", "http://net/fr/2", "http://a.network/fr/2", "http://a.net/de/es/", "ftp://x.org/free/PORN/1",
    "http://x.org/essex/scunthorpe", "http://x.org/sex/dating", "http://x.org/sex/sex", "http://x.org/casino?bonus=1", "http://x.org/%70orn%20xxx",
    "http://xxx.org:80/", "http://x.org#xxx", "http://x.org/xxxx", "http://x.com/xxx", "no scheme xxx", "x://y://com/en", "", "://", None,
    "http://pornhub.org/", "http://x.org/poker-slots-hot", "http://Ä.ÖRG/ÄB", "http://x.org/\u00e9xxx", "http://x.org/" + "a/" * 200_000 + "xxx", "http://com/q",
]


def plain(url, policy):
    """By regular expressions and a walk over all rules."""
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), url or "")
    rest = url.split("://", 1)[1] if "://" in (url or "") else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = []
    for rule, verdict in policy.rules:
        name, slash, prefix = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + prefix):
            fits.append((len(rule), len(name), rule, verdict))
    scanned = re.sub("%[0-9a-f]{2}", " ", lower)
    alone = lambda term: re.search(f"(?<![a-z0-9]){re.escape(term)}(?![a-z0-9])", scanned)
    strict = sorted(t for t in policy.strict if alone(t))
    soft = sorted(t for t in policy.soft if alone(t))
    if fits:
        return (host, path, *max(fits)[2:], strict, soft)
    rejected = strict or sum(policy.soft[t] for t in soft) >= policy.reject_at
    return host, path, None, BLOCK if rejected else ALLOW, strict, soft


@pytest.mark.parametrize("policy", [UrlPolicy(), UrlPolicy(rules=(), soft={"casino": 1, "bonus": 1, "é": 1}, strict=(), reject_at=2), UrlPolicy((), (), {}, 1),
                                    UrlPolicy(rules=(("x.org/s", BLOCK), ("org/sex", ALLOW), ("org/", BLOCK)))])
def test_urls(spark, policy):
    rows = [(i, u, "html", "clash") for i, u in enumerate(URLS)] + [(3, URLS[3], None, None), (None, URLS[10], None, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, rule string")
    got = sorted((tuple(r) for r in url_filter.judged(pages, policy).collect()), key=str)
    assert got == sorted(((i, *plain(u, policy)) for i, u, *_ in rows), key=str)
    kept = url_filter.allowed(pages, policy)
    assert kept.columns == pages.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted((r for r in rows if plain(r[1], policy)[3] == ALLOW), key=str)
    assert url_filter.judged(pages.limit(0), policy).count() == 0


def test_known_verdicts():
    verdicts = {u: plain(u, UrlPolicy())[2:4] for u in URLS}
    assert verdicts["http://m.www.example.com/en/"] == ("www.example.com/en/", ALLOW)
    assert verdicts["http://example.com/en/1"] == ("example.com/en/", BLOCK)
    assert verdicts["http://example.com"] == (None, ALLOW)
    assert verdicts["ftp://x.org/free/PORN/1"] == verdicts["http://x.org/sex/dating"] == (None, BLOCK)
    assert verdicts["http://x.org/essex/scunthorpe"] == verdicts["http://x.org/sex/sex"] == (None, ALLOW)
