"""The trie of rebuilt conversations against a plain one."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest

from spotlift.llm import prefix_trie
from spotlift.llm.prefix_trie import Rebuild


def _order(turn):
    _, number, role, text = turn
    role, text = role or "", text or ""
    mark = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
    return number is not None, number or 0, mark


def plain(rows, rule=Rebuild()):
    own = {}
    for row in sorted((r for r in rows if r[0] is not None), key=_order):
        own.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    convs = {}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % rule.heads
        base = c - int(np.fmod(c, rule.century))
        convs[c] = tuple(own.get(base, [])[:h] + s[h:])
    members = {}
    for c, s in convs.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    totals = {}
    kids = {}
    for node in members:
        if node:
            kids[node[:-1]] = kids.get(node[:-1], 0) + 1
    for node, inside in members.items():
        for d in range(len(node) + 1):
            leaves, saved = totals.get(node[:d], (0, 0))
            totals[node[:d]] = leaves + (node not in kids), saved + ((len(inside) - 1) * len(node[-1][1]) if node else 0)
    found = []
    for node, inside in members.items():
        ends = ",".join(map(str, sorted(c for c in inside if convs[c] == node)))
        parent = min(members[node[:-1]]) if node else None
        found.append((min(inside), len(node), parent, len(inside), kids.get(node, 0), *totals[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found)


def _rows():
    rng = np.random.default_rng(3)
    rows = []
    for c in [*range(90, 230), *range(-5, 6), 10**12, 10**12 + 7]:
        for turn in range(int(rng.integers(0, 9))):
            rows.append((c, turn, ["user", "assistant", None][turn % 3], ["a", "bé", "", None, "long " * 50][int(rng.integers(0, 5) * (turn > 1))]))
    rows += [(c, t, "user", "same") for c in (300, 301, 302, 399) for t in range(70)]  # one long conversation and its copies
    rows += [(401, t, "user", f"own {t}") for t in range(37)]
    rows += [(500, None, "user", "x")] * 40 + [(500, 3, "user", "y"), (500, 3, "user", "z"), (500, 3, None, "z")]  # ties and repeats
    rows += [(None, 0, "user", "lost"), (601, 0, None, None), (701, 0, "ab", "c"), (702, 0, "a", "bc"), (703, 0, "a", "bc")]
    return rows


@pytest.fixture(scope="module")
def conversations(spark):
    return spark.createDataFrame([(*r, "clash", 1) for r in _rows()], "conv_id long, turn long, role string, text string, name string, depth int").repartition(5)


def _of(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_trie(conversations):
    got = _of(prefix_trie.report(conversations))
    assert got == plain(_rows())
    assert max(r[1] for r in got) == 70 and sum(r[4] == 0 for r in got) > 50


def test_small_tasks(conversations):
    """Hot parents copied, long conversations joined in short stretches, ids hashed in short texts."""
    rule = Rebuild(century=50, heads=3)
    trie = prefix_trie.prefix_trie(*prefix_trie.rebuilt(conversations, rule), rows_per_task=2, stretch=2)
    want = plain(_rows(), rule)
    ends = {bytes(r["name"]): r["ends_sha256"] for r in prefix_trie.ends_digest(trie.ends, most=3).collect()}
    got = [(*tuple(r)[1:], ends.get(bytes(r["name"]), prefix_trie.EMPTY_SHA256)) for r in trie.nodes.select(
        "name", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_few_rows(spark):
    layout = "conv_id long, turn long, role string, text string"
    assert prefix_trie.report(spark.createDataFrame([], layout)).count() == 0
    assert prefix_trie.report(spark.createDataFrame([(None, 1, "a", "b")], layout)).count() == 0
    one = [(101, 0, "user", "x")]  # crc32 % 6 decides whether it keeps its turn
    assert _of(prefix_trie.report(spark.createDataFrame(one, layout))) == plain(one)
