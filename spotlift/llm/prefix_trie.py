"""Prefix trie of conversations by Van Emde Boas recursion.

A trie of the height 2^k is cut at half its height into an upper trie and the forest that hangs on the cut prefixes, and both are cut
again, all of one height in parallel, until single turns are left. So a conversation of n turns takes log2(n) rounds instead of n,
and no task ever holds a conversation: rows are single turns, and every join and group is on a conversation and a place in it.

* *Down*: names of blocks of 2, 4, 8, ... turns are made from the names of their halves. Then every prefix that ends at a cut is named
  from the name of the prefix that its forest's parent cut at and the block between; after the last cut every prefix has a name. Names are
  SHA-256 digests, so equal prefixes get equal names without being brought together.
* *Up*: a node of depth d is a cut once, at the height of d's lowest set bit. By then its total holds all of its subtree as far down
  as the cut reaches, and is added to every ancestor in the upper trie, which the path of one conversation through the node lists.

Sums, counts and minima combine on the map side, so a first turn that a third of all conversations share is a row for each task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spotlift.llm.shared import written
from spotlift.operators.salting import ROWS_PER_TASK, SALT, hot_keys, replicate, spread

ROOT = bytes(32)
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class Rebuild:
    """Every conversation takes up to ``crc32(id) % heads`` turns from the first one of its ``century`` ids."""

    century: int = 100
    heads: int = 6


def _digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def turns(conversations: DataFrame) -> DataFrame:
    """``conv, name, points, range_no, at``: a row for every turn. ``at`` counts the rows of a range from some number on.

    Turns are ordered by ``turn``, nulls first, then by a digest of role and text. Places come from a range-partitioned, sorted
    table, so a conversation of any length is dealt over many tasks, and so are rows that all repeat one another.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        _digest(F.octet_length(role).cast("string").cast("binary"), F.lit(b":"), role.cast("binary"), text.cast("binary")).alias("name"),
        F.char_length(text).cast("long").alias("points"),
        F.monotonically_increasing_id().alias("row"),
    ).where("conv IS NOT NULL")
    order = [F.col("conv"), F.asc_nulls_first("turn"), F.col("name"), F.col("row")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.select("conv", "name", "points", F.spark_partition_id().alias("range_no"), F.monotonically_increasing_id().alias("at"))
    return written(ranged, "turns")


def rebuilt(conversations: DataFrame, rule: Rebuild = Rebuild()) -> tuple[DataFrame, DataFrame]:
    """The turns ``conv, place, name, points`` of all rebuilt conversations, places from 0, and ``conv`` of all, turnless ones too.

    Conversation c gets the first h turns of the original conversation ``c - c % century``, all if it has fewer and none if it is absent,
    then its own turns after its first h; h is ``crc32(c as text) % heads``.
    """
    rows = turns(conversations)
    # A conversation has one row here for each range it reaches into.
    stretches = rows.groupBy("conv", "range_no").agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv").orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    stretches = written(stretches.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long"))), "stretches")
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % rule.heads
    lengths = stretches.groupBy("conv").agg(F.sum("n").alias("length"))
    named = lengths.select("conv", (F.col("conv") - F.col("conv") % rule.century).alias("base"), head.alias("head"))
    bases = lengths.where(F.col("conv") % rule.century == 0).select(F.col("conv").alias("base"), F.col("length").alias("base_length"))
    known = written(
        named.join(bases, "base", "left").select("conv", "base", "head", F.least("head", F.coalesce("base_length", F.lit(0).cast("long"))).alias("taken")),
        "rebuilt",
    )
    placed = rows.join(stretches.join(known, "conv"), ["conv", "range_no"]).withColumn("place", F.expr("at - low + before"))
    own = placed.where("place >= head").select("conv", F.expr("place - head + taken").alias("place"), "name", "points")
    # Fewer than ``heads`` turns of one conversation in a century, for fewer than two centuries of ids.
    first = placed.where((F.col("place") < rule.heads) & (F.col("conv") == F.col("base")))
    first = first.select("base", "place", "name", "points")
    given = known.select("conv", "base", "taken").join(first, "base").where("place < taken")
    return written(own.unionByName(given.select("conv", "place", "name", "points")), "rebuilt-turns"), known.select("conv")


def _blocks(symbols: DataFrame, height: int) -> list[DataFrame]:
    """Names of all whole blocks of 1, 2, 4, ... turns (``conv, block, name``), up to half of 2^height."""
    levels = [symbols.select("conv", F.col("place").alias("block"), "name")]
    for _ in range(height - 1):
        half = F.when(F.col("block") % 2 == 0, F.col("name")), F.when(F.col("block") % 2 == 1, F.col("name"))
        pairs = levels[-1].groupBy("conv", F.expr("block div 2").alias("block")).agg(F.max(half[0]).alias("left"), F.max(half[1]).alias("right"))
        pairs = pairs.where("left IS NOT NULL AND right IS NOT NULL")
        levels.append(written(pairs.select("conv", "block", _digest(F.col("left"), F.col("right")).alias("name")), "blocks"))
    return levels


def prefixes(symbols: DataFrame, convs: DataFrame, height: int) -> DataFrame:
    """``conv, depth, name`` of every prefix of every conversation, the empty one included."""
    found = [convs.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("name"))]
    blocks = _blocks(symbols, height)
    for level in reversed(range(height)):
        # The cuts of this height: every name so far is the root of a trie whose upper half is one block high.
        roots = found[0]
        for more in found[1:]:
            roots = roots.unionByName(more)
        upper = blocks[level].where("block % 2 = 0").withColumnRenamed("name", "content")
        roots = roots.withColumn("block", F.expr(f"shiftright(depth, {level})"))
        cuts = roots.join(upper, ["conv", "block"])
        cuts = cuts.select("conv", (F.col("depth") + (1 << level)).alias("depth"), _digest(F.col("name"), F.col("content")).alias("name"))
        found.append(written(cuts, "prefixes"))
    named = found[0]
    for more in found[1:]:
        named = named.unionByName(more)
    return named


@dataclass(frozen=True)
class Trie:
    """``nodes`` has ``name, parent, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens``; the smallest member and the
    depth tell nodes apart as names do. ``ends`` has ``name, conv`` for every conversation and the node it ends at."""

    nodes: DataFrame
    ends: DataFrame


def prefix_trie(symbols: DataFrame, convs: DataFrame, rows_per_task: int = ROWS_PER_TASK, stretch: int = 4096) -> Trie:
    """The trie of the conversations ``convs`` with the turns ``symbols`` (``conv, place, name, points``; places count from 0).

    Conversations must differ in ``conv``. No conversations, no nodes. ``stretch`` bounds the turns of a conversation that a join
    brings together.
    """
    longest = symbols.agg(F.max("place")).first()[0]
    height = 0 if longest is None else int(longest + 1).bit_length()
    named = prefixes(symbols, convs, height)
    # One group for each conversation and depth: the prefix, the one before it and its last turn.
    parts = named.select("conv", "depth", "name", F.lit(None).cast("binary").alias("parent"), F.lit(None).cast("long").alias("points"))
    parts = parts.unionByName(named.select("conv", F.expr("depth + 1 AS depth"), F.lit(None).cast("binary").alias("name"), F.col("name").alias("parent"), F.lit(None).cast("long").alias("points")))
    last = symbols.select("conv", F.expr("place + 1 AS depth"), F.lit(None).cast("binary").alias("name"), F.lit(None).cast("binary").alias("parent"), "points")
    paths = written(parts.unionByName(last).groupBy("conv", "depth").agg(F.max("name").alias("name"), F.max("parent").alias("parent"), F.max("points").alias("points")), "paths")
    ends = paths.where("name IS NULL").select(F.col("parent").alias("name"), "conv")
    paths = paths.where("name IS NOT NULL")
    grouped = paths.groupBy("name").agg(
        F.min("conv").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("parent").alias("parent"),
        F.coalesce(F.max("points"), F.lit(0).cast("long")).alias("points"),
    )
    grouped = written(grouped, "trie-groups")
    below = grouped.where("parent IS NOT NULL").groupBy(F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = written(grouped.join(below, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "trie-nodes")
    totals = _totals(nodes, paths.select("conv", "depth", "name"), height, stretch)
    return Trie(_with_parents(nodes.join(totals, "name"), rows_per_task), ends)


def _totals(nodes: DataFrame, paths: DataFrame, height: int, stretch: int) -> DataFrame:
    """``name, n_leaves, saved_tokens`` over every node's subtree."""
    values = nodes.select(
        "name",
        "depth",
        F.col("conv_id").alias("conv"),
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        F.expr("(n_convs - 1) * points").alias("saved_tokens"),
    )
    known = values
    sums = [F.sum(c).alias(c) for c in ("n_leaves", "saved_tokens")]
    for level in range(height):
        half = 1 << level
        # Nodes whose depth has this lowest bit: the cut nodes of this height, on top of their forests.
        cuts = known.where(F.expr(f"depth > 0 AND depth & {2 * half - 1} = {half}")).groupBy("name", "depth").agg(F.max("conv").alias("conv"), *sums)
        size = min(half, stretch)
        cuts = cuts.select("conv", "n_leaves", "saved_tokens", F.explode(F.expr(f"sequence((depth - {half}) div {size}, (depth - 1) div {size})")).alias("part"))
        upper = paths.where(F.expr(f"depth & {half} = 0")).withColumn("part", F.expr(f"depth div {size}"))
        sent = upper.join(cuts, ["conv", "part"]).groupBy("name", "depth").agg(*sums)
        known = known.unionByName(written(sent, "grafts").withColumn("conv", F.lit(None).cast("long")))
    return known.groupBy("name").agg(*sums)


def _with_parents(nodes: DataFrame, rows_per_task: int) -> DataFrame:
    """The parent's smallest member at every node. Nodes with very many children are copied to as many tasks as their children need."""
    hot = hot_keys(nodes.select(F.col("name").alias("parent"), F.col("n_children").alias("rows")), "parent", rows_per_task)
    parents = nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return spread(nodes, "parent", hot).join(replicate(parents, "parent", hot), ["parent", SALT], "left").drop(SALT)


def _chunks(most: int):
    """The conversations of every run of one node in sorted rows as texts of about ``most`` ids, joined by commas."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def closed() -> tuple[bytes, int, str]:
            return node, ids[0], ",".join(map(str, ids))

        for batch in batches:
            out = []
            for name, conv in zip(batch.column("name").to_pylist(), batch.column("conv").to_pylist(), strict=True):
                if ids and (name != node or len(ids) >= most):
                    out.append(closed())
                    ids = []
                node = name
                ids.append(conv)
            yield _columns(out, ["name", "first", "ids"], [pa.binary(), pa.int64(), pa.string()])
        if ids:
            yield _columns([closed()], ["name", "first", "ids"], [pa.binary(), pa.int64(), pa.string()])

    return run


def _columns(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the texts of every run of one node, joined by commas, one text at a time."""
    node, state = None, None
    for batch in batches:
        out = []
        for name, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if state is not None and name == node:
                state.update(b"," + ids.encode())
                continue
            if state is not None:
                out.append((node, state.hexdigest()))
            node, state = name, hashlib.sha256(ids.encode())
        yield _columns(out, ["name", "ends_sha256"], [pa.binary(), pa.string()])
    if state is not None:
        yield _columns([(node, state.hexdigest())], ["name", "ends_sha256"], [pa.binary(), pa.string()])


def ends_digest(ends: DataFrame, most: int = 65536) -> DataFrame:
    """``name, ends_sha256``: the SHA-256 of the ascending ids of the conversations that end at each node.

    Ids are sorted and joined in ranges, so conversations that all end at one node are dealt over many tasks; what is left for one task
    is to hash that node's texts in turn, each of at most ``most`` ids.
    """
    texts = ends.repartitionByRange("name", "conv").sortWithinPartitions("name", "conv")
    texts = texts.mapInArrow(_chunks(most), "name binary, first long, ids string")
    return texts.repartition("name").sortWithinPartitions("name", "first").mapInArrow(_hashed, "name binary, ends_sha256 string")


def report(conversations: DataFrame, rule: Rebuild = Rebuild()) -> DataFrame:
    """A row for every node of the trie of rebuilt conversations (``conv_id``, ``turn``, ``role`` and ``text`` are read).

    A null role or text is empty; rows without ``conv_id`` are left out; rows that repeat a turn are turns of their own, ordered by a digest
    of role and text where turns tie. A table without conversations gives no rows, not even a root.
    """
    symbols, convs = rebuilt(conversations, rule)
    trie = prefix_trie(symbols, convs)
    rows = trie.nodes.join(ends_digest(trie.ends), "name", "left")
    return rows.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )
