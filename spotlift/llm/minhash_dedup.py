"""Near-duplicate documents: many universal hash minima, banding, signature verification, components by stars.

1. Each text becomes a set of hashed word shingles; ``bands`` x ``rows`` hash functions of the form a*x + b modulo 2^64 give
   its minima, and the minima of a band together give a bucket. Texts of equal sets count as one from here on.
2. Texts that share a bucket are compared by their signatures (8 bits of each minimum). Agreement far below the threshold, six
   standard deviations, rules a pair out. Only links that join something new leave a bucket, never all pairs.
3. The groups that these links form are checked on the full shingle sets, recomputed from the whole texts; again only links
   that join something new are returned, but every possible link between unjoined texts is looked at.
4. Components come from the confirmed links.

A bucket or group beyond a block's size is cut into blocks and every pair of blocks is a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotlift.llm.components import connected_components
from spotlift.llm.grouped import Forest, block_pairs, sorted_groups
from spotlift.llm.shared import without, written
from spotlift.llm.textkernel import STEP, U, WordHasher, column_bytes, mix, row_slices, windows

_FACTOR = 0xD6E8FEB86659FD93
_OWN = ("n_shingles", "component_id", "kept")


@dataclass(frozen=True)
class MinHash:
    """``shingle`` words, ``percent`` similarity as intersection over union; ``bands`` of ``rows`` minima.

    At the threshold 0.85 and 28 bands of 6, a linked pair shares no bucket with probability 2e-6.
    ``bucket_block`` rows and ``group_block`` shingles bound what one task holds of a bucket or a group.
    """

    shingle: int = 5
    percent: int = 85
    bands: int = 28
    rows: int = 6
    seed: int = 20
    bucket_block: int = 4096
    group_block: int = 1 << 22

    @property
    def least_agreement(self) -> int:
        """Equal minima that a linked pair has but for chances beyond six standard deviations."""
        share, count = self.percent / 100, self.bands * self.rows
        return max(0, int(count * (share - 6 * sqrt(share * (1 - share) / count))))


class _Shingler:
    def __init__(self, config: MinHash):
        self.config, self.hasher = config, WordHasher(lower=True)
        rng = np.random.default_rng(config.seed)
        count = config.bands * config.rows
        self.a = (rng.integers(0, 2**63, count, dtype=np.uint64) * U(2) + U(1))[:, None]
        self.b = rng.integers(0, 2**63, count, dtype=np.uint64)[:, None]

    def sets(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The sorted distinct shingle hashes of every row."""
        size = self.config.shingle
        data, offsets = column_bytes(column)
        for low, high in row_slices(offsets):
            words = self.hasher.words(data, offsets[low : high + 1])
            all_shingles = windows(words.hashes, size, _FACTOR)
            for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True):
                if b - a >= size:
                    yield np.unique(all_shingles[a : b - size + 1])
                elif b > a:  # the whole short sequence; its length keeps it apart from longer ones
                    yield windows(words.hashes[a:b], int(b - a), _FACTOR) ^ U(b - a)
                else:
                    yield np.zeros(0, U)

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        result = (self.a * shingles[:4096] + self.b).min(axis=1)
        for at in range(4096, len(shingles), 4096):
            np.minimum(result, (self.a * shingles[at : at + 4096] + self.b).min(axis=1), out=result)
        return result

    def signature(self, minima: np.ndarray) -> bytes:
        return (mix(minima) >> U(56)).astype(np.uint8).tobytes()

    def buckets(self, minima: np.ndarray) -> np.ndarray:
        config = self.config
        keys = windows(np.arange(config.bands, dtype=U), 1, _FACTOR)
        for row in minima.reshape(config.bands, config.rows).T:
            keys = mix(keys * U(_FACTOR) + row)
        return keys.view(np.int64)


def _sign(config: MinHash):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = _Shingler(config)
        for batch in batches:
            sizes, prints, signatures, buckets = [], [], [], []
            for shingles in shingler.sets(batch.column(1)):
                sizes.append(len(shingles))
                if len(shingles):
                    minima = shingler.minima(shingles)
                    prints.append(tuple(int(mix(shingles ^ U(salt)).sum(dtype=U).view(np.int64)) for salt in (0xA5A5, 0x5A5A5A)))
                    signatures.append(shingler.signature(minima))
                    buckets.append(shingler.buckets(minima))
                else:
                    prints.append((None, None))
                    signatures.append(None)
                    buckets.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array([p[0] for p in prints], pa.int64()),
                    pa.array([p[1] for p in prints], pa.int64()),
                    pa.array(signatures, pa.binary()),
                    pa.array(buckets, pa.list_(pa.int64())),
                    batch.column(2),
                ],
                ["doc_id", "n_shingles", "print_a", "print_b", "signature", "buckets", "text_key"],
            )

    return run


def _edges(left: list[int], right: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["u", "v"])


def _star(nodes: np.ndarray, forest: Forest, left: list[int], right: list[int]) -> None:
    """The sets of a forest as links to their smallest node."""
    moved = np.flatnonzero(forest.of != np.arange(len(nodes)))
    if len(moved):
        for root in np.unique(forest.of[moved]):
            members = nodes[forest.of == root]
            least = int(members.min())
            for node in members[members != least]:
                left.append(int(node))
                right.append(least)


def _alike_signatures(least: int):
    """Links between rows of a bucket whose signatures agree often enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: list[int] = []
        right: list[int] = []
        for group in sorted_groups(batches, ["bucket", "bi", "bj"]):
            if group.num_rows < 2:
                continue
            nodes = group.column("node").to_numpy()
            side = group.column("side").to_numpy()
            signs = np.array([np.frombuffer(x, np.uint8) for x in group.column("signature").to_pylist()])
            crossing = bool(side.any())
            forest = Forest(len(nodes))
            for i in range(len(nodes) - 1):
                others = np.flatnonzero(side != side[i]) if crossing else np.arange(i + 1, len(nodes))
                if crossing and side[i]:
                    continue
                others = others[forest.of[others] != forest.of[i]]
                for j in others[(signs[others] == signs[i]).sum(axis=1) >= least]:
                    forest.join(i, j)
            _star(nodes, forest, left, right)
            if len(left) > 20_000:
                yield _edges(left, right)
                left, right = [], []
        yield _edges(left, right)

    return run


def _reshingle(config: MinHash):
    """Rows with the text's sorted shingle hashes and signature in its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = _Shingler(config)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                sets = list(shingler.sets(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("grp").cast(pa.int64()),
                        part.column("node").cast(pa.int64()),
                        part.column("blocks").cast(pa.int64()),
                        pa.array([s.tobytes() for s in sets], pa.large_binary()),
                        pa.array([shingler.signature(shingler.minima(s)) if len(s) else None for s in sets], pa.binary()),
                    ],
                    ["grp", "node", "blocks", "shingles", "signature"],
                )

    return run


def _alike_sets(percent: int, least: int):
    """Links between rows of a group confirmed on full sets: 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["grp", "bi", "bj"]):
            if group.num_rows < 2:
                continue
            nodes = group.column("node").to_numpy()
            side = group.column("side").to_numpy()
            signs = np.array([np.frombuffer(x, np.uint8) for x in group.column("signature").to_pylist()])
            sets = [np.frombuffer(x, U) for x in group.column("shingles").to_pylist()]
            sizes = np.array([len(s) for s in sets])
            names, codes = np.unique(np.concatenate(sets), return_inverse=True)  # shingles as small numbers
            starts = np.concatenate([[0], np.cumsum(sizes)])
            has = np.zeros(len(names), np.bool_)
            crossing = bool(side.any())
            forest = Forest(len(nodes))
            for i in range(len(nodes)):
                if crossing and side[i]:
                    continue
                others = np.flatnonzero(side != side[i]) if crossing else np.arange(i + 1, len(nodes))
                others = others[forest.of[others] != forest.of[i]]
                small, large = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
                others = others[100 * small >= percent * large]
                if not len(others):
                    continue
                others = others[(signs[others] == signs[i]).sum(axis=1) >= least]
                if not len(others):
                    continue
                has[codes[starts[i] : starts[i + 1]]] = True
                for j in others:
                    if forest.of[j] != forest.of[i]:
                        both = int(np.count_nonzero(has[codes[starts[j] : starts[j + 1]]]))
                        if 100 * both >= percent * (sizes[i] + sizes[j] - both):
                            forest.join(i, j)
                has[codes[starts[i] : starts[i + 1]]] = False
            left: list[int] = []
            right: list[int] = []
            _star(nodes, forest, left, right)
            yield _edges(left, right)

    return run


def signed(docs: DataFrame, config: MinHash = MinHash()) -> DataFrame:
    """For every row: set size, fingerprint of the set, signature, buckets and a hash of the text; written to the shared folder."""
    layout = "doc_id long, n_shingles long, print_a long, print_b long, signature binary, buckets array<long>, text_key long"
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return written(rows.withColumn("text_key", F.xxhash64("text")).mapInArrow(_sign(config), layout), "minhash")


def near_duplicates(docs: DataFrame, config: MinHash = MinHash()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (``doc_id`` and ``text`` are read).

    A null or empty text, or one of blanks only, has no shingles, links with nothing and is kept. Rows that repeat a ``doc_id`` are one
    document with several texts: they share its component. A row without ``doc_id`` has no component and is kept. However often a row or a
    set is repeated, it is compared once.
    """
    marks = signed(docs, config)
    nodes = marks.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = nodes.groupBy("print_a", "print_b").agg(F.min(F.struct(F.col("doc_id").alias("node"), F.col("text_key").alias("key"))).alias("least"))
    classes = classes.select("print_a", "print_b", "least.node", F.col("least.key").alias("node_key"))
    # One row for each class of equal sets stands for it, also where that row is repeated.
    first = nodes.join(classes, ["print_a", "print_b"]).where("doc_id = node AND text_key = node_key").dropDuplicates(["print_a", "print_b"])
    first = written(first.select("node", "text_key", "print_a", "print_b", "n_shingles", "signature", "buckets"), "minhash-classes")
    links = _confirmed(docs, first, config)
    # Several texts of one doc_id hang together, as do equal sets.
    same = nodes.join(classes, ["print_a", "print_b"]).where("doc_id <> node").select(
        F.col("doc_id").alias("u"), F.col("node").alias("v")
    )
    parts = connected_components(links.unionByName(same))
    return (
        marks.select("doc_id", "n_shingles")
        .join(parts.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("component", "doc_id").alias("component_id"),
            F.coalesce(F.col("component") == F.col("doc_id"), F.lit(True)).alias("kept"),
        )
    )


def _confirmed(docs: DataFrame, first: DataFrame, config: MinHash) -> DataFrame:
    """Links ``u, v`` between classes, as many as their components need, each confirmed on full sets."""
    prints = ["print_a", "print_b"]
    spread = first.select("node", *prints, F.explode("buckets").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / config.bucket_block).alias("blocks")
    members = spread.join(shared, "bucket").select("bucket", "node", *prints, blocks)
    members = block_pairs(members.join(first.select(*prints, "signature"), prints), "bucket", "print_a", "blocks")
    keys = ["bucket", "bi", "bj"]
    dealt = members.select(*keys, "side", "node", "signature").repartition(*keys).sortWithinPartitions(*keys)
    likely = dealt.mapInArrow(_alike_signatures(config.least_agreement), "u long, v long")

    groups = connected_components(likely).withColumnRenamed("component", "grp")
    sized = groups.join(first.select("node", "text_key", "n_shingles"), "node")
    sums = sized.groupBy("grp").agg(F.ceil(F.sum("n_shingles") / config.group_block).alias("blocks"))
    wanted = sized.select("grp", "node", "text_key").join(sums, "grp")
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string")).withColumn("text_key", F.xxhash64("text"))
    # One text for each class; the join has dealt rows by these two columns already.
    texts = texts.join(wanted, ["node", "text_key"]).dropDuplicates(["node", "text_key"])
    sets = texts.select("grp", "node", "blocks", "text").mapInArrow(
        _reshingle(config), "grp long, node long, blocks long, shingles binary, signature binary"
    )
    keys = ["grp", "bi", "bj"]
    dealt = block_pairs(sets.where("signature IS NOT NULL"), "grp", "signature", "blocks").select(*keys, "side", "node", "signature", "shingles")
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(_alike_sets(config.percent, config.least_agreement), "u long, v long")


def deduplicated(docs: DataFrame, config: MinHash = MinHash()) -> DataFrame:
    """``docs`` with one document of each component left, all columns as they were.

    Of rows that repeat a kept ``doc_id`` all stay if their texts differ, and equal rows stay as they are: rows are judged by document.
    """
    gone = near_duplicates(docs.select("doc_id", "text"), config).where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
