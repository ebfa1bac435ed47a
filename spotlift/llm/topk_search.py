"""Exact top-k inner products over norm-sorted vectors.

Components are turned into integers first. Candidates are dealt to ranges of length, longest first. The longest ones, a bounded number,
give every query a score that its k-th best can only exceed; a query then visits just the ranges whose longest vector could
reach that score. Queries that visit equally many ranges share a part, so a range is copied only to the parts that visit it. Inside a range, vectors and queries are rotated by the singular vectors of a bounded sample, so that a few leading
coordinates hold most of a product; partial sums over them plus the Cauchy-Schwarz bound of the rest rule out most candidates, and the
others are scored exactly in integers. Rounding only ever widens a bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spotlift.llm.grouped import sorted_groups
from spotlift.llm.shared import written


@dataclass(frozen=True)
class Search:
    """``head`` longest vectors and ``sample`` vectors for the rotation go to the driver; ``block`` candidates and ``queries`` a task.

    ``ranges`` bounds the ranges of length, evenly over all rows: beyond it a range holds more blocks, each still of ``block`` rows.
    """

    k: int = 5
    scale: int = 256
    head: int = 2048
    sample: int = 2048
    block: int = 8192
    queries: int = 1024
    ranges: int = 2000
    leading: int = 16


def matrix(vectors: list, width: int = 0) -> np.ndarray:
    """Integer vectors as rows, shorter ones filled up with zeros."""
    width = max(width, max((len(v) for v in vectors), default=0))
    rows = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        rows[i, : len(v)] = v
    return rows


def exact_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of both; as doubles where those are exact."""
    width = max(left.shape[1], right.shape[1])
    left, right = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (left, right))
    most = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * max(1, width)
    if most < 2**53:
        return (left.astype(float) @ right.astype(float).T).astype(np.int64)
    return left @ right.T


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= edge)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def _floors(head_ids: np.ndarray, head: np.ndarray, k: int):
    """Every query with the k-th best score among the longest vectors, its own row left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                ids = part.column("query_id").to_numpy()
                rows = matrix(part.column("q").to_pylist())
                scores = exact_products(rows, head)
                scores = np.where(head_ids[None, :] == ids[:, None], np.iinfo(np.int64).min, scores)
                if scores.shape[1] >= k + 1:
                    floor = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k].astype(float)
                else:
                    floor = np.full(len(ids), -np.inf)
                yield pa.RecordBatch.from_arrays(
                    [part.column("query_id"), part.column("copy"), part.column("q"), part.column("q_norm"), pa.array(floor)],
                    ["query_id", "copy", "q", "q_norm", "floor"],
                )

    return run


def _search(rotation: np.ndarray, config: Search):
    """The k best of a range's candidates for each query that visits it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["block", "part"]):
            is_query = group.column("is_query").to_numpy(zero_copy_only=False)
            ids = group.column("id").to_numpy()
            listed = group.column("v").to_pylist()
            floors = group.column("floor").to_numpy(zero_copy_only=False)
            copies = group.column("copy").to_numpy()
            c_at, q_at = np.flatnonzero(~is_query), np.flatnonzero(is_query)
            if not len(c_at) or not len(q_at):
                continue
            rows = matrix(listed, len(rotation))
            lengths = np.linalg.norm(rows[c_at].astype(float), axis=1)
            c_at = c_at[np.argsort(-lengths, kind="stable")]
            turn = rotation if len(rotation) == rows.shape[1] else np.eye(rows.shape[1])
            turned = rows.astype(float) @ turn
            lead = config.leading
            rest = np.sqrt(np.maximum(0, (turned[:, lead:] ** 2).sum(axis=1)))
            lengths = np.linalg.norm(rows.astype(float), axis=1)
            out = []
            for q in q_at:
                found_ids, found = np.zeros(0, np.int64), np.zeros(0, np.int64)
                floor = floors[q]
                slack = 1e-9 * lengths[q]
                for low in range(0, len(c_at), 1024):
                    some = c_at[low : low + 1024]
                    if lengths[q] * lengths[some[0]] * (1 + 1e-9) < floor:
                        break  # sorted by length: nothing behind can reach the floor
                    bound = turned[some, :lead] @ turned[q, :lead] + rest[some] * rest[q] + slack * lengths[some]
                    some = some[(bound >= floor) & (ids[some] != ids[q])]
                    if len(some):
                        scores = exact_products(rows[q : q + 1], rows[some])[0]
                        found_ids, found = np.concatenate([found_ids, ids[some]]), np.concatenate([found, scores])
                        best = _best(found, found_ids, config.k)
                        found_ids, found = found_ids[best], found[best]
                        if len(found) == config.k:
                            floor = max(floor, float(found[-1]))
                out += [(int(ids[q]), int(copies[q]), int(i), int(s)) for i, s in zip(found_ids, found, strict=True)]
            columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "copy", "vec_id", "score"])

    return run


def _looked_up(values: dict[int, int], key: str) -> Column:
    """The value of a short table, one entry for each range at most, under the key in a column."""
    if not values:
        return F.lit(None).cast("long")
    entries = [F.struct(F.lit(k).cast("long"), F.lit(v).cast("long")) for k, v in values.items()]
    return F.element_at(F.map_from_entries(F.array(*entries)), F.col(key))


def top_k(vectors: DataFrame, is_query, config: Search = Search()) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row of ``vectors`` (``vec_id``, ``embedding``) that ``is_query`` picks, its k best others.

    Rows without id, and vectors that are null or hold null or non-finite components, take no part. Shorter vectors compare as if filled up with
    zeros. A query's own are all rows of its id. Of equal rows each is a candidate; a repeated query gives its answer once. Components beyond the range of a long
    after scaling fail the run.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding")).where(
        F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False))
    )
    whole = F.transform("embedding", lambda x: F.floor(x * float(config.scale)).cast("long"))
    rows = rows.select("vec_id", whole.alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    rows = written(rows.withColumn("norm", norm), "integer-vectors")
    head = rows.orderBy(F.desc("norm"), "vec_id").limit(config.head).select("vec_id", "v").collect()
    if not head:
        return rows.select(
            F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.col("vec_id").alias("score")
        ).limit(0)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(config.sample).select("v").collect()
    shown = matrix([r["v"] for r in sample]).astype(float)
    rotation = np.linalg.svd(shown, full_matrices=True)[2].T if shown.shape[1] else np.zeros((0, 0))

    # Ranges of length: equal lengths fall together, so a block beyond its size is dealt on by a hash.
    total = rows.count()
    wanted = min(max(1, -(-total // config.block)), config.ranges)
    levels = np.linspace(0, 1, wanted + 1)[1:-1].tolist()
    cuts = sorted(set(rows.approxQuantile("norm", levels, 0.2 / (wanted + 1)))) if levels else []
    place = F.lit(len(cuts)).cast("long") - F.aggregate(
        F.array(*[F.lit(c) for c in cuts]).cast("array<double>"), F.lit(0).cast("long"), lambda n, c: n + (F.col("norm") > c).cast("long")
    )
    ranged = rows.withColumn("range", place)
    sizes = ranged.groupBy("range").agg(F.max("norm").alias("longest"), F.ceil(F.count(F.lit(1)) / config.block).alias("pieces"))
    sizes = written(sizes, "ranges")  # one row for each range
    listed = [(int(r["range"]), float(r["longest"]), int(r["pieces"])) for r in sizes.collect()]
    pieces_of = {r: n for r, _, n in listed}
    spread = F.array(*[F.struct(F.lit(r).cast("long").alias("range"), F.lit(m).alias("longest"), F.lit(n).cast("long").alias("pieces")) for r, m, n in listed])

    asked = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "v", "norm").groupBy("query_id", "v").agg(
        F.first("norm").alias("q_norm")
    ).select("query_id", F.xxhash64("v").alias("copy"), F.col("v").alias("q"), "q_norm")
    head_ids = np.array([r["vec_id"] for r in head])
    asked = asked.mapInArrow(
        _floors(head_ids, matrix([r["v"] for r in head]), config.k),
        "query_id long, copy long, q array<long>, q_norm double, floor double",
    )
    asked = written(asked, "queries")
    # Ranges are numbered from the longest on, so what a query visits is a first few of them, up to its reach. Parts are numbered
    # from the farthest reach on: then a range goes to a first few parts, those whose queries reach it.
    visited = F.filter(spread, lambda r: F.col("q_norm") * r["longest"] * (1 + 1e-9) >= F.col("floor"))
    asked = asked.withColumn("visited", visited).where(F.size("visited") > 0)
    asked = asked.withColumn("reach", F.array_max(F.transform("visited", lambda r: r["range"])))
    reached = asked.groupBy("reach").agg(F.ceil(F.count(F.lit(1)) / config.queries).alias("parts")).collect()  # a row for each range at most
    first, shares, n_parts = {}, {}, 0
    for row in sorted(reached, key=lambda r: -r["reach"]):
        first[row["reach"]], shares[row["reach"]] = n_parts, row["parts"]
        n_parts += row["parts"]
    upto = {r: sum(n for reach, n in shares.items() if reach >= r) for r in pieces_of}
    share = F.pmod(F.xxhash64("query_id", "copy"), _looked_up(shares, "reach"))
    visits = asked.withColumn("part", _looked_up(first, "reach") + share).withColumn("to", F.explode("visited"))
    visits = visits.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("to.pieces") - 1)))
    visits = visits.select(
        F.concat_ws(":", "to.range", "piece").alias("block"), "part", F.lit(True).alias("is_query"), F.col("query_id").alias("id"), F.col("q").alias("v"), "floor", "copy"
    )
    piece = F.pmod(F.xxhash64("vec_id"), _looked_up(pieces_of, "range"))
    offered = ranged.withColumn("parts", _looked_up(upto, "range")).where("parts > 0").select(
        F.concat_ws(":", "range", piece).alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
        F.lit(False).alias("is_query"),
        F.col("vec_id").alias("id"),
        "v",
        F.lit(0.0).alias("floor"),
        F.lit(0).cast("long").alias("copy"),
    )
    dealt = offered.unionByName(visits).repartition("block", "part").sortWithinPartitions("block", "part")
    found = dealt.mapInArrow(_search(rotation, config), "query_id long, copy long, vec_id long, score long")
    # Rows of one query id with unlike vectors answer as one query: the best of all.
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= config.k)
    return ranked.select("query_id", "rank", "vec_id", "score")
