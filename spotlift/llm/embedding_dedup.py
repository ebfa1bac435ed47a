"""Near-duplicate vectors by an exact metric range join.

Unit vectors of equal label whose cosine reaches the threshold lie within a fixed distance. A bounded set of pivots partitions the
vectors into cells by their nearest pivot; the triangle inequality tells which cells beyond its own a vector's partners can
lie in, and it is copied to those of a smaller number, so that every pair within the distance meets in exactly one cell. Cells
join on their own, in blocks of matrix products; a cell too large for a task is cut into blocks and each pair of blocks is a
task. A cell returns its vectors' numbers of links and only the links that join something new, never all pairs.

Equal vectors count as one, with a weight, from the beginning.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotlift.llm.components import connected_components
from spotlift.llm.grouped import Forest, block_pairs, sorted_groups
from spotlift.llm.shared import written


@dataclass(frozen=True)
class RangeJoin:
    """``pivots`` bounds what is sent to all tasks; a label has a cell
    for every ``cell`` vectors, as far as there are pivots; ``block`` rows bound a task."""

    cosine: float = 0.98
    pivots: int = 256
    cell: int = 1024
    block: int = 4096

    @property
    def reach(self) -> float:
        """The distance of unit vectors at the threshold, with room for rounding."""
        return float(np.sqrt(max(0.0, 2 - 2 * self.cosine))) + 1e-6


def unit_rows(vectors: pa.Array | pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """Vectors as unit rows of a matrix, shorter ones filled up with zeros."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    width = max(width, int(sizes.max(initial=0)))
    rows = np.zeros((len(sizes), width))
    rows[np.arange(width) < sizes[:, None]] = values
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _cells(pivots: np.ndarray, reach: float):
    """Every vector in its own cell (``home`` true) and copied to the cells of a smaller number that the inequality allows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                rows = unit_rows(part.column("embedding"), pivots.shape[1])
                width = rows.shape[1]
                known = np.zeros((len(pivots), width))
                known[:, : pivots.shape[1]] = pivots
                own = np.zeros(len(rows), np.int64)
                copies = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
                if len(known):
                    away = np.sqrt(np.maximum(0, 2 - 2 * rows @ known.T))
                    used = np.arange(len(known)) < np.maximum(part.column("cells").to_numpy(), 1)[:, None]
                    away[~used] = np.inf  # a label has as many cells as its size asks for
                    own = away.argmin(axis=1)
                    nearest = away[np.arange(len(rows)), own]
                    # A partner y at home in j has d(x,j) <= reach + d(y,j) <= reach + d(y,own) <= 2 reach + d(x,own).
                    near = away - nearest[:, None] <= 2 * reach
                    # In flat space a pair across the border of two cells lies within reach of the border itself.
                    apart = np.sqrt(np.maximum(1e-12, ((known[:, None, :] - known[None, :, :]) ** 2).sum(axis=2)))[own]
                    near &= away**2 - nearest[:, None] ** 2 <= 2 * reach * apart + 1e-6
                    near &= used & (np.arange(len(known)) < own[:, None])
                    copies.append(np.nonzero(near))
                row = np.concatenate([np.arange(len(rows)), *[c[0] for c in copies]])
                cell = np.concatenate([own, *[c[1] for c in copies]])
                home = np.arange(len(row)) < len(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("label").take(pa.array(row)),
                        pa.array(cell),
                        part.column("vec_id").take(pa.array(row)),
                        part.column("weight").take(pa.array(row)),
                        part.column("embedding").take(pa.array(row)),
                        pa.array(home),
                        part.column("class").take(pa.array(row)),
                    ],
                    ["label", "cell", "vec_id", "weight", "embedding", "home", "class"],
                )

    return run


def _join_cell(cosine: float):
    """For every row of a cell the weight of its links there and the smallest vector they lead to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["label", "cell", "bi", "bj"]):
            ids = group.column("vec_id").to_numpy()
            home = group.column("home").to_numpy()
            order = np.lexsort((ids, ~home))  # those at home first
            ids, home = ids[order], home[order]
            classes = group.column("class").to_numpy()[order]
            crossing = group.column("bi")[0].as_py() != group.column("bj")[0].as_py()  # one of the two blocks may be empty
            side = group.column("side").to_numpy()[order]
            weight = group.column("weight").to_numpy()[order]
            rows = unit_rows(group.column("embedding"))[order]
            inside = int(home.sum())
            links = np.zeros(len(ids), np.int64)
            forest = Forest(len(ids))
            for low in range(0, inside, 512):
                here = np.arange(low, min(low + 512, inside))
                alike = rows[here] @ rows.T >= cosine  # copies meet only those at home
                alike[np.arange(len(here)), here] = False
                if crossing:
                    alike &= side[here][:, None] != side
                links[here] += alike @ weight
                links[inside:] += weight[here] @ alike[:, inside:]
                for k in np.flatnonzero(alike.any(axis=1)):
                    i = low + int(k)
                    for root in np.unique(forest.of[alike[k]]):
                        forest.join(i, int(root))
            least = np.full(len(ids), np.iinfo(np.int64).max)
            np.minimum.at(least, forest.of, ids)
            linked = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(classes[linked]), pa.array(ids[linked]), pa.array(links[linked]), pa.array(least[forest.of[linked]])],
                ["class", "vec_id", "links", "least"],
            )

    return run


def near_duplicates(vectors: DataFrame, config: RangeJoin = RangeJoin()) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors`` (``vec_id``, ``embedding``, ``label``).

    Vectors that are null, empty, zero or hold a null or non-finite component, and rows without label or id, link with nothing and are kept;
    without an id there is no component either. Vectors of unequal length compare as if filled up with zeros. A row that repeats another links
    with it; rows of one ``vec_id`` share a component.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("string").alias("label")
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = finite & F.exists("embedding", lambda x: x != 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    classes = written(
        rows.where("usable").groupBy("label", "embedding").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("weight"))
        .withColumn("class", F.monotonically_increasing_id()),  # one id can have several vectors, so it cannot name a class
        "vectors",
    )
    spread = classes.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / config.cell).alias("cells"))
    marked = classes.join(spread, "label")
    chosen = marked.where("cells > 1").orderBy(F.xxhash64("label", "vec_id"), "vec_id").select("embedding").limit(config.pivots).collect()
    pivots = unit_rows(pa.array([r["embedding"] for r in chosen], pa.list_(pa.float64()))) if chosen else np.zeros((0, 0))
    pivots = _apart(pivots, config)
    cells = marked.select("label", "vec_id", "weight", "embedding", "cells", "class").mapInArrow(
        _cells(pivots, config.reach), "label string, cell long, vec_id long, weight long, embedding array<double>, home boolean, class long"
    )
    cells = written(cells, "cells")
    sizes = cells.groupBy("label", "cell").agg(F.ceil(F.count(F.lit(1)) / config.block).alias("blocks"))
    dealt = block_pairs(cells.join(sizes, ["label", "cell"]), "cell", "class", "blocks")
    keys = ["label", "cell", "bi", "bj"]
    dealt = dealt.select(*keys, "side", "vec_id", "weight", "embedding", "home", "class").repartition(*keys).sortWithinPartitions(*keys)
    found = written(dealt.mapInArrow(_join_cell(config.cosine), "class long, vec_id long, links long, least long"), "vector-links")
    same = rows.where("usable").join(classes.withColumnRenamed("vec_id", "first"), ["label", "embedding"])
    members = written(same.select("vec_id", "first", "class", "weight"), "vector-classes")
    edges = found.select(F.col("vec_id").alias("u"), F.col("least").alias("v"))
    edges = edges.unionByName(members.where("vec_id <> first").select(F.col("vec_id").alias("u"), F.col("first").alias("v")))
    parts = connected_components(edges).withColumnRenamed("node", "vec_id")
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    # A vector's links: those of its class to other classes, and the other members of the class.
    linked = members.join(links, "class", "left").select("vec_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    linked = linked.unionByName(rows.where("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links")))
    return linked.join(parts, "vec_id", "left").select(
        "vec_id",
        "n_links",
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.col("component") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )


def _apart(pivots: np.ndarray, config: RangeJoin) -> np.ndarray:
    """Pivots that are more than twice the reach from one another, so that near copies of one vector do not crowd the set."""
    kept: list[int] = []
    for i in range(len(pivots)):
        if all(np.linalg.norm(pivots[i] - pivots[k]) > 2 * config.reach for k in kept):
            kept.append(i)
    return pivots[kept]
