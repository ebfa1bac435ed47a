"""Isolation forest (Liu, Ting, Zhou: "Isolation Forest", ICDM 2008) as Spark jobs.

Sampling, tree building and scoring are distributed; only the finished trees, at most
``2 * sample - 1`` nodes each, pass through the driver. Draws and splits come from MD5 digests of
row contents and node numbers, so the same rows give the same forest at any size and partitioning,
and SQL can recompute it. Splits depend on the order and the relative position of values only, so
scaling the features first would not change the result.
"""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

# The two Python functions below travel to the executors by value: the package itself need
# not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODE_SCHEMA = (
    "tree_id int, node_id int, feature int, threshold double, left_id int, right_id int, size int, path double"
)
#: Draws are numbers below this prime; products of two stay below 2^63.
_PRIME = (1 << 31) - 1
#: Copies of one row that are listed together.
_COPIES = 100_000


def mean_path_length(n: int) -> float:
    """Average depth of an unsuccessful search among ``n`` values, c(n) in the paper."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + np.euler_gamma) - 2.0 * (n - 1) / n


def _digits(text: str, count: int = 13) -> int:
    """The first hexadecimal digits of a text's MD5 digest as a number; 13 of them are exact in a double."""
    return int(hashlib.md5(text.encode()).hexdigest()[:count], 16)


def _grow(x: np.ndarray, seed: int, tree_id: int) -> list[tuple]:
    """Nodes of one tree: (node, feature or -1, threshold, left, right, size, path length).

    The root has place 1 and the children of place ``i`` have ``2 * i`` and ``2 * i + 1``; seed, tree and place decide a
    node's feature, among those that differ, and the threshold between that feature's ends.
    """
    limit = math.ceil(math.log2(max(len(x), 2)))
    nodes: list[tuple] = []
    todo = [(0, 1, np.arange(len(x)), 0)]
    next_id = 1
    while todo:
        node, place, rows, depth = todo.pop()
        part = x[rows]
        low, high = part.min(axis=0), part.max(axis=0)
        splittable = np.flatnonzero(high > low)
        if depth >= limit or len(splittable) == 0:
            nodes.append((node, -1, 0.0, -1, -1, len(rows), depth + mean_path_length(len(rows))))
            continue
        name = f"{seed}:{tree_id}:{place}"
        feature = int(splittable[_digits(f"{name}:feature") % len(splittable)])
        threshold = float(low[feature] + (high[feature] - low[feature]) * (_digits(f"{name}:threshold") / 2.0**52))
        if threshold >= high[feature]:  # rounding may reach the upper end; keep both sides filled
            threshold = float(low[feature])
        goes_left = part[:, feature] <= threshold
        nodes.append((node, feature, threshold, next_id, next_id + 1, len(rows), float(depth)))
        todo.append((next_id, 2 * place, rows[goes_left], depth + 1))
        todo.append((next_id + 1, 2 * place + 1, rows[~goes_left], depth + 1))
        next_id += 2
    return nodes


@dataclass(frozen=True)
class Forest:
    """Fitted trees as a small pandas table in the layout of ``NODE_SCHEMA``."""

    features: tuple[str, ...]
    sample_size: int
    nodes: pd.DataFrame

    def to_spark(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.nodes, NODE_SCHEMA)

    def flat(self) -> dict[str, np.ndarray]:
        """Nodes of all trees end to end; a leaf is its own child on both sides."""
        nodes = self.nodes.sort_values(["tree_id", "node_id"])
        sizes = nodes.groupby("tree_id").size().to_numpy()
        roots = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        start = np.repeat(roots, sizes)
        leaf = nodes["feature"].to_numpy() < 0
        own = np.arange(len(nodes))
        return {
            "roots": roots,
            "feature": np.where(leaf, 0, nodes["feature"].to_numpy()),
            "threshold": nodes["threshold"].to_numpy(),
            "left": np.where(leaf, own, start + nodes["left_id"].to_numpy()),
            "right": np.where(leaf, own, start + nodes["right_id"].to_numpy()),
            "path": nodes["path"].to_numpy(),
        }


def _named_rows(df: DataFrame, features: Sequence[str], key: Sequence[str]) -> DataFrame:
    """``(name, *features)``: every row with an MD5 name of its key, its features and its number among equal rows."""
    own = [F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)]
    own += [F.col(c).cast("string").alias(f"k{i}") for i, c in enumerate(key)]
    counted = df.select(*own).groupBy(*[f"f{i}" for i in range(len(features))], *[f"k{i}" for i in range(len(key))])
    # A row's copies are counted on the map side and listed a stretch at a time, so however many they are no array is long.
    copies = (
        counted.agg(F.count("*").alias("n"))
        .withColumn("stretch", F.expr(f"explode(sequence(0L, (n - 1) div {_COPIES}))"))
        .withColumn("copy", F.expr(f"explode(sequence(stretch * {_COPIES}, least(n, (stretch + 1) * {_COPIES}) - 1))"))
    )
    keys = [F.coalesce(f"k{i}", F.lit("")) for i in range(len(key))]
    values = [F.coalesce(F.expr(f"cast(try_cast(f{i} AS decimal(38, 6)) AS string)"), F.lit("")) for i in range(len(features))]
    name = F.md5(F.concat_ws("|", *keys, *values, F.col("copy").cast("string")).cast("binary"))
    return copies.select(name.alias("name"), *[F.col(f"f{i}").alias(c) for i, c in enumerate(features)])


def draw_samples(
    df: DataFrame, features: Sequence[str], key: Sequence[str], trees: int, sample: int, seed: int, share: float = 1.0
) -> DataFrame:
    """``(tree_id, rank, *features)``: for every tree the ``sample`` rows with the lowest draws, all rows if they are fewer.

    A row's draw for a tree is an affine function, of that tree's own, of the number in the row's name. Draws
    above ``share`` of their range are left out before the ranking. That changes nothing as long as ``sample`` of a tree's
    draws remain; a tree that is short of rows shows that ``share`` was too small.
    """
    slope = [1 + _digits(f"{seed}:{t}:slope", 7) for t in range(trees)]
    shift = [_digits(f"{seed}:{t}:shift", 7) for t in range(trees)]
    number = F.expr(f"cast(conv(substring(name, 1, 13), 16, 10) AS bigint) % {_PRIME}L")
    draws = F.expr(
        f"inline(filter(transform(slopes, (a, t) -> struct(t AS tree_id, (number * a + shifts[t]) % {_PRIME}L AS pick)), "
        f"d -> d.pick < {math.ceil(_PRIME * min(share, 1.0))}L))"
    )
    listed = _named_rows(df, features, key).select(
        "*",
        number.alias("number"),
        F.array(*[F.lit(a).cast("long") for a in slope]).alias("slopes"),
        F.array(*[F.lit(c).cast("long") for c in shift]).alias("shifts"),
    )
    order = Window.partitionBy("tree_id").orderBy("pick", "name")
    return (
        listed.select("name", *features, draws)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= sample)
        .select("tree_id", "rank", *features)
    )


def fit_forest(
    df: DataFrame, features: Sequence[str], key: Sequence[str], trees: int = 100, sample: int = 256, seed: int = 42
) -> Forest:
    """Grow ``trees`` trees, each from ``min(sample, rows)`` rows. ``df`` is read twice, and again if a draw fell short."""
    features = tuple(features)
    rows = df.count()
    if rows == 0:
        raise ValueError("no rows to fit a forest on")

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        tree_id = int(group["tree_id"].iloc[0])
        x = group.sort_values("rank")[list(features)].to_numpy(dtype=float)
        out = pd.DataFrame(
            _grow(x, seed, tree_id), columns=["node_id", "feature", "threshold", "left_id", "right_id", "size", "path"]
        )
        out.insert(0, "tree_id", tree_id)
        return out

    wanted = min(sample, rows)
    # The samples are few and small; left alone, adaptive coalescing would put them in one task.
    tasks = min(trees, 2 * df.sparkSession.sparkContext.defaultParallelism)
    share = 4 * wanted / rows
    while True:
        samples = draw_samples(df, features, key, trees, sample, seed, share).repartition(tasks, "tree_id")
        nodes = samples.groupBy("tree_id").applyInPandas(grow, NODE_SCHEMA).toPandas()
        if share >= 1 or ((nodes["node_id"] == 0) & (nodes["size"] == wanted)).sum() == trees:
            break
        share *= 16
    nodes = nodes.sort_values(["tree_id", "node_id"], ignore_index=True)
    return Forest(features, wanted, nodes)


def with_raw_score(df: DataFrame, forest: Forest, name: str = "raw_score") -> DataFrame:
    """Add ``-2 ** (-E[h] / c(sample))``: near -1 for isolated rows, towards 0 for the crowd."""
    shared = df.sparkSession.sparkContext.broadcast(forest.flat())
    norm = mean_path_length(forest.sample_size)
    levels = math.ceil(math.log2(max(forest.sample_size, 2)))

    def depths(x: np.ndarray) -> np.ndarray:
        a = shared.value
        at = np.tile(a["roots"], (len(x), 1))
        row = np.arange(len(x))[:, None] * x.shape[1]
        values = x.ravel()
        for _ in range(levels):
            goes_left = values.take(row + a["feature"].take(at)) <= a["threshold"].take(at)
            at = np.where(goes_left, a["left"].take(at), a["right"].take(at))
        return a["path"].take(at).mean(axis=1)

    @pandas_udf("double")
    def raw_score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            # Small blocks keep the (rows, trees) matrices in the processor cache.
            blocks = [depths(x[i : i + 256]) for i in range(0, len(x), 256)]
            depth = np.concatenate(blocks) if blocks else np.zeros(0)
            ratio = depth / norm if norm else np.ones_like(depth)
            yield pd.Series(-np.exp2(-ratio))

    return df.withColumn(name, raw_score(*[F.col(c).cast("double") for c in forest.features]))
