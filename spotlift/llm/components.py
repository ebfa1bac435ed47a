"""Connected components of a graph held as a table of edges, by alternating large-star and small-star.

Every round moves edges towards the smallest vertex around: large-star hangs the larger neighbours of
a vertex on its smallest one, small-star the smaller ones. Edges never grow in number beyond a factor of two, a vertex's
neighbours are never gathered in one place (only their minimum, combined on the map side), and the joins
on vertices are plain enough for Spark to split a vertex that holds much of the graph.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotlift.llm.shared import materialised


def connected_components(edges: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """``node`` and ``component``, the smallest node that links reach, for every node of an edge.

    Self-links, repeated links and links with a null end are harmless; the first gives its node a row.
    """
    ends = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    links = materialised(
        ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    while not _is_starry(links):
        links = materialised(_small_star(_large_star(links)))
    rows = links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component"))
    )
    return rows.groupBy("node").agg(F.min("component").alias("component"))


def _is_starry(links: DataFrame) -> bool:
    """Whether every node hangs on one other at most and nothing hangs on such a node."""
    proper = links.where("u <> v")
    roles = proper.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        proper.select(F.col("v").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    broken = roles.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up = 1 AND down = 1")
    return broken.isEmpty()


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    # Self-links stay: they stand for nodes without another link.
    return both.join(least, "u").where("v > u OR v = u AND m = u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
