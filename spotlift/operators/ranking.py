"""Rank over a whole table without sorting it in one task."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spotlift.session import materialise

ROWS_PER_RANGE = 100_000
#: Rows looked at for each range when the bounds are drawn; they decide balance only, not ranks.
SAMPLE_PER_RANGE = 64


def _exceeds(a: Column, b: Column) -> Column:
    """a > b where null is the smallest value, as in Spark's sort: first ascending, last descending."""
    return a.isNotNull() & (b.isNull() | F.coalesce(a > b, F.lit(False)))


def _sorts_after(bound: Column, order: Mapping[str, str]) -> Column:
    """Whether the row comes strictly behind ``bound``, a struct of the order's columns."""
    after = F.lit(False)
    for name, direction in reversed(order.items()):
        row, edge = F.col(name), bound[name]
        here = _exceeds(edge, row) if direction == "desc" else _exceeds(row, edge)
        after = here | (row.eqNullSafe(edge) & after)
    return after


def _bounds(df: DataFrame, order: Mapping[str, str], sort: list[Column], ranges: int, rows: int) -> Column:
    """Array of up to ``ranges - 1`` distinct bounds, evenly spread over a sample."""
    share = min(1.0, ranges * SAMPLE_PER_RANGE / rows)
    drawn = df.select(*order).sample(fraction=share, seed=7).orderBy(*sort).collect()
    edges = list(dict.fromkeys(tuple(drawn[len(drawn) * i // ranges]) for i in range(1, ranges))) if drawn else []
    types = [df.schema[name].dataType for name in order]
    literals = [
        F.struct(*[F.lit(v).cast(t).alias(n) for v, t, n in zip(edge, types, order, strict=True)]) for edge in edges
    ]
    return F.array(*literals)


def global_rank(
    df: DataFrame, order: Mapping[str, str], name: str = "rank", rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """``rank()`` of every row under ``order``, column names with ``asc`` or ``desc``; equal rows share the lowest position.

    ``df`` is computed once. Explicit bounds then cut the order into ranges of about
    ``rows_per_range`` rows, at most as many as shuffle partitions; a row's range depends on its
    values alone, so counts and ranks cannot disagree. Rows are shuffled once, by range; the rank
    is the position in the sorted range plus the rows of the ranges before it. Rows that are equal
    in the whole order share a range, so ``order`` should end in a near-unique column.
    """
    sort = [F.desc(c) if direction == "desc" else F.asc(c) for c, direction in order.items()]
    kept = materialise(df)
    rows = kept.count()
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(parts, max(1, -(-rows // rows_per_range)))
    if ranges == 1:
        return kept.withColumn(name, F.rank().over(Window.partitionBy(F.lit(0)).orderBy(*sort)).cast("long"))
    bounds = _bounds(kept, order, sort, ranges, rows)
    ranged = kept.withColumn("range_no", F.size(F.filter(bounds, lambda b: _sorts_after(b, order))))
    sizes = ranged.groupBy("range_no").agg(F.count("*").alias("rows"))
    before = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("range_no", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    in_range = Window.partitionBy("range_no").orderBy(*sort)
    return (
        ranged.join(F.broadcast(offsets), "range_no")
        .withColumn(name, F.rank().over(in_range).cast("long") + F.col("offset"))
        .drop("range_no", "offset")
    )
