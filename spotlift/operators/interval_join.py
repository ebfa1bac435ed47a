"""All pairs of a point and an anchor that lie within a time interval of each other.

Spark has no range join; the plain condition would compare every point with every anchor.
Here time is cut into slices of a third of the interval. An anchor lies in one slice and a point is
copied to each slice that its interval touches, so an equi-join on the slice finds every pair exactly
once. Pairs far outnumber rows, so what a pair costs decides: the anchors of a slice are put into
short lists by time, a point meets the lists that overlap its interval, and only their rows
are compared with the exact bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotlift.functions.timing import bucket_no, second_no, shifted
from spotlift.operators.salting import ROWS_PER_TASK, key_counts

ANCHORS_PER_TASK = 1_000

#: Anchors that stand in one list. A point compares about one list's worth of anchors in a slice in vain.
ANCHORS_PER_LIST = 32


def interval_join(
    points: DataFrame,
    anchors: DataFrame,
    point_ts: str,
    anchor_ts: str,
    before_s: int,
    after_s: int,
    rows_per_task: int = ROWS_PER_TASK,
    anchors_per_task: int = ANCHORS_PER_TASK,
    together: Sequence[str] = (),
    once: Sequence[str] = (),
) -> DataFrame:
    """Inner join on ``anchor - before_s <= point <= anchor + after_s``, both ends included. ``together`` and ``once``: see ``grid_join``.

    The result holds all pairs, so its size can grow with the square of the traffic in a
    slice; nothing downstream in this library is computed from it. Slices are joined by ``grid_join``. The bounds are computed once
    for each point, so that a pair costs two comparisons.
    """
    first, last = (shifted(point_ts, s) if s else point_ts for s in (-after_s, before_s))
    width_s = max(1, (before_s + after_s) // 3)
    slices = f"sequence({_slice_no('reach_first', width_s)}, {_slice_no('reach_last', width_s)})"
    left = (
        points.where(f"{point_ts} IS NOT NULL")
        .selectExpr("*", f"{first} AS reach_first", f"{last} AS reach_last")
        .selectExpr("*", f"explode({slices}) AS slice")
    )
    right = anchors.where(f"{anchor_ts} IS NOT NULL").selectExpr("*", f"{_slice_no(anchor_ts, width_s)} AS slice")
    pairs = grid_join(left, right, "slice", anchor_ts, "reach_first", "reach_last", rows_per_task, anchors_per_task, together, once)
    return pairs.drop("slice", "reach_first", "reach_last")


def _slice_no(ts: str, width_s: int) -> str:
    return bucket_no(second_no(ts), width_s)


def grid_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    value: str,
    first: str,
    last: str,
    rows_per_task: int = ROWS_PER_TASK,
    anchors_per_task: int = ANCHORS_PER_TASK,
    together: Sequence[str] = (),
    once: Sequence[str] = (),
) -> DataFrame:
    """Inner join of points ``left`` and anchors ``right`` on ``key``, a number, and ``value BETWEEN first AND last``: a column of the
    anchors and two of the points.

    A key is cut into a grid: anchors into blocks of about ``anchors_per_task``, points into blocks that with such a block
    give about ``100 * rows_per_task`` pairs and hold at most ``rows_per_task`` rows. Every cell of
    the grid is a join key of its own, so neither many points nor many anchors meet in one task. Pairs far outnumber the rows that
    are shuffled, so points are dealt over all shuffle partitions: bytes say little about the work of a task.

    Lists of anchors are also cut where a column in ``together`` changes. Expressions ``once``, over the points' columns and these, are computed
    for a point and a list and not for each pair; they come first among the anchors' columns, and the columns in ``together`` are left out.
    """
    grid = _grid(left, right, int(rows_per_task), int(anchors_per_task), key)
    cell = [key, "point_block", "anchor_block"]
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    points = _placed(left, grid, "point_block", "anchor_block", key).repartition(parts, *cell)
    lists = _listed(_placed(right, grid, "anchor_block", "point_block", key), cell, value, list(together))
    met = (
        points.join(lists, cell)
        .where(f"list_last >= {first} AND list_first <= {last}")
        .selectExpr(key, *[c for c in left.columns if c != key], *once, "list")
    )
    return met.selectExpr(*met.columns[:-1], "inline(list)").where(f"{value} BETWEEN {first} AND {last}")


def _listed(anchors: DataFrame, cell: list[str], value: str, together: list[str]) -> DataFrame:
    """The anchors of a cell in the order of ``value`` as ``list``, up to ``ANCHORS_PER_LIST`` of them, between ``list_first`` and ``list_last``.

    Lists are made where the join takes them, without a shuffle of their own; a pair then costs less than
    as a match of a row with a row.
    """
    columns = ", ".join(c for c in anchors.columns if c not in cell + together)
    place = f"row_number() OVER (PARTITION BY {', '.join(cell)} ORDER BY {value})"
    return (
        anchors.selectExpr("*", f"({place} - 1) div {ANCHORS_PER_LIST} AS list_no")
        .groupBy(*cell, *together, "list_no")
        .agg(
            F.expr(f"collect_list(struct({columns})) AS list"),
            F.expr(f"min({value}) AS list_first"),
            F.expr(f"max({value}) AS list_last"),
        )
    )


def _grid(left: DataFrame, right: DataFrame, rows_per_task: int, anchors_per_task: int, key: str = "slice") -> DataFrame:
    """Keys that are cut, and into how many blocks on either side."""
    meeting = f"greatest(rows, rows * least(anchors, {anchors_per_task}) / 100)"
    counts = key_counts(left.select(key), key).join(
        key_counts(right.select(key), key).withColumnRenamed("rows", "anchors"), key
    )
    cut = counts.selectExpr(
        key,
        f"cast(ceil({meeting} / {rows_per_task}) AS int) AS point_blocks",
        f"cast(ceil(anchors / {anchors_per_task}) AS int) AS anchor_blocks",
    )
    return cut.where("point_blocks > 1 OR anchor_blocks > 1")


def _placed(df: DataFrame, grid: DataFrame, own: str, other: str, key: str = "slice") -> DataFrame:
    """Each row in one block of its own side, by content and input partition, and in all of the other side.

    The grid carries no hint: it is broadcast only where Spark finds it small, else both are sorted
    and rows of a busy key are split by adaptive execution.
    """
    content = f"xxhash64({', '.join(df.columns)})"
    blocks = f"coalesce({own}s, 1)"
    return (
        df.join(grid, key, "left")
        .withColumn(own, F.expr(f"cast(pmod({content} + spark_partition_id(), {blocks}) AS int)"))
        .withColumn(other, F.expr(f"explode(sequence(0, coalesce({other}s, 1) - 1))"))
        .drop("point_blocks", "anchor_blocks")
    )
