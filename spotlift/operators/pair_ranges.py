"""All pairs of a point and an anchor up to a window before it, kept as ranges of anchors instead of rows.

Anchors are numbered by time within buckets as long as the window. The anchors that reach a point at ``t`` in bucket ``b`` are then the
last ones of bucket ``b - 1`` and the first ones of bucket ``b``: two ranges of numbers, whose ends are running counts. So the pairs
take one or two short rows for each instant that has points, however many pairs there are, and are listed only on request.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotlift.functions.timing import bucket_no, second_no, shifted
from spotlift.operators.interval_join import ANCHORS_PER_TASK, grid_join
from spotlift.operators.salting import ROWS_PER_TASK
from spotlift.operators.window_counts import instants_of, running_counts

#: Rows of one instant are numbered in this many groups, so that a very full instant is not one task's.
GROUPS = 64


#: Equal parts that the numbers of a bucket are cut into when pairs are listed. A point goes to the parts its two ranges touch, eight at most.
PARTS = 4


@dataclass(frozen=True)
class PairRanges:
    """``ranges`` has the point's time, ``bucket``, ``first`` and ``until``; ``anchors`` their columns, ``bucket`` and ``number``. The frames
    that both come from also have ``total``, the anchors of the bucket."""

    sized_ranges: DataFrame
    sized_anchors: DataFrame
    point_ts: str

    @property
    def ranges(self) -> DataFrame:
        return self.sized_ranges.drop("total")

    @property
    def anchors(self) -> DataFrame:
        return self.sized_anchors.drop("total")

    def pair_counts(self) -> DataFrame:
        """Point instants with the anchors that reach them, ``(point_ts, pairs)``, without listing any."""
        return self.ranges.groupBy(self.point_ts).agg(F.expr("sum(until - first) AS pairs"))

    def expanded(
        self,
        points: DataFrame,
        rows_per_task: int = ROWS_PER_TASK,
        anchors_per_task: int = ANCHORS_PER_TASK,
        together: Sequence[str] = (),
        once: Sequence[str] = (),
    ) -> DataFrame:
        """Every pair, as the columns of ``points`` and of the anchors. The rows are as many as the pairs. ``together`` and ``once``: see
        ``grid_join``.

        Pairs come into being in the last step, where points and anchors of a part of a bucket meet, and are not shuffled: what is
        shuffled grows with points and anchors.
        """
        part_of = f"bucket * {PARTS} + ({{}}) * {PARTS} div total".format
        left = points.join(self.sized_ranges, self.point_ts).selectExpr(
            *points.columns, "first", "until - 1 AS last", f"explode(sequence({part_of('first')}, {part_of('until - 1')})) AS part"
        )
        right = self.sized_anchors.selectExpr("*", f"{part_of('number')} AS part").drop("bucket", "total")
        met = grid_join(left, right, "part", "number", "first", "last", rows_per_task, anchors_per_task, together, once)
        return met.select(*points.columns, *[c for c in met.columns if c not in {*left.columns, "number"}])


def pair_ranges(points: DataFrame, anchors: DataFrame, point_ts: str, anchor_ts: str, window_s: int) -> PairRanges:
    """The anchors with ``point - window_s <= anchor <= point`` of every point; rows without time have none.

    Columns of the two sides must differ in name.
    """
    instants = instants_of(anchors, anchor_ts)
    probes = (
        points.where(f"{point_ts} IS NOT NULL")
        .select(point_ts)
        .distinct()
        .selectExpr(point_ts, f"{second_no(point_ts)} AS sec")
        .selectExpr(
            point_ts, f"stack(2, 0, {shifted(point_ts, -window_s)}, sec - {window_s}, 2, {point_ts}, sec) AS (kind, at, sec)"
        )
    )
    ranges = (
        running_counts(probes, instants, window_s)
        .selectExpr(
            point_ts,
            f"{bucket_no('sec', window_s)} AS bucket",
            "if(kind = 0, reading, 0) AS first",
            "if(kind = 0, total, reading) AS until",
            "total",
        )
        .where("first < until")
    )
    return PairRanges(ranges, _numbered(anchors, instants, anchor_ts, window_s), point_ts)


def _numbered(anchors: DataFrame, instants: DataFrame, anchor_ts: str, window_s: int) -> DataFrame:
    """Anchors with their bucket and number; those of one instant follow one another in any order."""
    start = running_counts(instants.selectExpr("at", "sec", "0 AS kind"), instants, window_s)
    start = start.selectExpr("at", f"{bucket_no('sec', window_s)} AS bucket", "reading AS before_instant", "total")
    content = f"xxhash64({', '.join(anchors.columns)})"
    grouped = anchors.where(f"{anchor_ts} IS NOT NULL").selectExpr(
        "*", f"{anchor_ts} AS at", f"pmod({content} + spark_partition_id(), {GROUPS}) AS grp", f"{content} AS content"
    )
    earlier = "(PARTITION BY at ORDER BY grp ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    offsets = grouped.groupBy("at", "grp").agg(F.expr("count(*) AS n")).selectExpr("at", "grp", f"coalesce(sum(n) OVER {earlier}, 0) AS before_group")
    place = "row_number() OVER (PARTITION BY at, grp ORDER BY content)"
    return (
        grouped.selectExpr("*", f"{place} - 1 AS place")
        .join(offsets, ["at", "grp"])
        .join(start, "at")
        .selectExpr(*anchors.columns, "bucket", "before_instant + before_group + place AS number", "total")
    )
