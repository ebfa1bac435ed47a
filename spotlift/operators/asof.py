"""As-of join: each point with the latest anchor at or before it, within a tolerance.

The candidate pairs are never formed. Where the anchors make a small index (see
``reach_index``; its size is measured first) it is broadcast and the points stay where they
are. Otherwise time is laid out in two levels: slices of one second, and buckets as long as
the tolerance.

* Within a slice, points and anchors are sorted together and the last anchor seen is carried
  along. Anchors are first reduced to one per instant, so a slice holds at most 10^6 of them
  (microseconds per second); a slice with more points than fit a task is salted.
* Into a slice comes the last anchor of earlier slices. It lies in the same bucket or in the
  one before, so a window over one row per slice, at most two buckets of rows, finds it.

Anchors are copied to the salts of hot slices only. A salt stands for a million points and a
slice holds at most a million anchors, so the copies stay in proportion to the points.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotlift.functions.timing import bucket_no, second_no, shifted
from spotlift.operators.reach_index import BROADCAST_BYTES, build_index, fits, locate
from spotlift.operators.salting import ROWS_PER_TASK, SALT, hot_keys, key_counts, replicate, salt_count, spread


def one_per_instant(anchors: DataFrame, anchor_ts: str, tie_break: Sequence[str]) -> DataFrame:
    """The anchor that wins each instant, as ``(at, sec, anchor)``.

    The lowest ``tie_break`` value wins, nulls last; the other columns settle what is left.
    """
    columns = anchors.columns
    rest = [c for c in columns if c != anchor_ts and c not in tie_break]
    order = [e for i, c in enumerate(tie_break) for e in (f"'null_{i}', {c} IS NULL", f"'{c}', {c}")]
    fields = order + [f"'{c}', {c}" for c in rest]
    anchor = ", ".join(f"'{c}', at" if c == anchor_ts else f"'{c}', best.{c}" for c in columns)
    return (
        anchors.where(f"{anchor_ts} IS NOT NULL")
        .groupBy(F.col(anchor_ts).alias("at"))
        .agg(F.expr(f"min(named_struct({', '.join(fields)})) AS best"))
        .selectExpr("at", f"{second_no('at')} AS sec", f"named_struct({anchor}) AS anchor")
    )


def _carried_in(instants: DataFrame, point_counts: DataFrame, tolerance_s: int, rows_per_task: int) -> DataFrame:
    """For every slice with points, and each of its salts, the last anchor before the slice.

    An anchor too old by now may come along; the tolerance is checked per point later.
    """
    bucket = bucket_no("sec", tolerance_s)
    last_of_slice = (
        instants.groupBy("sec")
        .agg(F.expr("max_by(anchor, at) AS anchor"))
        .selectExpr("sec", f"explode(array({bucket}, {bucket} + 1)) AS bucket", "anchor")
    )
    asked = point_counts.selectExpr("sec", f"{bucket} AS bucket", "rows")
    earlier = "(PARTITION BY bucket ORDER BY sec RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return (
        asked.unionByName(last_of_slice, allowMissingColumns=True)
        .selectExpr("sec", "rows", f"last(anchor, true) OVER {earlier} AS anchor")
        .where("rows IS NOT NULL AND anchor IS NOT NULL")
        .selectExpr("sec", "anchor", f"explode(sequence(0, {salt_count(rows_per_task)} - 1)) AS {SALT}")
    )


def asof_join(
    points: DataFrame,
    anchors: DataFrame,
    point_ts: str,
    anchor_ts: str,
    tolerance_s: int,
    tie_break: Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Columns of ``points`` and of the matched anchor; points without one are left out.

    Runs one job over the anchors to choose the way; ``broadcast_bytes=0`` skips it and
    shuffles.
    """
    instants = one_per_instant(anchors, anchor_ts, tie_break)
    if broadcast_bytes > 0 and fits(instants, tolerance_s, "anchor", broadcast_bytes):
        index = build_index(instants, tolerance_s, "anchor")
        return locate(points, point_ts, index).selectExpr(*points.columns, "anchor.*")
    return _shuffled_asof(points, instants, point_ts, anchor_ts, tolerance_s, rows_per_task)


def _shuffled_asof(
    points: DataFrame, instants: DataFrame, point_ts: str, anchor_ts: str, tolerance_s: int, rows_per_task: int
) -> DataFrame:
    timed = points.where(f"{point_ts} IS NOT NULL").selectExpr("*", f"{second_no(point_ts)} AS sec")
    counts = key_counts(timed.select("sec"), "sec")
    hot = hot_keys(counts, "sec", rows_per_task)
    carried = _carried_in(instants, counts, tolerance_s, rows_per_task)
    carried = carried.selectExpr(f"anchor.{anchor_ts} AS at", "sec", "anchor", SALT, "false AS is_point")
    known = replicate(instants, "sec", hot).selectExpr("at", "sec", "anchor", SALT, "false AS is_point")
    point = f"struct({', '.join(points.columns)}) AS point"
    asked = spread(timed, "sec", hot).selectExpr("sec", SALT, f"{point_ts} AS at", "true AS is_point", point)
    # At one instant the anchor comes first: an anchor reaches the points of its own instant.
    so_far = f"(PARTITION BY sec, {SALT} ORDER BY at, is_point ROWS UNBOUNDED PRECEDING)"
    return (
        asked.unionByName(known.unionByName(carried), allowMissingColumns=True)
        .selectExpr("at", "is_point", "point", f"last(anchor, true) OVER {so_far} AS anchor")
        .where(f"is_point AND at <= {shifted(f'anchor.{anchor_ts}', tolerance_s)}")
        .select("point.*", "anchor.*")
    )
