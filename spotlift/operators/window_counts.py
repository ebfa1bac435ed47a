"""How many points lie before and after each anchor, without pairing them.

The count over a stretch of time is the difference of two running counts, so the cost is
linear in points and anchors however dense the traffic is. Points are reduced to one row per
instant before anything else. Running counts have two levels: within a slice of one second
(at most 10^6 instants), and over the slice totals of a bucket as long as the window. From an
anchor at ``t`` in bucket ``b`` the window reaches exactly into ``b - 1`` and ``b + 1``, so

    before = total(b - 1) - count(< t - window) + count(<= t)
    after  = total(b)     - count(< t)          + count(<= t + window)

with all counts running from the start of their own bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotlift.functions.timing import bucket_no, second_no, shifted


def _probes(anchors: DataFrame, anchor_ts: str, window_s: int) -> DataFrame:
    """Four readings of the running count per distinct anchor instant.

    Kind 0 sorts ahead of the points of its instant and reads "<"; kind 2 sorts behind them
    and reads "<=". The other fields say with which sign the reading, and the total of its
    bucket, enter the two counts.
    """
    fields = "kind, at, sec, before_sign, after_sign, before_total, after_total"
    readings = (
        f"0, {shifted(anchor_ts, -window_s)}, sec - {window_s}, -1, 0, 1, 0",
        f"0, {anchor_ts}, sec, 0, -1, 0, 1",
        f"2, {anchor_ts}, sec, 1, 0, 0, 0",
        f"2, {shifted(anchor_ts, window_s)}, sec + {window_s}, 0, 1, 0, 0",
    )
    return (
        anchors.where(f"{anchor_ts} IS NOT NULL")
        .select(anchor_ts)
        .distinct()
        .selectExpr(anchor_ts, f"{second_no(anchor_ts)} AS sec")
        .selectExpr(anchor_ts, f"stack(4, {', '.join(readings)}) AS ({fields})")
    )


def instants_of(points: DataFrame, point_ts: str) -> DataFrame:
    """``(at, sec, n)``: points per instant.

    Grouping by the second as well changes nothing in the result, but both uses of the frame
    then read the same shuffle: the null filters Spark infers on ``sec`` find one in place.
    """
    return (
        points.selectExpr(f"{point_ts} AS at", f"{second_no(point_ts)} AS sec")
        .where("at IS NOT NULL AND sec IS NOT NULL")
        .groupBy("at", "sec")
        .agg(F.expr("count(*) AS n"))
    )


def running_counts(probes: DataFrame, instants: DataFrame, window_s: int) -> DataFrame:
    """Columns of ``probes`` (``at``, ``sec``, ``kind`` and others) with ``reading``, the points since the start of the probe's bucket, and
    ``total``, those of the whole bucket. ``instants`` has ``at, sec, n``."""
    columns = probes.columns
    in_order = "(PARTITION BY sec ORDER BY at, kind ROWS UNBOUNDED PRECEDING)"
    in_slice = (
        probes.unionByName(instants.selectExpr("*", "1 AS kind"), allowMissingColumns=True)
        .selectExpr("*", f"coalesce(sum(n) OVER {in_order}, 0) AS in_slice")
        .where("kind <> 1")
    )

    earlier = "(PARTITION BY bucket ORDER BY sec ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    slices = (
        instants.select("sec", "n")
        .unionByName(probes.selectExpr("sec", "0L AS n"))
        .groupBy("sec")
        .agg(F.expr("sum(n) AS n"))
        .selectExpr("sec", "n", f"{bucket_no('sec', window_s)} AS bucket")
        .selectExpr(
            "sec", f"coalesce(sum(n) OVER {earlier}, 0) AS earlier", "sum(n) OVER (PARTITION BY bucket) AS total"
        )
    )
    return in_slice.join(slices, "sec").selectExpr(*columns, "earlier + in_slice AS reading", "total")


def counts_around(
    anchors: DataFrame, points: DataFrame, anchor_ts: str, point_ts: str, window_s: int
) -> DataFrame:
    """``(anchor_ts, before, after)`` per distinct anchor instant; both window ends count,
    and a point at the very instant counts on both sides."""
    readings = running_counts(_probes(anchors, anchor_ts, window_s), instants_of(points, point_ts), window_s)
    return readings.groupBy(anchor_ts).agg(
        F.expr("sum(before_sign * reading + before_total * total) AS before"),
        F.expr("sum(after_sign * reading + after_total * total) AS after"),
    )
