"""A small, broadcastable index from a moment to the last instant at or before it.

Sorted instants cut time into stretches ``[instant, next instant)``, none reaching further than
``reach_s``. Stretches do not overlap, so a moment lies in at most one. Each stretch is listed
under the minutes it touches; a point finds its stretch by an equi-join on the minute, with the
exact bounds as a filter. With the index broadcast the points are neither shuffled nor sorted,
and no key of theirs can be hot.

That is only sound while the index is small and no minute lists many stretches, so both are
bounded first (:func:`fits`); callers have a shuffled way for everything else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotlift.functions.timing import bucket_no, minute_no, second_no, shifted

BROADCAST_BYTES = 64 * 1024 * 1024
_ROW_BYTES = 64
_STRETCHES_PER_MINUTE = 64


def build_index(instants: DataFrame, reach_s: int, payload: str) -> DataFrame:
    """``(minute, since, until, last, payload)`` from distinct instants in column ``at``.

    A stretch holds the moments with ``since <= moment <= last`` and ``moment < until``. The
    next instant is looked for in the instant's own bucket and the one after it: nothing
    further can be within reach.
    """
    bucket = bucket_no(second_no("at"), reach_s)
    next_at = "lead(at) OVER (PARTITION BY bucket ORDER BY at)"
    return (
        instants.selectExpr("at", payload, f"{bucket} AS own")
        .selectExpr("*", "explode(array(own - 1, own)) AS bucket")
        .selectExpr("at AS since", payload, "bucket = own AS is_own", f"{next_at} AS until")
        .where("is_own")
        .selectExpr("since", "until", f"{shifted('since', reach_s)} AS last", payload)
        .selectExpr("*", f"explode(sequence({minute_no('since')}, {minute_no('least(until, last)')})) AS minute")
    )


def fits(instants: DataFrame, reach_s: int, payload: str, broadcast_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether an index over these instants may be broadcast, judged before it is built.

    An instant is listed in its own minute, and a minute is also entered by at most one stretch
    from earlier. So the index has no more rows than there are instants plus minutes covered,
    and a minute lists at most one stretch more than it has instants. One aggregation, combined
    on the map side.
    """
    row = f"{_ROW_BYTES} + octet_length(to_json({payload}))"
    minutes = instants.groupBy(F.expr(f"{minute_no('at')} AS minute")).agg(
        F.expr("count(*) AS instants"), F.expr(f"sum({row}) AS bytes"), F.expr(f"max({row}) AS widest")
    )
    reach = reach_s // 60 + 1
    covered = f"least({reach} * count(*), max(minute) - min(minute) + {reach})"
    found = minutes.agg(
        F.expr("max(instants) AS fullest"), F.expr(f"sum(bytes) + {covered} * max(widest) AS bytes")
    ).first()
    return found.bytes is None or (found.bytes <= broadcast_bytes and found.fullest < _STRETCHES_PER_MINUTE)


def locate(points: DataFrame, point_ts: str, index: DataFrame) -> DataFrame:
    """Columns of ``points`` and of the stretch each lies in; points in none are left out."""
    timed = points.where(f"{point_ts} IS NOT NULL").selectExpr("*", f"{minute_no(point_ts)} AS minute")
    inside = f"{point_ts} >= since AND {point_ts} <= last AND ({point_ts} < until OR until IS NULL)"
    return timed.join(F.broadcast(index), "minute").where(inside)
