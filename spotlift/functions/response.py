"""Lift, response segments and text clean-up; SQL expressions where staging views need them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_label(text: str) -> str:
    return f"lower(trim({text}))"


def lift_pct(pre: str, post: str) -> str:
    """Percent change of sessions from before to after a spot.

    A spot without sessions before it scores 100 if any followed and 0 if none did; both
    guards stay ahead of the division, which raises on zero under ANSI rules.
    """
    return f"""CASE WHEN {pre} = 0 AND {post} > 0 THEN 100.0D
                    WHEN {pre} = 0 AND {post} = 0 THEN 0.0D
                    ELSE round(({post} - {pre}) * 100.0D / {pre}, 2) END"""


def response_segment(lift: Column | str, abnormal: Column | str) -> Column:
    """Label a spot; the first rule that holds wins. NaN counts as no lift at all.

    Labels and the bound of 50 are fixed values.
    """
    lift = F.col(lift) if isinstance(lift, str) else lift
    abnormal = F.col(abnormal) if isinstance(abnormal, str) else abnormal
    lift = F.nanvl(lift.cast("double"), F.lit(None).cast("double"))
    flagged = abnormal == 1
    return (
        F.when(flagged & (lift > 0), "Abnormal Positive Spike")
        .when(flagged & (lift < 0), "Abnormal Negative Drop")
        .when(lift >= 50, "High Positive Lift")
        .when(lift > 0, "Normal Positive Lift")
        .when(lift < 0, "Weak Response")
        .otherwise("Insufficient Baseline")
    )
