"""Time arithmetic on zone-less timestamps, as SQL expressions.

``unix_micros``, ``timestampdiff`` and ``date_trunc`` go through the session zone, which
bends wall-clock times around daylight-saving changes. Subtracting a zone-less origin does
not, so the numbers below are the same under every session zone. The origin lies before any
timestamp in use: the interval is never negative and the cast to whole units rounds down.
"""

from __future__ import annotations


def _since_origin(ts: str, unit: str) -> str:
    return f"cast(cast({ts} - TIMESTAMP_NTZ'0001-01-01 00:00:00' AS INTERVAL {unit}) AS bigint)"


def second_no(ts: str) -> str:
    """Number of the second ``ts`` falls in."""
    return _since_origin(ts, "SECOND")


def minute_no(ts: str) -> str:
    """Number of the minute ``ts`` falls in."""
    return _since_origin(ts, "MINUTE")


def minutes_between(start: str, end: str) -> str:
    """Minute boundaries crossed from ``start`` to ``end`` (20:30:50 to 20:31:10 is 1)."""
    return f"{minute_no(end)} - {minute_no(start)}"


def days_between(start: str, end: str) -> str:
    """Midnights crossed from ``start`` to ``end``."""
    return f"cast(date_diff({end}, {start}) AS bigint)"


def shifted(ts: str, seconds: int) -> str:
    return f"({ts} + INTERVAL '{int(seconds)}' SECOND)"


def bucket_no(second: str, width_s: int) -> str:
    """Number of the ``width_s`` long bucket a second belongs to."""
    return f"({second} div {int(width_s)})"
