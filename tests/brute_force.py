"""Plain-Python versions of the time joins, for small fixtures."""

from __future__ import annotations

from datetime import datetime, timedelta

WINDOW = timedelta(minutes=15)


def minute(ts: datetime) -> int:
    return (ts.replace(second=0, microsecond=0) - datetime(1, 1, 1)) // timedelta(minutes=1)


def pairs(sessions, spots, window=WINDOW):
    """Sessions and spots are (id, ts); gives (session, spot, minutes)."""
    return [
        (s, g, minute(ts) - minute(at))
        for s, ts in sessions
        for g, at in spots
        if ts is not None and at is not None and at <= ts <= at + window
    ]


def nearest(sessions, spots, window=WINDOW):
    """(session, ts, spot) of the latest spot at or before each session; low spot ids win ties."""
    out = []
    for s, ts in sessions:
        reach = [(at, g) for g, at in spots if ts is not None and at is not None and at <= ts <= at + window]
        if reach:
            latest = max(at for at, _ in reach)
            out.append((s, ts, min((g for at, g in reach if at == latest), key=lambda g: (g is None, g))))
    return out


def around(sessions, spots, window=WINDOW):
    """(spot, ts) -> (before, after)."""
    times = [ts for _, ts in sessions if ts is not None]
    out = {}
    for g, at in spots:
        before = sum(1 for ts in times if at is not None and at - window <= ts <= at)
        after = sum(1 for ts in times if at is not None and at <= ts <= at + window)
        old = out.get((g, at), (0, 0))
        out[g, at] = (old[0] + before, old[1] + after)
    return out
