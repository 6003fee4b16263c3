"""Time-range predicates relative to a reference instant."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = Column | dt.datetime | str | None


def as_instant(as_of: AsOf = None) -> Column:
    """The reference instant: now, unless a time is pinned. Times without zone are UTC."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, dt.datetime) and as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=dt.timezone.utc)
    return F.lit(as_of).cast("timestamp")


def _minus(instant: Column, span: str) -> Column:
    return instant - F.expr(f"INTERVAL {span}")


def within(ts: Column | str, span: str, as_of: AsOf = None) -> Column:
    """`ts` lies in the half-open range (as_of - span, as_of]; without as_of there is no upper bound.

    A pinned as_of is a constant, so both bounds fold to literals and reach the file scan.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    now = as_instant(as_of)
    lower = ts > _minus(now, span)
    return lower if as_of is None else lower & (ts <= now)


def at_or_after_day(day: Column | str, span: str, as_of: AsOf = None) -> Column:
    """The same range on a date partition column: prunes whole days before any file is opened."""
    day = F.col(day) if isinstance(day, str) else day
    now = as_instant(as_of)
    lower = day >= F.to_date(_minus(now, span))
    return lower if as_of is None else lower & (day <= F.to_date(now))


def cover(start: int, end: int, steps: Sequence[int]) -> list[tuple[int, int, int]]:
    """The range [start, end) as the largest windows that fit: (number of the step, from, to) in order, whole windows
    only. `steps` are window lengths, shortest first, each a multiple of the one before; both ends must lie on the
    shortest. Of n windows of the shortest length some 2 * (steps[i + 1] / steps[i]) of each length are left."""
    if start % steps[0] or end % steps[0]:
        raise ValueError("the range does not begin and end with a window")

    def fill(a: int, b: int, k: int) -> list[tuple[int, int, int]]:
        if a >= b:
            return []
        low, high = -(-a // steps[k]) * steps[k], b // steps[k] * steps[k]
        if low >= high:
            return fill(a, b, k - 1)
        return fill(a, low, k - 1) + [(k, low, high)] + fill(high, b, k - 1)

    return fill(start, end, len(steps) - 1)
