"""Date arithmetic with the reference dialect's meaning."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def day_diff(start: str | Column, end: str | Column) -> Column:
    """Number of midnights crossed from ``start`` to ``end`` (bigint).

    The two-argument ``datediff`` compares calendar dates, so 23:00 -> 01:00
    counts as one day; ``datediff(DAY, a, b)`` would count whole 24h spans.
    """
    return F.datediff(_c(end), _c(start)).cast("bigint")


def day_of_week0(d: str | Column) -> Column:
    """Day of week with Sunday = 0 ... Saturday = 6."""
    return (F.dayofweek(_c(d)) - 1).cast("bigint")


def days_before(as_of: dt.date, days: int) -> Column:
    """Midnight ``days`` before ``as_of`` as ``timestamp_ntz`` (inclusive cutoff)."""
    cutoff = as_of - dt.timedelta(days=days)
    return F.to_timestamp_ntz(F.lit(cutoff.isoformat() + " 00:00:00"))
