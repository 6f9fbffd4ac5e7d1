"""Date/time features on ``timestamp_ntz`` (wall-clock) columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_parts(ts: Column | str, prefix: str = "") -> dict[str, Column]:
    """hour, year, month, day of a timestamp as int columns."""
    t = _c(ts)
    return {
        f"{prefix}hour": F.hour(t),
        f"{prefix}year": F.year(t),
        f"{prefix}month": F.month(t),
        f"{prefix}day": F.dayofmonth(t),
    }


def day_of_week_sat0(ts: Column | str) -> Column:
    """Day of week with Saturday=0, Sunday=1, ..., Friday=6 (calendar-correct)."""
    # dayofweek: Sunday=1 .. Saturday=7, so Saturday (7) -> 0 and Sunday (1) -> 1.
    return F.pmod(F.dayofweek(_c(ts)), F.lit(7))


def weekday_mon0(ts: Column | str) -> Column:
    """Day of week with Monday=0 .. Sunday=6."""
    return F.weekday(_c(ts))


def is_weekend(ts: Column | str) -> Column:
    """1 on Saturday/Sunday, else 0."""
    return (weekday_mon0(ts) >= 5).cast("int")


def duration_seconds(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from ``start`` to ``end`` (end - start)."""
    return F.timestamp_diff("SECOND", _c(start), _c(end))
