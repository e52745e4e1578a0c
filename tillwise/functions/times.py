"""Calendar expressions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F


def moment(as_of: datetime | str | None) -> Column:
    """The given point in time, or now."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def whole_days(start: Column | str, end: Column) -> Column:
    """Full 24-hour days from start to end."""
    return F.timestamp_diff("DAY", start if isinstance(start, Column) else F.col(start), end)


def iso_week(ts: Column | str) -> Column:
    """The Monday of the week, as a date."""
    return F.trunc(F.to_date(ts), "week")
