"""Time arithmetic that does not depend on the session zone; arguments as in ``readings``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(ts: Column) -> Column:
    """Emit a time as zone-less UTC wall-clock time."""
    return ts.cast("timestamp_ntz")


def whole_seconds(start: str, end: str) -> Column:
    """Whole seconds from start to end, cut toward zero (0.9 s is 0, -0.9 s is 0)."""
    return F.expr(f"timestampdiff(SECOND, {start}, {end})")


def whole_hours(start: str, end: str) -> Column:
    """Whole hours from start to end, cut toward zero (1 h 59 min is 1)."""
    return F.expr(f"timestampdiff(HOUR, {start}, {end})")


def half_hour(ts: str) -> Column:
    """The start of the half hour that holds a time."""
    hour = f"cast(date_trunc('hour', {ts}) AS timestamp_ntz)"
    return F.expr(f"timestampadd(MINUTE, minute({ts}) div 30 * 30, {hour})")
