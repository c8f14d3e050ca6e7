"""Retention and tiering as plain row filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.vitals import COOLDOWN_SECONDS, RETENTION_DAYS


def newest(rows: DataFrame, ts: str) -> dt.datetime | None:
    """The latest time in a column: one value, worked out by an aggregate."""
    return rows.agg(F.max(ts).alias("newest")).first()["newest"]


def within_retention(
    rows: DataFrame, ts: str, days: int = RETENTION_DAYS, now: dt.datetime | None = None
) -> DataFrame:
    """Rows no more than ``days`` old as of ``now``, or as of the newest row."""
    now = now or newest(rows, ts)
    if now is None:
        return rows
    return rows.filter(F.col(ts) >= F.lit(now - dt.timedelta(days=days)).cast("timestamp_ntz"))


def tier_split(
    rows: DataFrame, ts: str, cooldown: int = COOLDOWN_SECONDS, now: dt.datetime | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows within the cooldown (hot) and older ones (cold); rows without a time stay hot."""
    now = now or newest(rows, ts)
    if now is None:
        return rows, rows.limit(0)
    limit = F.lit(now - dt.timedelta(seconds=cooldown)).cast("timestamp_ntz")
    cold = F.coalesce(F.col(ts) < limit, F.lit(False))
    return rows.filter(~cold), rows.filter(cold)
