"""Fixed stage clocks for derived readings, so that latencies are the same in every run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _later(column: str, millis: str) -> Column:
    return F.expr(f"timestampadd(MILLISECOND, {millis}, {column})")


def enrichment() -> Column:
    return _later("ingestion_timestamp", "1400 + 1000 * (second(measurement_timestamp) % 3)")


def routing() -> Column:
    return _later("enrichment_timestamp", "300 + 1000 * (minute(measurement_timestamp) % 2)")


def scoring() -> Column:
    return _later("routing_timestamp", "1700 + 1000 * (second(measurement_timestamp) % 4)")


def union() -> Column:
    return _later("scoring_timestamp", "2500")


def aggregation() -> Column:
    return _later("union_timestamp", "1200")


def storage() -> Column:
    return _later("aggregation_timestamp", "1000 * (minute(window_start) % 5)")
