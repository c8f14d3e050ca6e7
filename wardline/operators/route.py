"""Stage 2: one relation per vital sign."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.operators.enrich import stage_clock
from wardline.schemas import ROUTED
from wardline.vitals import CODES


def route_vital(enriched: DataFrame, code: str, clock: Column | None = None) -> DataFrame:
    """The readings of one vital sign, without the type column."""
    rows = enriched.filter(F.col("measurement_type") == code)
    return rows.withColumn("routing_timestamp", stage_clock(clock)).select(*ROUTED.names)


def route(enriched: DataFrame, clock: Column | None = None) -> dict[str, DataFrame]:
    """One DataFrame per vital sign; readings of any other type go nowhere."""
    return {code: route_vital(enriched, code, clock) for code in CODES}


def route_together(enriched: DataFrame, clock: Column | None = None) -> DataFrame:
    """All routed readings in one relation that keeps the type, to be written partitioned by it.

    One scan and one write serve all six topics, and a reader of one vital sign prunes the
    other five partitions.
    """
    rows = enriched.filter(F.col("measurement_type").isin(*CODES))
    return rows.withColumn("routing_timestamp", stage_clock(clock)).select(
        "measurement_type", *ROUTED.names
    )
