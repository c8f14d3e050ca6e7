"""Stage 1: raw readings to enriched readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions import (
    freshness_weight,
    parse_value,
    patient_id,
    quality_weight,
)


def stage_clock(clock: Column | None) -> Column:
    """The time a stage stamps on its rows: the given expression, or the batch's clock."""
    return F.current_timestamp() if clock is None else clock


def split_bad(raw: DataFrame, need_patient: bool = False) -> tuple[DataFrame, DataFrame]:
    """Part raw readings into usable ones and ones for quarantine.

    Bad are readings whose value is no number or not finite, and those without a measurement
    time, which no window could hold; with ``need_patient`` also those whose device names no
    patient, which a keyed table refuses. The bad ones get a ``problem`` column.
    """
    problem = F.expr(
        """
        CASE WHEN measurement_timestamp IS NULL THEN 'no measurement time'
             WHEN raw_value IS NOT NULL AND try_cast(raw_value AS double) IS NULL
               THEN 'not a number'
             WHEN isnan(try_cast(raw_value AS double))
               OR abs(try_cast(raw_value AS double)) = double('Infinity') THEN 'not finite'
        END
        """
    )
    if need_patient:
        nobody = F.when(patient_id("device_id").isNull(), "no patient")
        problem = F.coalesce(problem, nobody)
    good = raw.filter(problem.isNull())
    bad = raw.withColumn("problem", problem).filter(F.col("problem").isNotNull())
    return good, bad


def enrich(raw: DataFrame, on_bad: str = "fail", clock: Column | None = None) -> DataFrame:
    """Parse the value, find the patient, and weigh quality and freshness.

    On a stream, set the watermark after this stage: checking the time makes a new column.
    ``on_bad="fail"`` stops on a value that is no number and on a missing measurement time;
    ``on_bad="quarantine"`` leaves such readings out (``split_bad`` gives them back).
    """
    if on_bad == "quarantine":
        raw, _ = split_bad(raw)
        measured = "measurement_timestamp"
    elif on_bad == "fail":
        kind = raw.schema["measurement_timestamp"].dataType.simpleString()
        measured = (
            "coalesce(measurement_timestamp, "
            f"cast(raise_error('reading without a measurement time') AS {kind}))"
        )
    else:
        raise ValueError(f"on_bad must be 'fail' or 'quarantine', not {on_bad!r}")
    return raw.select(
        "measurement_type",
        parse_value("raw_value").alias("value"),
        "device_id",
        patient_id("device_id").alias("patient_id"),
        quality_weight("device_id", "battery", "signal_strength").alias("quality_weight"),
        freshness_weight("measurement_timestamp", "ingestion_timestamp").alias(
            "freshness_weight"
        ),
        F.expr(measured).alias("measurement_timestamp"),
        "ingestion_timestamp",
    ).select("*", stage_clock(clock).alias("enrichment_timestamp"))
