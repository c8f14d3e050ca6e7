"""Serving queries over the stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions import half_hour, whole_seconds

# Fixed values. Trend panels: name, column, and whether only positive values count.
TRENDS: dict[str, tuple[str, bool]] = {
    "news2": ("news2_score", False),
    "trust": ("news2_trust_score", False),
    "heart_rate": ("heart_rate_value", True),
    "respiratory_rate": ("respiratory_rate_value", True),
    "oxygen_saturation": ("oxygen_saturation_value", True),
    "temperature": ("temperature_value", True),
    "blood_pressure": ("blood_pressure_value", True),
    "consciousness": ("consciousness_value", True),
}


def half_hour_mean(
    final: DataFrame, column: str, patient_id: str | None = None, positive_only: bool = False
) -> DataFrame:
    """Mean of a column per half hour, in time order: ``time_window, mean``.

    With a patient the filter reaches the scan; without one the result is per patient.
    ``positive_only`` leaves out missing values and those that are zero or less.
    """
    rows = final
    if patient_id is not None:
        rows = rows.filter(F.col("patient_id") == patient_id)
    if positive_only:
        rows = rows.filter(F.col(column) > 0)
    keys = [] if patient_id is not None else ["patient_id"]
    return (
        rows.groupBy(*keys, half_hour("window_start").alias("time_window"))
        .agg(F.avg(column).alias("mean"))
        .orderBy(*keys, "time_window")
    )


def half_hour_all(final: DataFrame) -> DataFrame:
    """All eight trends of every patient in one pass and one shuffle."""
    means = [
        F.expr(f"avg({column})" + (f" FILTER (WHERE {column} > 0)" if positive else "")).alias(name)
        for name, (column, positive) in TRENDS.items()
    ]
    return final.groupBy("patient_id", half_hour("window_start").alias("time_window")).agg(
        *means
    )


def half_hour_bound(final: DataFrame, trend: str, patient_id: str) -> DataFrame:
    """The trend panel as SQL text with the patient bound as a named parameter."""
    column, positive = TRENDS[trend]
    only = f"AND {column} > 0" if positive else ""
    return final.sparkSession.sql(
        f"""
        SELECT window(window_start, '30 minutes').start AS time_window, avg({column}) AS mean
        FROM {{final}} WHERE patient_id = :patient_id {only}
        GROUP BY 1 ORDER BY 1
        """,
        args={"patient_id": patient_id},
        final=final,
    )


def patients(final: DataFrame) -> DataFrame:
    """Every patient once, in order."""
    return final.select("patient_id").distinct().orderBy("patient_id")


# Fixed values. Latency of each hop: name, from, to.
HOPS = (
    ("overall", "ingestion", "aggregation"),
    ("enrichment", "ingestion", "enrichment"),
    ("routing", "enrichment", "routing"),
    ("scoring", "routing", "scoring"),
    ("union", "scoring", "union"),
    ("aggregation", "union", "aggregation"),
)


def stage_latency(final: DataFrame) -> DataFrame:
    """Mean latency in whole seconds, overall and for each of the five hops."""
    return final.agg(
        *(
            F.avg(whole_seconds(f"{start}_timestamp", f"{end}_timestamp")).alias(
                f"avg_{name}_latency"
            )
            for name, start, end in HOPS
        )
    )


def max_latency(final: DataFrame) -> DataFrame:
    """Longest time from ingestion to aggregation and from aggregation to storage, in seconds."""
    return final.agg(
        F.max(whole_seconds("ingestion_timestamp", "aggregation_timestamp")).alias(
            "i2s_max_diff"
        ),
        F.max(whole_seconds("aggregation_timestamp", "storage_timestamp")).alias(
            "max_storage_diff"
        ),
    )
