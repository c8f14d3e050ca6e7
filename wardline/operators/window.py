"""Stage 4: one row per patient and minute, all vital signs side by side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions import ntz
from wardline.operators.enrich import stage_clock
from wardline.schemas import SCORES
from wardline.vitals import VITALS, WINDOW

# Trust scores lie between 0 and 1, so sums of billionths fit a long for 9e9 readings of one
# vital in one window, and a sum of longs does not depend on the order of its rows.
_BILLION = 1_000_000_000
_STAGES = ("measurement", "ingestion", "enrichment", "routing", "scoring")


def tumble_pivot(
    scored: DataFrame,
    window: str = WINDOW,
    lateness: str | None = None,
    clock: Column | None = None,
) -> DataFrame:
    """Combine scored readings per patient and epoch-aligned window ``[start, end)``.

    Per vital sign: highest value, highest score (0 if none) and mean trust score (0 if none).
    Every stage time becomes its earliest. Readings without a patient form a group of their
    own. One shuffle in all: the conditional aggregates combine on the map side, so a patient
    or minute with a great share of all readings costs one row per map task.

    On a stream, ``lateness`` bounds the state and drops what comes later; without it every
    late reading still updates its window, and every window is state for ever. ``window_sums``
    kept in a table do without state (``start_fused``).
    """
    streaming = scored.isStreaming
    if streaming:
        scored = scored.withColumn(
            "measurement_timestamp", F.col("measurement_timestamp").cast("timestamp")
        )
        if lateness is not None:
            scored = scored.withWatermark("measurement_timestamp", lateness)
    return finish_window(window_sums(scored, window), clock)


def window_sums(scored: DataFrame, window: str = WINDOW) -> DataFrame:
    """The combinable half of ``tumble_pivot``: highest values, sums and counts, earliest times."""
    sums = []
    for vital in VITALS:
        mine = f"FILTER (WHERE measurement_type = '{vital.code}')"
        name = vital.prefix
        sums += [
            f"max(value) {mine} AS {name}_value",
            f"max(score) {mine} AS {name}_points",
            f"sum(bigint(rint(trust_score * {_BILLION}))) {mine} AS {name}_sum",
            f"count(trust_score) {mine} AS {name}_n",
        ]
    sums += [f"min({stage}_timestamp) AS {stage}_first" for stage in _STAGES]
    grouped = scored.groupBy(
        "patient_id", F.window("measurement_timestamp", window).alias("window")
    ).agg(*map(F.expr, sums))
    return grouped.selectExpr(
        "patient_id",
        "window.start::timestamp_ntz AS window_start",
        "window.end::timestamp_ntz AS window_end",
        *(f"{v.prefix}_{part}" for v in VITALS for part in ("value", "points", "sum", "n")),
        *(f"{stage}_first::timestamp_ntz AS {stage}_first" for stage in _STAGES),
    )


def merge_sums(sums: DataFrame, *beside: Column) -> DataFrame:
    """Several ``window_sums`` rows of a patient and window into one; ``beside``: further aggregates."""
    merged = []
    for vital in VITALS:
        name = vital.prefix
        merged += [f"max({name}_{part}) AS {name}_{part}" for part in ("value", "points")]
        merged += [f"sum({name}_{part}) AS {name}_{part}" for part in ("sum", "n")]
    merged += [f"min({stage}_first) AS {stage}_first" for stage in _STAGES]
    return sums.groupBy("patient_id", "window_start", "window_end").agg(*map(F.expr, merged), *beside)


def finish_window(sums: DataFrame, clock: Column | None = None) -> DataFrame:
    """``window_sums`` to the columns of ``tumble_pivot``."""
    wide, scores, trusts = [], [], []
    for vital in VITALS:
        name = vital.prefix
        wide.append(f"{name}_value")
        scores.append(f"double(coalesce({name}_points, 0)) AS {name}_score")
        trusts.append(
            f"coalesce(if({name}_n > 0, double({name}_sum) / double({name}_n * {_BILLION}), NULL)"
            f", 0D) AS {name}_trust_score"
        )
    return (
        sums.selectExpr(
            "patient_id",
            "window_start",
            "window_end",
            *wide,
            *scores,
            *trusts,
            *(f"{stage}_first AS {stage}_timestamp" for stage in _STAGES),
        )
        .withColumn("union_timestamp", ntz(stage_clock(clock)))
        .select(*SCORES.names)
    )
