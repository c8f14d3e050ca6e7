"""Stages 5 and 6: totals per patient and minute, and the form in which they are stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions import ntz, risk_band
from wardline.operators.enrich import stage_clock
from wardline.schemas import STORED, TOTALS
from wardline.vitals import PREFIXES


def totals(scores: DataFrame, clock: Column | None = None) -> DataFrame:
    """Add the total score (0 to 18) and the total trust score (0 to 6).

    Both are plain sums over the six vital signs; a missing one adds 0.
    """
    sums = {
        "news2_score": " + ".join(f"{p}_score" for p in PREFIXES),
        "news2_trust_score": " + ".join(f"{p}_trust_score" for p in PREFIXES),
    }
    return (
        scores.selectExpr("*", *(f"{text} AS {name}" for name, text in sums.items()))
        .withColumn("aggregation_timestamp", ntz(stage_clock(clock)))
        .select(*TOTALS.names)
    )


def mean_trust(final: DataFrame) -> DataFrame:
    """Add the mean trust over the six vital signs, 0 to 1, next to the plain sum."""
    return final.withColumn("news2_mean_trust", F.col("news2_trust_score") / len(PREFIXES))


def load_typed(final: DataFrame, clock: Column | None = None) -> DataFrame:
    """The stored form: times cut to whole seconds, load time added where none is given."""
    columns = [
        f"date_trunc('second', {f.name})::timestamp_ntz AS {f.name}"
        if f.dataType.typeName() == "timestamp_ntz"
        else f.name
        for f in TOTALS
    ]
    stored = ntz(F.date_trunc("second", stage_clock(clock)))
    return (
        final.selectExpr(*columns).withColumn("storage_timestamp", stored).select(*STORED.names)
    )


def with_risk(final: DataFrame) -> DataFrame:
    """Add the colour band of the total score."""
    return final.withColumn("risk", risk_band("news2_score"))
