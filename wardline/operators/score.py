"""Stage 3: points per reading."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions import reading_score, trust_score, vital_score
from wardline.operators.enrich import stage_clock
from wardline.operators.route import route_together
from wardline.schemas import SCORED


def score_vital(routed: DataFrame, code: str, clock: Column | None = None) -> DataFrame:
    """Score the routed readings of one vital sign; the device id ends here."""
    scored = routed.withColumn("score", vital_score("value", code))
    return scored.withColumn("scoring_timestamp", stage_clock(clock)).select(*SCORED.names)


def score_together(routed: DataFrame, clock: Column | None = None) -> DataFrame:
    """Score readings of all vital signs in one pass over a relation that keeps the type."""
    scored = routed.withColumn("score", reading_score("measurement_type", "value"))
    return scored.withColumn("scoring_timestamp", stage_clock(clock)).select(
        "measurement_type", *SCORED.names
    )


def score_all(
    enriched: DataFrame,
    routing_clock: Column | None = None,
    scoring_clock: Column | None = None,
) -> DataFrame:
    """Route and score in one pass: same rows as six routes, six scorings and their union."""
    return score_together(route_together(enriched, routing_clock), scoring_clock)


def union_scores(parts: dict[str, DataFrame]) -> DataFrame:
    """All scored readings of the six relations, each tagged with its vital sign."""
    tagged = [df.select(F.lit(code).alias("measurement_type"), "*") for code, df in parts.items()]
    return reduce(DataFrame.unionByName, tagged)


def with_trust(scored: DataFrame) -> DataFrame:
    """Add the trust score of each reading."""
    return scored.withColumn("trust_score", trust_score("quality_weight", "freshness_weight"))
