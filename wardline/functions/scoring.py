"""Expressions that turn values into points; arguments as in ``readings``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardline.vitals import BY_CODE, LOWEST_RISK, RISK_BANDS, VITALS, Vital


def _within(value: str, low: float | None, high: float | None) -> str:
    if low is None:
        return f"{value} <= {high}D"
    if high is None:
        return f"{value} >= {low}D"
    return f"{value} BETWEEN {low}D AND {high}D"


def _vital_case(value: str, vital: Vital) -> str:
    bands = " ".join(
        f"WHEN {_within(value, low, high)} THEN {points}" for low, high, points in vital.bands
    )
    otherwise = "" if vital.fallback is None else f" ELSE {vital.fallback}"
    return f"CASE {bands}{otherwise} END"


def vital_score(value: str, vital: Vital | str) -> Column:
    """Points for one vital sign.

    A missing value or one between two bands has no score, except for consciousness, where
    everything but "alert" scores highest.
    """
    return F.expr(_vital_case(value, BY_CODE[vital] if isinstance(vital, str) else vital))


def reading_score(measurement_type: str, value: str) -> Column:
    """Points for a reading of any vital sign, in one pass; NULL for an unknown type."""
    cases = " ".join(f"WHEN '{v.code}' THEN {_vital_case(value, v)}" for v in VITALS)
    return F.expr(f"CASE {measurement_type} {cases} END")


def risk_band(score: str) -> Column:
    """Colour band of a total score; NULL for no score."""
    bands = " ".join(f"WHEN {score} >= {least} THEN '{name}'" for least, name in RISK_BANDS)
    return F.expr(f"CASE {bands} WHEN {score} IS NOT NULL THEN '{LOWEST_RISK}' END")
