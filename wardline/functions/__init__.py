"""Column expressions: built-in Spark functions only, no Python per row."""

from wardline.functions.readings import (
    battery_factor,
    device_tier_factor,
    freshness_weight,
    parse_value,
    parse_value_or_null,
    patient_id,
    quality_weight,
    signal_factor,
    trust_score,
)
from wardline.functions.scoring import reading_score, risk_band, vital_score
from wardline.functions.timing import half_hour, ntz, whole_hours, whole_seconds

__all__ = [
    "battery_factor",
    "device_tier_factor",
    "freshness_weight",
    "half_hour",
    "ntz",
    "parse_value",
    "parse_value_or_null",
    "patient_id",
    "quality_weight",
    "reading_score",
    "risk_band",
    "signal_factor",
    "trust_score",
    "vital_score",
    "whole_hours",
    "whole_seconds",
]
