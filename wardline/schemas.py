"""Schemas of every table and topic.

Times are zone-less with millisecond precision on the wire. Streaming sources read the event
time as ``TimestampType`` in a UTC session, because a watermark needs that type; everything
stored or emitted is ``TimestampNTZType``.
"""

from __future__ import annotations

from pyspark.sql import types as T

from wardline.vitals import CODES, PREFIXES

_STR, _DBL, _INT, _NTZ = T.StringType(), T.DoubleType(), T.IntegerType(), T.TimestampNTZType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


def _times(*stages: str) -> list[tuple[str, T.DataType]]:
    return [(f"{stage}_timestamp", _NTZ) for stage in stages]


# What a device sends; the ingestion time is the record time and not part of the payload.
RAW_PAYLOAD = _struct(
    ("measurement_timestamp", _NTZ),
    ("measurement_type", _STR),
    ("raw_value", _STR),
    ("device_id", _STR),
    ("battery", _DBL),
    ("signal_strength", _DBL),
)
RAW = _struct(*((f.name, f.dataType) for f in RAW_PAYLOAD), ("ingestion_timestamp", _NTZ))

ENRICHED = _struct(
    ("measurement_type", _STR),
    ("value", _DBL),
    ("device_id", _STR),
    ("patient_id", _STR),
    ("quality_weight", _DBL),
    ("freshness_weight", _DBL),
    *_times("measurement", "ingestion", "enrichment"),
)

ROUTED = _struct(
    ("device_id", _STR),
    ("patient_id", _STR),
    ("value", _DBL),
    ("quality_weight", _DBL),
    ("freshness_weight", _DBL),
    *_times("measurement", "ingestion", "enrichment", "routing"),
)

SCORED = _struct(
    ("patient_id", _STR),
    ("value", _DBL),
    ("quality_weight", _DBL),
    ("freshness_weight", _DBL),
    ("score", _INT),
    *_times("measurement", "ingestion", "enrichment", "routing", "scoring"),
)

# Per-vital topics all share one layout.
ROUTED_TOPICS = {code: f"measurements_{code.lower()}" for code in CODES}
SCORED_TOPICS = {code: f"scores_{code.lower()}" for code in CODES}

_WINDOW_KEY = [("patient_id", _STR), ("window_start", _NTZ), ("window_end", _NTZ)]
_VALUES = [(f"{p}_value", _DBL) for p in PREFIXES]
_SCORES = [(f"{p}_score", _DBL) for p in PREFIXES]
_TRUST = [(f"{p}_trust_score", _DBL) for p in PREFIXES]
_STAGES = _times("measurement", "ingestion", "enrichment", "routing", "scoring", "union")

SCORES = _struct(*_WINDOW_KEY, *_VALUES, *_SCORES, *_TRUST, *_STAGES)
SCORES_KEY = ["patient_id", "window_start"]

TOTALS = _struct(
    *_WINDOW_KEY,
    *_VALUES,
    *_SCORES,
    ("news2_score", _DBL),
    *_TRUST,
    ("news2_trust_score", _DBL),
    *_STAGES,
    *_times("aggregation"),
)

STORED = T.StructType([*TOTALS.fields, T.StructField("storage_timestamp", _NTZ, True)])
STORED_KEY = ["patient_id", "window_start", "window_end"]


def event_time(schema: T.StructType, *columns: str) -> T.StructType:
    """The same schema with the given columns typed for use in a watermark."""
    return T.StructType(
        [
            T.StructField(f.name, T.TimestampType()) if f.name in columns else f for f in schema
        ]
    )
