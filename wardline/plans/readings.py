"""Raw readings derived from the ``events`` table.

Every event gives one reading per vital sign. The arithmetic is on whole numbers, so another
engine derives exactly the same readings:

* ten thousand events make a cohort of four patients, one event each five seconds; further
  data brings further patients, not denser ones;
* one reading in seven carries a type nobody routes, so vital signs are missing here and there;
* one device in 97 names no patient, one battery in 50 is unknown;
* readings arrive 0 to 60 hours after they were taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardline.vitals import CODES

# Shape of each vital's value for event e, in hundredths: lowest, step, span, and every which
# event adds how much more. Order of the vital signs as in CODES.
_SHAPES = (
    (500, 700, 2500, 10, 50),
    (8600, 700, 1500, 11, 50),
    (8000, 1100, 15000, 11, 50),
    (3000, 1300, 12000, 11, 50),
    (3400, 30, 610, 13, 5),
    (0, 100, 400, 1, 0),
)


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived readings of the whole ``events`` table, in the raw schema."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id")
    return readings_from_events(events)


def readings_from_events(events: DataFrame) -> DataFrame:
    """Six readings per event; needs ``event_id`` and ``user_id`` only."""
    # Work out what the six readings share before fanning out.
    shared = events.selectExpr(
        "event_id",
        "timestampadd(MILLISECOND, int(event_id * 37 % 1000), timestampadd(SECOND, "
        "int(event_id % 10000 * 5 + event_id div 10000 % 720 * 3600), "
        "TIMESTAMP_NTZ'2024-01-01 00:00:00')) AS measurement_timestamp",
        "CASE event_id % 3 WHEN 0 THEN 'MEDICAL' WHEN 1 THEN 'PREMIUM' ELSE 'BASIC' END AS tier",
        # The vital's name goes between tier and owner; one in 97 has no owner in its id.
        "if(event_id % 97 = 0, '_X', concat('_P', lpad("
        "string(event_id div 10000 * 4 + user_id % 4), 8, '0'))) AS owner",
        "if(event_id % 50 = 0, NULL, double(event_id * 17 % 101)) AS battery",
        "event_id * 3 % 11 / 10 AS signal_strength",
    )
    kinds = ", ".join(
        f"struct('{code}' AS code, '_{code.lower()}' AS name, {i} AS i, {low} AS lowest, "
        f"{step} AS step, {span} AS span, {every} AS every, {extra} AS extra)"
        for i, (code, (low, step, span, every, extra)) in enumerate(zip(CODES, _SHAPES))
    )
    fanned = shared.selectExpr("*", f"inline(array({kinds}))").selectExpr(
        "*", "lowest + event_id * step % span + if(event_id % every = 0, extra, 0) AS hundredths"
    )
    return fanned.selectExpr(
        "measurement_timestamp",
        "if((event_id + i) % 7 = 0, 'BODY_WEIGHT', code) AS measurement_type",
        "concat(string(hundredths div 100), '.', lpad(string(hundredths % 100), 2, '0'))"
        " AS raw_value",
        "concat(tier, name, owner) AS device_id",
        "battery",
        "signal_strength",
        "timestampadd(HOUR, int(event_id % 61), measurement_timestamp) AS ingestion_timestamp",
    )


__all__ = ["raw_readings", "readings_from_events"]
