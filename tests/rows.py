"""Small helpers to make readings and compare results."""

import datetime as dt

from wardline.schemas import RAW

NOON = dt.datetime(2025, 3, 16, 12, 0, 0)


def at(**later):
    return NOON + dt.timedelta(**later)


def reading(kind="HEART_RATE", value="70", patient="P0001", when=NOON, **other):
    row = {
        "measurement_timestamp": when,
        "measurement_type": kind,
        "raw_value": value,
        "device_id": f"MEDICAL_{kind.lower()}_{patient}",
        "battery": 90.0,
        "signal_strength": 0.9,
        "ingestion_timestamp": when,
    }
    row.update(other)
    return tuple(row[name] for name in RAW.names)


def raw_frame(spark, readings):
    return spark.createDataFrame(list(readings), RAW)


def as_dicts(df, *order):
    rows = [r.asDict(recursive=True) for r in df.collect()]
    return sorted(rows, key=lambda r: tuple(str(r[k]) for k in order))


def bag(df, columns=None):
    names = sorted(columns or df.columns)
    return sorted((tuple(map(repr, r)) for r in df.select(*names).collect()))
