"""Boundary values of every expression."""

import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.rows import NOON, at
from wardline import functions as X
from wardline.vitals import CODES

# value -> points; one row per threshold, its neighbours and the middle of each gap.
POINTS = {
    "RESPIRATORY_RATE": {
        8: 3, 8.5: None, 9: 1, 11: 1, 11.5: None, 12: 0, 20: 0, 20.5: None, 21: 2, 24: 2,
        24.5: None, 25: 3, -1: 3, 400: 3,
    },
    "OXYGEN_SATURATION": {
        91: 3, 91.5: None, 92: 2, 93: 2, 93.5: None, 94: 1, 95: 1, 95.5: None, 96: 0, 100: 0,
    },
    "BLOOD_PRESSURE_SYSTOLIC": {
        90: 3, 90.5: 2, 100: 2, 100.5: 1, 110: 1, 110.5: None, 111: 0, 219: 0, 219.5: None, 220: 3,
    },
    "HEART_RATE": {
        40: 3, 40.5: None, 41: 1, 50: 1, 50.5: None, 51: 0, 90: 0, 90.5: None, 91: 1, 110: 1,
        110.5: None, 111: 2, 130: 2, 130.5: None, 131: 3,
    },
    "TEMPERATURE": {
        35.0: 3, 35.05: None, 35.1: 1, 36.0: 1, 36.05: None, 36.1: 0, 38.0: 0, 38.05: None,
        38.1: 1, 39.0: 1, 39.05: None, 39.1: 2, 45.0: 2,
    },
    "CONSCIOUSNESS": {1: 0, 0: 3, 2: 3, 1.5: 3},
}


def evaluate(spark, rows, schema, **columns):
    df = spark.createDataFrame(rows, schema)
    return df.select(*(c.alias(n) for n, c in columns.items())).collect()


@pytest.mark.parametrize("code", CODES)
def test_points(spark, code):
    cases = [(float(v), p) for v, p in POINTS[code].items()]
    got = evaluate(
        spark, [(v, code) for v, _ in cases], "v double, t string",
        one=X.vital_score("v", code), all=X.reading_score("t", "v"),
    )
    assert [r.one for r in got] == [p for _, p in cases]
    assert [r.all for r in got] == [p for _, p in cases]


def test_missing_value_scores_only_for_consciousness(spark):
    got = evaluate(
        spark, [(None, c) for c in CODES], "v double, t string", p=X.reading_score("t", "v")
    )
    assert [r.p for r in got] == [None, None, None, None, None, 3]


def test_nan_counts_as_highest(spark):
    got = evaluate(
        spark, [(math.nan, c) for c in CODES], "v double, t string", p=X.reading_score("t", "v")
    )
    assert [r.p for r in got] == [3, 0, 3, 3, 2, 3]


def test_unknown_type_has_no_score(spark):
    got = evaluate(spark, [(1.0, "WEIGHT")], "v double, t string", p=X.reading_score("t", "v"))
    assert got[0].p is None


def _expected(code, v):
    """The bands once more, as plain conditions on a number."""
    if code == "CONSCIOUSNESS":
        return 0 if v == 1 else 3
    if code == "BLOOD_PRESSURE_SYSTOLIC":
        if v <= 110:
            return 3 if v <= 90 else 2 if v <= 100 else 1
        return 0 if 111 <= v <= 219 else 3 if v >= 220 else None
    bands = {
        "RESPIRATORY_RATE": [(-1e9, 8, 3), (9, 11, 1), (12, 20, 0), (21, 24, 2), (25, 1e9, 3)],
        "OXYGEN_SATURATION": [(-1e9, 91, 3), (92, 93, 2), (94, 95, 1), (96, 1e9, 0)],
        "HEART_RATE": [
            (-1e9, 40, 3), (41, 50, 1), (51, 90, 0), (91, 110, 1), (111, 130, 2), (131, 1e9, 3),
        ],
        "TEMPERATURE": [
            (-1e9, 35.0, 3), (35.1, 36.0, 1), (36.1, 38.0, 0), (38.1, 39.0, 1), (39.1, 1e9, 2),
        ],
    }[code]
    return next((p for lo, hi, p in bands if lo <= v <= hi), None)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.one_of(
                st.floats(-10, 300),
                st.integers(-10, 300).map(float),
                st.integers(300, 420).map(lambda n: n / 10),
            ),
            st.sampled_from(CODES),
        ),
        min_size=200,
        max_size=400,
    )
)
def test_points_of_any_value(spark, cases):
    got = evaluate(spark, cases, "v double, t string", p=X.reading_score("t", "v"))
    assert [r.p for r in got] == [_expected(c, v) for v, c in cases]


def test_risk_bands(spark):
    scores = [0, 2, 3, 4, 5, 6, 7, 18, None]
    got = evaluate(
        spark, [(None if s is None else float(s),) for s in scores], "s double",
        r=X.risk_band("s"),
    )
    assert [r.r for r in got] == [
        "green", "green", "yellow", "yellow", "orange", "orange", "red", "red", None,
    ]


def test_patient_id(spark):
    cases = {
        "MEDICAL_hr_P0011": "P0011", "P1_P22": "P22", "A_P1_P2": "P2", "MEDICAL_hr": None,
        "MEDICAL_hr_P": None, "MEDICAL_P12x": None, "P0011": None, "x_p12": None, None: None,
    }
    got = evaluate(spark, [(d,) for d in cases], "d string", p=X.patient_id("d"))
    assert [r.p for r in got] == list(cases.values())


def test_factors_and_quality(spark):
    rows = [
        ("MEDICAL_x", 80.0, 0.8), ("PREMIUM_x", 79.9, 0.79), ("BASIC_x", 50.0, 0.6),
        ("medical_x", 49.9, 0.59), (None, None, None), ("MEDICAL", 20.0, 0.4),
        ("PREMIUM", 19.9, 0.39),
    ]
    got = evaluate(
        spark, rows, "d string, b double, s double",
        tier=X.device_tier_factor("d"), charge=X.battery_factor("b"), reach=X.signal_factor("s"),
        q=X.quality_weight("d", "b", "s"),
    )
    assert [r.tier for r in got] == [1.0, 0.7, 0.4, 0.4, 0.4, 1.0, 0.7]
    assert [r.charge for r in got] == [1.0, 0.8, 0.8, 0.6, 0.4, 0.6, 0.4]
    assert [r.reach for r in got] == [1.0, 0.8, 0.8, 0.6, 0.4, 0.6, 0.4]
    assert [r.q for r in got] == [1.0, 0.73, 0.52, 0.46, 0.4, 0.88, 0.61]


def test_freshness(spark):
    hours = lambda h, m=0, s=0: at(hours=h, minutes=m, seconds=s)
    cases = [
        (hours(0, 59, 59), 1.0), (hours(1), 1.0), (hours(1, 59, 59), 1.0), (hours(2), 0.9),
        (hours(6, 59, 59), 0.9), (hours(7), 0.7), (hours(12), 0.7), (hours(13), 0.5),
        (hours(24), 0.5), (hours(25), 0.3), (hours(48), 0.3), (hours(48, 59, 59), 0.3),
        (hours(49), 0.2), (hours(-1), 1.0), (hours(-30), 1.0), (None, 0.2),
    ]
    got = evaluate(
        spark, [(NOON, t) for t, _ in cases], "a timestamp_ntz, b timestamp_ntz",
        f=X.freshness_weight("a", "b"),
    )
    assert [r.f for r in got] == [f for _, f in cases]


def test_whole_units_cut_toward_zero(spark):
    rows = [(at(minutes=59, seconds=59), at(hours=1, seconds=1)), (NOON, at(hours=-1, minutes=-59))]
    got = evaluate(
        spark, rows, "a timestamp_ntz, b timestamp_ntz",
        h=X.whole_hours("a", "b"), s=X.whole_seconds("a", "b"),
    )
    assert [(r.h, r.s) for r in got] == [(0, 2), (-1, -7140)]


def test_half_hour(spark):
    day = dt.datetime(2025, 3, 16)
    cases = [(dt.timedelta(minutes=m), 30 * (m // 30)) for m in (0, 29, 30, 59, 60, 91, 1439)]
    got = evaluate(
        spark, [(day + d,) for d, _ in cases], "t timestamp_ntz", h=X.half_hour("t")
    )
    assert [r.h for r in got] == [day + dt.timedelta(minutes=m) for _, m in cases]


def test_parse_value(spark):
    cases = {"70": 70.0, " 12.5 ": 12.5, "-1e3": -1000.0, None: None}
    got = evaluate(spark, [(v,) for v in cases], "v string", n=X.parse_value("v"))
    assert [r.n for r in got] == list(cases.values())
    assert math.isnan(evaluate(spark, [("NaN",)], "v string", n=X.parse_value("v"))[0].n)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_parse_value_is_strict_in_any_mode(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="not a number"):
            evaluate(spark, [("n/a",)], "v string", n=X.parse_value("v"))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_parse_or_null(spark):
    got = evaluate(spark, [("n/a",), ("1",)], "v string", n=X.parse_value_or_null("v"))
    assert [r.n for r in got] == [None, 1.0]


def test_trust(spark):
    got = evaluate(spark, [(0.4, 0.2), (1.0, 1.0)], "q double, f double", t=X.trust_score("q", "f"))
    assert [r.t for r in got] == [pytest.approx(0.34), 1.0]
