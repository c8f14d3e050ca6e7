"""Expressions on one raw reading: parsing, patient, quality, freshness, trust.

Arguments are column names or SQL expressions. A whole expression is one piece of SQL text, so
that building a plan costs one call into the JVM for each and not one per comparison.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardline import vitals as V


def parse_value(raw: str) -> Column:
    """The reading as a number; a string that is none stops the job, whatever the ANSI mode."""
    return F.expr(
        f"coalesce(try_cast({raw} AS double), if({raw} IS NULL, NULL, "
        f"cast(raise_error(concat('not a number: ', {raw})) AS double)))"
    )


def parse_value_or_null(raw: str) -> Column:
    """The reading as a number, or NULL where it is not one."""
    return F.expr(f"try_cast({raw} AS double)")


def patient_id(device_id: str) -> Column:
    """The ``P<digits>`` that ends a device id after an underscore; NULL if there is none."""
    return F.expr(f"nullif(regexp_extract({device_id}, r'_(P\\d+)$', 1), '')")


def _ladder(tests: Sequence[tuple[str, object]], otherwise: object) -> str:
    """SQL for the result of the first test that holds."""
    return (
        "CASE " + " ".join(f"WHEN {t} THEN {r}" for t, r in tests) + f" ELSE {otherwise} END"
    )


def _tier(device_id: str) -> str:
    tests = [(f"startswith({device_id}, '{name}')", tenths) for name, tenths in V.TIER_TENTHS]
    return _ladder(tests, V.LOWEST_TENTHS)


def _at_least(value: str, steps: Sequence[tuple[float, int]]) -> str:
    return _ladder([(f"{value} >= {floor}D", r) for floor, r in steps], V.LOWEST_TENTHS)


def device_tier_factor(device_id: str) -> Column:
    """1.0, 0.7 or 0.4 by the device class named in the id."""
    return F.expr(f"{_tier(device_id)} / 10")


def battery_factor(battery: str) -> Column:
    """1.0, 0.8, 0.6 or 0.4 by battery charge; unknown counts as lowest."""
    return F.expr(f"{_at_least(battery, V.BATTERY_TENTHS)} / 10")


def signal_factor(signal: str) -> Column:
    """1.0, 0.8, 0.6 or 0.4 by signal strength; unknown counts as lowest."""
    return F.expr(f"{_at_least(signal, V.SIGNAL_TENTHS)} / 10")


def quality_weight(device_id: str, battery: str, signal: str) -> Column:
    """Weighted mean of the three factors, 0.40 to 1.00, exact to two decimals.

    Counting in hundredths keeps the sum exact: small integers in generated code, no decimal
    objects, and one division gives the double nearest to the two-decimal number.
    """
    return F.expr(
        f"({_tier(device_id)} * {V.TIER_SHARE}"
        f" + {_at_least(battery, V.BATTERY_TENTHS)} * {V.BATTERY_SHARE}"
        f" + {_at_least(signal, V.SIGNAL_TENTHS)} * {V.SIGNAL_SHARE}) / 100"
    )


def freshness_weight(measured: str, ingested: str) -> Column:
    """1.0 for a reading at most one whole hour old, down to 0.2 beyond 48 hours.

    "At most h whole hours" is the same as "younger than h + 1 hours", so plain comparisons
    of the age do; a time in the future counts as fresh and an unknown age as stale.
    """
    age = f"({ingested} - {measured})"
    tests = [
        (f"{age} < INTERVAL '{hours + 1}' HOUR", f"{weight}D")
        for hours, weight in V.FRESHNESS_BY_HOURS
    ]
    return F.expr(_ladder(tests, f"{V.STALE_WEIGHT}D"))


def trust_score(quality: str, freshness: str) -> Column:
    """How far a reading can be trusted: 0.7 parts quality and 0.3 parts freshness."""
    return F.expr(
        f"{quality} * {V.TRUST_QUALITY_SHARE}D + {freshness} * {V.TRUST_FRESHNESS_SHARE}D"
    )
