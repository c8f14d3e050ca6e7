"""The six vital signs and every fixed value of the early-warning score.

The numbers below are fixed values: results are only right if they are exactly these.
Everything else in the package is written in terms of them.
"""

from __future__ import annotations

from dataclasses import dataclass

# One band: (lowest value or None, highest value or None, points). Both ends are closed.
Band = tuple[float | None, float | None, int]


@dataclass(frozen=True)
class Vital:
    """One vital sign: wire name, column prefix in the wide table, scoring bands."""

    code: str
    prefix: str
    bands: tuple[Band, ...]
    # Points for a value outside every band; None leaves the reading unscored.
    fallback: int | None = None


# Scoring bands, lowest first. The first band that holds a value decides,
# and a value between two bands (for example a respiratory rate of 8.5) has no score.
VITALS: tuple[Vital, ...] = (
    Vital(
        "RESPIRATORY_RATE",
        "respiratory_rate",
        ((None, 8, 3), (9, 11, 1), (12, 20, 0), (21, 24, 2), (25, None, 3)),
    ),
    Vital(
        "OXYGEN_SATURATION",
        "oxygen_saturation",
        ((None, 91, 3), (92, 93, 2), (94, 95, 1), (96, None, 0)),
    ),
    Vital(
        "BLOOD_PRESSURE_SYSTOLIC",
        "blood_pressure",
        ((None, 90, 3), (None, 100, 2), (None, 110, 1), (111, 219, 0), (220, None, 3)),
    ),
    Vital(
        "HEART_RATE",
        "heart_rate",
        ((None, 40, 3), (41, 50, 1), (51, 90, 0), (91, 110, 1), (111, 130, 2), (131, None, 3)),
    ),
    Vital(
        "TEMPERATURE",
        "temperature",
        ((None, 35.0, 3), (35.1, 36.0, 1), (36.1, 38.0, 0), (38.1, 39.0, 1), (39.1, None, 2)),
    ),
    Vital("CONSCIOUSNESS", "consciousness", ((1, 1, 0),), fallback=3),
)
CODES: tuple[str, ...] = tuple(v.code for v in VITALS)
PREFIXES: tuple[str, ...] = tuple(v.prefix for v in VITALS)
BY_CODE: dict[str, Vital] = {v.code: v for v in VITALS}

# Quality factors, in tenths, with their shares of the weight (also in tenths).
TIER_TENTHS = (("MEDICAL", 10), ("PREMIUM", 7))
BATTERY_TENTHS = ((80.0, 10), (50.0, 8), (20.0, 6))
SIGNAL_TENTHS = ((0.8, 10), (0.6, 8), (0.4, 6))
LOWEST_TENTHS = 4
TIER_SHARE, BATTERY_SHARE, SIGNAL_SHARE = 7, 2, 1

# Freshness weight by age in whole hours (at most), and for anything older.
FRESHNESS_BY_HOURS = ((1, 1.0), (6, 0.9), (12, 0.7), (24, 0.5), (48, 0.3))
STALE_WEIGHT = 0.2

# Shares of the two weights in the trust score.
TRUST_QUALITY_SHARE, TRUST_FRESHNESS_SHARE = 0.7, 0.3

# Lowest total score of each risk band, most urgent first.
RISK_BANDS = ((7, "red"), (5, "orange"), (3, "yellow"))
LOWEST_RISK = "green"

# Event-time window, out-of-orderness bound, state lifetime, table layout.
WINDOW = "1 minute"
WATERMARK = "10 seconds"
STATE_TTL_MS = 300_000
BUCKETS = 4
TOPIC_PARTITIONS = 3
RETENTION_DAYS = 7
COOLDOWN_SECONDS = 10
