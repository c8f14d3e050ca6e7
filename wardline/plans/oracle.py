"""DuckDB SQL for every query of the catalog, written apart from the Spark plans.

Scores come from a join with a table of bands here (the Spark side uses conditions), windows
from truncation, last writes from ranking: two ways to the same rows.
"""

from __future__ import annotations

from collections import namedtuple

# Fixed values, written out again so that a slip in the code under test shows: the vital signs by code and column.
_Vital = namedtuple("_Vital", "code prefix")
VITALS = (
    _Vital("RESPIRATORY_RATE", "respiratory_rate"),
    _Vital("OXYGEN_SATURATION", "oxygen_saturation"),
    _Vital("BLOOD_PRESSURE_SYSTOLIC", "blood_pressure"),
    _Vital("HEART_RATE", "heart_rate"),
    _Vital("TEMPERATURE", "temperature"),
    _Vital("CONSCIOUSNESS", "consciousness"),
)
PREFIXES = tuple(v.prefix for v in VITALS)
PATIENT = "P00000001"
# Trend panels, their column, and whether only positive values count.
TRENDS = {
    "news2": ("news2_score", False),
    "trust": ("news2_trust_score", False),
    "heart_rate": ("heart_rate_value", True),
    "respiratory_rate": ("respiratory_rate_value", True),
    "oxygen_saturation": ("oxygen_saturation_value", True),
    "temperature": ("temperature_value", True),
    "blood_pressure": ("blood_pressure_value", True),
    "consciousness": ("consciousness_value", True),
}

# One row per vital sign: shape of its derived values, in hundredths.
_KINDS = """kinds(i, code, lowest, step, span, every, extra) AS (VALUES
  (0, 'RESPIRATORY_RATE', 500, 700, 2500, 10, 50),
  (1, 'OXYGEN_SATURATION', 8600, 700, 1500, 11, 50),
  (2, 'BLOOD_PRESSURE_SYSTOLIC', 8000, 1100, 15000, 11, 50),
  (3, 'HEART_RATE', 3000, 1300, 12000, 11, 50),
  (4, 'TEMPERATURE', 3400, 30, 610, 13, 5),
  (5, 'CONSCIOUSNESS', 0, 100, 400, 1, 0))"""

# Points by band; ``above`` bounds are open, ``lo`` and ``hi`` are closed.
_BANDS = """bands(code, above, lo, hi, points) AS (VALUES
  ('RESPIRATORY_RATE', NULL, NULL, 8.0, 3), ('RESPIRATORY_RATE', NULL, 9.0, 11.0, 1),
  ('RESPIRATORY_RATE', NULL, 12.0, 20.0, 0), ('RESPIRATORY_RATE', NULL, 21.0, 24.0, 2),
  ('RESPIRATORY_RATE', NULL, 25.0, NULL, 3),
  ('OXYGEN_SATURATION', NULL, NULL, 91.0, 3), ('OXYGEN_SATURATION', NULL, 92.0, 93.0, 2),
  ('OXYGEN_SATURATION', NULL, 94.0, 95.0, 1), ('OXYGEN_SATURATION', NULL, 96.0, NULL, 0),
  ('BLOOD_PRESSURE_SYSTOLIC', NULL, NULL, 90.0, 3),
  ('BLOOD_PRESSURE_SYSTOLIC', 90.0, NULL, 100.0, 2),
  ('BLOOD_PRESSURE_SYSTOLIC', 100.0, NULL, 110.0, 1),
  ('BLOOD_PRESSURE_SYSTOLIC', NULL, 111.0, 219.0, 0),
  ('BLOOD_PRESSURE_SYSTOLIC', NULL, 220.0, NULL, 3),
  ('HEART_RATE', NULL, NULL, 40.0, 3), ('HEART_RATE', NULL, 41.0, 50.0, 1),
  ('HEART_RATE', NULL, 51.0, 90.0, 0), ('HEART_RATE', NULL, 91.0, 110.0, 1),
  ('HEART_RATE', NULL, 111.0, 130.0, 2), ('HEART_RATE', NULL, 131.0, NULL, 3),
  ('TEMPERATURE', NULL, NULL, 35.0, 3), ('TEMPERATURE', NULL, 35.1, 36.0, 1),
  ('TEMPERATURE', NULL, 36.1, 38.0, 0), ('TEMPERATURE', NULL, 38.1, 39.0, 1),
  ('TEMPERATURE', NULL, 39.1, NULL, 2),
  ('CONSCIOUSNESS', NULL, 1.0, 1.0, 0))"""

_CLEAN = """raw AS (
  SELECT m AS measurement_timestamp,
    CASE WHEN (e + i) % 7 = 0 THEN 'BODY_WEIGHT' ELSE code END AS measurement_type,
    (v // 100)::VARCHAR || '.' || lpad((v % 100)::VARCHAR, 2, '0') AS raw_value,
    (['MEDICAL', 'PREMIUM', 'BASIC'])[1 + (e % 3)::INT] || '_' || lower(code)
      || CASE WHEN e % 97 = 0 THEN '_X'
         ELSE '_P' || lpad((e // 10000 * 4 + u % 4)::VARCHAR, 8, '0') END AS device_id,
    CASE WHEN e % 50 <> 0 THEN (e * 17 % 101)::DOUBLE END AS battery,
    (e * 3 % 11)::DOUBLE / 10 AS signal_strength,
    m + to_hours((e % 61)::INT) AS ingestion_timestamp
  FROM (
    SELECT e, u, i, code,
      lowest + e * step % span + CASE WHEN e % every = 0 THEN extra ELSE 0 END AS v,
      TIMESTAMP '2024-01-01 00:00:00' + to_hours((e // 10000 % 720)::INT)
        + to_seconds((e % 10000 * 5)::INT) + to_milliseconds(e * 37 % 1000) AS m
    FROM (SELECT event_id AS e, user_id AS u FROM events), kinds))"""

_DIRTY = (
    _CLEAN.replace("raw AS (", "clean AS (", 1)
    + """,
spoilt AS (
  SELECT CASE WHEN measurement_type = 'CONSCIOUSNESS'
      AND minute(measurement_timestamp) % 30 = 7 THEN NULL
      ELSE measurement_timestamp END AS measurement_timestamp,
    measurement_type,
    CASE WHEN measurement_type = 'HEART_RATE'
        AND second(measurement_timestamp) % 20 = 5 THEN 'n/a'
      WHEN measurement_type = 'TEMPERATURE'
        AND second(measurement_timestamp) % 20 = 10 THEN 'NaN'
      ELSE raw_value END AS raw_value,
    device_id, battery, signal_strength, ingestion_timestamp
  FROM clean),
judged AS (
  SELECT *, CASE WHEN measurement_timestamp IS NULL THEN 'no measurement time'
    WHEN raw_value IS NOT NULL AND try_cast(raw_value AS DOUBLE) IS NULL THEN 'not a number'
    WHEN NOT isfinite(try_cast(raw_value AS DOUBLE)) THEN 'not finite' END AS problem
  FROM spoilt)"""
)
_GOOD = _DIRTY + """,
raw AS (SELECT * EXCLUDE (problem) FROM judged WHERE problem IS NULL)"""

# A quarter of the readings comes late; the watermark stands ten seconds below the newest of the others.
_IN_TIME = (
    _CLEAN.replace("raw AS (", "clean AS (", 1)
    + """,
raw AS (
  SELECT * FROM clean WHERE second(measurement_timestamp) % 20 <> 5
    OR date_trunc('minute', measurement_timestamp) + INTERVAL 1 MINUTE > (
      SELECT max(measurement_timestamp) - INTERVAL 10 SECOND FROM clean
      WHERE second(measurement_timestamp) % 20 <> 5 AND measurement_type <> 'BODY_WEIGHT'))"""
)

# Windows that get readings after the lifetime of their sums have only those.
_AFRESH = (
    _CLEAN.replace("raw AS (", "clean AS (", 1)
    + """,
marked AS (
  SELECT *, coalesce(bool_or(second(measurement_timestamp) % 20 = 5 AND measurement_type <> 'BODY_WEIGHT') OVER (
    PARTITION BY regexp_extract(device_id, '.*_(P\\d+)$', 1), date_trunc('minute', measurement_timestamp)), FALSE) AS anew
  FROM clean),
raw AS (
  SELECT * EXCLUDE (anew) FROM marked WHERE NOT anew OR second(measurement_timestamp) % 20 = 5)"""
)

# Factors by tier, battery and signal.
_FACTORS = """factors AS (
  SELECT *,
    CAST(raw_value AS DOUBLE) AS value,
    nullif(regexp_extract(device_id, '.*_(P\\d+)$', 1), '') AS patient_id,
    CASE split_part(device_id, '_', 1)
      WHEN 'MEDICAL' THEN 1.0 WHEN 'PREMIUM' THEN 0.7 ELSE 0.4 END AS tier,
    coalesce((SELECT max(f) FROM (VALUES (80, 1.0), (50, 0.8), (20, 0.6)) b(lo, f)
      WHERE battery >= lo), 0.4) AS charge,
    coalesce((SELECT max(f) FROM (VALUES (0.8, 1.0), (0.6, 0.8), (0.4, 0.6)) s(lo, f)
      WHERE signal_strength >= lo::DOUBLE), 0.4) AS reach,
    date_sub('hour', measurement_timestamp, ingestion_timestamp) AS age
  FROM raw)"""

# Weights by age.
_ENRICHED = """enriched AS (
  SELECT measurement_type, value, device_id, patient_id,
    CAST(CAST(tier * 0.7 + charge * 0.2 + reach * 0.1 AS DECIMAL(7, 2)) AS DOUBLE)
      AS quality_weight,
    CAST(coalesce((SELECT max(w) FROM (VALUES (1, 1.0), (6, 0.9), (12, 0.7), (24, 0.5),
      (48, 0.3)) f(most, w) WHERE age <= most), 0.2) AS DOUBLE) AS freshness_weight,
    measurement_timestamp, ingestion_timestamp,
    ingestion_timestamp + to_milliseconds(1400 + 1000 * (second(measurement_timestamp) % 3))
      AS enrichment_timestamp
  FROM factors)"""

_SCORED = """scored AS (
  SELECT r.*, CASE WHEN r.measurement_type = 'CONSCIOUSNESS' THEN coalesce(b.points, 3)
      ELSE b.points END AS score,
    routing_timestamp
      + to_milliseconds(1700 + 1000 * (second(measurement_timestamp) % 4)) AS scoring_timestamp,
    0.7::DOUBLE * quality_weight + 0.3::DOUBLE * freshness_weight AS trust_score
  FROM (SELECT *, enrichment_timestamp
      + to_milliseconds(300 + 1000 * (minute(measurement_timestamp) % 2)) AS routing_timestamp
    FROM enriched WHERE measurement_type IN (SELECT code FROM kinds)) r
  LEFT JOIN bands b ON b.code = r.measurement_type
    AND (b.above IS NULL OR r.value > b.above::DOUBLE)
    AND (b.lo IS NULL OR r.value >= b.lo::DOUBLE)
    AND (b.hi IS NULL OR r.value <= b.hi::DOUBLE))"""


def _pivot() -> str:
    parts = []
    for v in VITALS:
        mine = f"FILTER (WHERE measurement_type = '{v.code}')"
        parts.append(f"max(value) {mine} AS {v.prefix}_value")
        parts.append(f"CAST(coalesce(max(score) {mine}, 0) AS DOUBLE) AS {v.prefix}_score")
        parts.append(
            f"coalesce(CAST(sum(CAST(round(trust_score * 1000000000) AS BIGINT)) {mine} AS DOUBLE)"
            f" / CAST(count(trust_score) {mine} * 1000000000 AS DOUBLE), 0)"
            f" AS {v.prefix}_trust_score"
        )
    times = ", ".join(
        f"min({s}_timestamp) AS {s}_timestamp"
        for s in ("measurement", "ingestion", "enrichment", "routing", "scoring")
    )
    return f"""scores AS (
  SELECT *, scoring_timestamp + INTERVAL 2500 MILLISECONDS AS union_timestamp FROM (
    SELECT patient_id, date_trunc('minute', measurement_timestamp) AS window_start,
      date_trunc('minute', measurement_timestamp) + INTERVAL 1 MINUTE AS window_end,
      {', '.join(parts)}, {times}
    FROM scored WHERE measurement_timestamp IS NOT NULL
    GROUP BY patient_id, date_trunc('minute', measurement_timestamp)))"""


_TOTALS = f"""totals AS (
  SELECT *, {' + '.join(f'{p}_score' for p in PREFIXES)} AS news2_score,
    {' + '.join(f'{p}_trust_score' for p in PREFIXES)} AS news2_trust_score,
    union_timestamp + INTERVAL 1200 MILLISECONDS AS aggregation_timestamp
  FROM scores)"""

_STORED = (
    "stored AS (SELECT * REPLACE ("
    + ", ".join(
        f"date_trunc('second', {s}_timestamp) AS {s}_timestamp"
        for s in (
            "measurement",
            "ingestion",
            "enrichment",
            "routing",
            "scoring",
            "union",
            "aggregation",
        )
    )
    + """), date_trunc('second', date_trunc('second', aggregation_timestamp)
      + to_seconds(minute(window_start) % 5)) AS storage_timestamp FROM totals)"""
)

_STEPS = {
    "raw": _CLEAN,
    "factors": _FACTORS,
    "enriched": _ENRICHED,
    "scored": _SCORED,
    "scores": _pivot(),
    "totals": _TOTALS,
    "stored": _STORED,
}


def _from(step: str, select: str, raw: str = _CLEAN) -> str:
    """A query over one step of the pipeline, with all steps before it."""
    ctes = [_KINDS, _BANDS]
    for name, text in _STEPS.items():
        ctes.append(raw if name == "raw" else text)
        if name == step:
            break
    return "WITH " + ",\n".join(ctes) + "\n" + select


_ROUTED_COLUMNS = (
    "device_id, patient_id, value, quality_weight, freshness_weight, measurement_timestamp, "
    "ingestion_timestamp, enrichment_timestamp, routing_timestamp"
)
_SCORED_COLUMNS = (
    "patient_id, value, quality_weight, freshness_weight, score, measurement_timestamp, "
    "ingestion_timestamp, enrichment_timestamp, routing_timestamp, scoring_timestamp"
)
_BUCKET = "time_bucket(INTERVAL 30 MINUTE, window_start)"
_ALL_STORED = _from("stored", "SELECT * FROM stored WHERE patient_id IS NOT NULL")


def _pipeline() -> dict[str, str]:
    sql = {
        "parse_value": _from(
            "factors", "SELECT device_id, measurement_timestamp, raw_value, value FROM factors"
        ),
        "quarantine_bad": f"""WITH {_KINDS}, {_DIRTY}
SELECT device_id, ingestion_timestamp, raw_value, problem FROM judged WHERE problem IS NOT NULL""",
        "quarantine_good": _from("enriched", "SELECT * FROM enriched", _GOOD),
        "patient_id_extract": _from("factors", "SELECT device_id, patient_id FROM factors"),
        "quality_factors": _from(
            "factors",
            """SELECT device_id, battery, signal_strength, tier::DOUBLE AS tier_factor,
  charge::DOUBLE AS battery_factor, reach::DOUBLE AS signal_factor FROM factors""",
        ),
        "quality_weight": _from(
            "factors",
            """SELECT device_id, battery, signal_strength,
  CAST(CAST(tier * 0.7 + charge * 0.2 + reach * 0.1 AS DECIMAL(7, 2)) AS DOUBLE)
    AS quality_weight FROM factors""",
        ),
        "freshness_weight": _from(
            "enriched",
            """SELECT device_id, measurement_timestamp, ingestion_timestamp,
  date_sub('hour', measurement_timestamp, ingestion_timestamp) AS age_hours, freshness_weight
FROM enriched""",
        ),
        "enrich_measurements": _from("enriched", "SELECT * FROM enriched"),
        "score_all_one_pass": _from(
            "scored", f"SELECT measurement_type, {_SCORED_COLUMNS} FROM scored"
        ),
        "trust_score": _from(
            "scored",
            """SELECT measurement_type, patient_id, quality_weight, freshness_weight, trust_score
FROM scored""",
        ),
        "union_scores": _from(
            "scored", f"SELECT measurement_type, {_SCORED_COLUMNS}, trust_score FROM scored"
        ),
        "tumble_pivot": _from("scores", "SELECT * FROM scores"),
        "news2_totals": _from(
            "totals",
            """SELECT patient_id, window_start, news2_score, news2_trust_score,
  news2_trust_score / 6 AS news2_mean_trust FROM totals""",
        ),
        "news2_pipeline": _from("totals", "SELECT * FROM totals"),
        "news2_pipeline_quarantine": _from("totals", "SELECT * FROM totals", _GOOD),
        "load_typed": _from("stored", "SELECT * FROM stored"),
        "risk_band": _from(
            "stored",
            """SELECT patient_id, window_start, news2_score,
  (['green', 'yellow', 'orange', 'red'])[1 + (news2_score >= 3)::INT + (news2_score >= 5)::INT
    + (news2_score >= 7)::INT] AS risk FROM stored""",
        ),
        "hash_buckets": _from(
            "stored",
            """SELECT patient_id, count(*) AS n, 1::BIGINT AS n_buckets, TRUE AS in_range
FROM stored GROUP BY patient_id""",
        ),
    }
    sql["news2_pipeline_by_branch"] = sql["news2_pipeline"]
    for v in VITALS:
        only = f"FROM scored WHERE measurement_type = '{v.code}'"
        sql[f"route_{v.code.lower()}"] = _from("scored", f"SELECT {_ROUTED_COLUMNS} {only}")
        sql[f"score_{v.code.lower()}"] = _from("scored", f"SELECT {_SCORED_COLUMNS} {only}")
    return sql


# Latency of each hop, from and to.
_HOPS = (
    ("overall", "ingestion", "aggregation"),
    ("enrichment", "ingestion", "enrichment"),
    ("routing", "enrichment", "routing"),
    ("scoring", "routing", "scoring"),
    ("union", "scoring", "union"),
    ("aggregation", "union", "aggregation"),
)


def _serving() -> dict[str, str]:
    sql = {}
    means = []
    for name, (column, positive) in TRENDS.items():
        only = f"WHERE {column} > 0" if positive else ""
        sql[f"half_hour_{name}"] = _from(
            "stored",
            f"""SELECT patient_id, {_BUCKET} AS time_window, round(avg({column}), 10) AS mean
FROM stored {only} GROUP BY ALL""",
        )
        only = f"FILTER (WHERE {column} > 0)" if positive else ""
        means.append(f"round(avg({column}) {only}, 10) AS {name}")
    sql["half_hour_all_patients"] = _from(
        "stored",
        f"""SELECT patient_id, {_BUCKET} AS time_window, {', '.join(means)}
FROM stored GROUP BY patient_id, {_BUCKET}""",
    )
    for name, column, only in (
        ("half_hour_one_patient", "heart_rate_value", "AND heart_rate_value > 0"),
        ("half_hour_bound_parameter", "news2_score", ""),
    ):
        sql[name] = _from(
            "stored",
            f"""SELECT {_BUCKET} AS time_window, round(avg({column}), 10) AS mean
FROM stored WHERE patient_id = '{PATIENT}' {only} GROUP BY ALL""",
        )
    sql["distinct_patients"] = _from("stored", "SELECT DISTINCT patient_id FROM stored")
    sql["stage_latency_avg"] = _from(
        "stored",
        "SELECT "
        + ", ".join(
            f"round(avg(date_sub('second', {a}_timestamp, {b}_timestamp)), 9) AS avg_{n}_latency"
            for n, a, b in _HOPS
        )
        + " FROM stored",
    )
    for name, of in (
        ("served_half_hour_one_patient", "half_hour_one_patient"),
        ("served_patients", "distinct_patients"),
        ("served_stage_latency", "stage_latency_avg"),
    ):
        # The stored table takes no rows without a patient.
        sql[name] = sql[of].replace(
            "FROM stored", "FROM (SELECT * FROM stored WHERE patient_id IS NOT NULL) AS kept"
        )
    kept = "FROM (SELECT * FROM stored WHERE patient_id IS NOT NULL) AS kept"
    sql["rollup_half_hour"] = sql["half_hour_all_patients"].replace("FROM stored GROUP", f"{kept} GROUP")
    sql["bucketed_half_hour"] = sql["half_hour_all_patients"]
    sql["bucketed_one_patient"] = sql["half_hour_one_patient"]
    sql["bucketed_files"] = _from(
        "stored", "SELECT patient_id, count(*) AS n, TRUE AS in_its_bucket FROM stored GROUP BY patient_id"
    )
    sql["latency_max"] = _from(
        "stored",
        """SELECT max(date_sub('second', ingestion_timestamp, aggregation_timestamp))
    AS i2s_max_diff,
  max(date_sub('second', aggregation_timestamp, storage_timestamp)) AS max_storage_diff
FROM stored""",
    )
    return sql


_OBSERVED = _from(
    "totals",
    "SELECT minute(window_start) % 2 AS odd_minute, count(*) AS n_rows, "
    + ", ".join(
        f"round(avg(date_sub('second', {a}_timestamp, {b}_timestamp)), 9) AS avg_{n}_latency, "
        f"max(date_sub('second', {a}_timestamp, {b}_timestamp)) AS max_{n}_latency"
        for n, a, b in _HOPS
    )
    + " FROM totals GROUP BY ALL",
)


_CUSTOMERS = """SELECT customer, order_key, price, ordered_at FROM (
  SELECT o_custkey AS customer, o_orderkey AS order_key, o_totalprice AS price,
    CAST(o_orderdate AS TIMESTAMP) AS ordered_at, o_orderstatus AS status,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS place
  FROM orders) WHERE place = 1 AND status <> 'F'"""


_CDC = """SELECT c_custkey, c_name,
  round(CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 100 ELSE c_acctbal END, 2) AS c_acctbal,
  c_mktsegment FROM customer WHERE c_custkey % 7 <> 0"""


def _tables() -> dict[str, str]:
    scored = _from("scored", f"SELECT measurement_type, {_SCORED_COLUMNS} FROM scored")
    return {
        "raw_topic": _from("raw", "SELECT * FROM raw"),
        "topic_from_latest": _from("raw", "SELECT * FROM raw WHERE second(measurement_timestamp) % 20 = 5"),
        "archived_topic": _from("raw", "SELECT * FROM raw"),
        "clock_now": _from(
            "enriched", "SELECT measurement_type, count(*) AS n, TRUE AS in_time FROM enriched GROUP BY measurement_type"
        ),
        "enriched_topic": _from("enriched", "SELECT * FROM enriched"),
        "routed_folders": _from(
            "scored",
            f"SELECT measurement_type, {_ROUTED_COLUMNS} FROM scored",
        ),
        "scored_topics": scored,
        "scored_folders": scored,
        "upsert_topic": _CUSTOMERS,
        "upsert_topic_stream": _CUSTOMERS,
        "totals_topic": _from("totals", "SELECT * FROM totals WHERE patient_id IS NOT NULL"),
        "upsert_latest": _CUSTOMERS,
        "unique_key_compact": _CUSTOMERS,
        "latest_by_integer_key": f"""SELECT * FROM ({_CUSTOMERS}) AS c
WHERE customer = (SELECT max(customer) FROM ({_CUSTOMERS}) AS d)""",
        "upsert_two_writers": """SELECT o_custkey AS customer, o_orderkey AS order_key,
  o_totalprice AS price, o_orderdate::TIMESTAMP AS ordered_at FROM orders""",
        "stored_table_by_day": _ALL_STORED,
        "stored_days": """SELECT event_id, ts, value FROM events
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-15'""",
        "stored_retention": """SELECT event_id, ts, value FROM events
WHERE ts >= TIMESTAMP '2024-01-15'""",
        "upsert_auto_create": """SELECT o_custkey AS customer, max(o_orderkey) AS order_key,
  arg_max(o_totalprice, o_orderkey) AS price FROM orders GROUP BY o_custkey""",
        "overwrite_latest": _CUSTOMERS,
        "overwrite_replayed": _ALL_STORED,
        "overwrite_stream_final": _ALL_STORED,
        "stream_tumble_final": _ALL_STORED,
        "stream_staged_final": _ALL_STORED,
        "stream_late_keep": _ALL_STORED,
        "stream_late_drop": _from(
            "stored", "SELECT * FROM stored WHERE patient_id IS NOT NULL", _IN_TIME
        ),
        "stream_quarantine": f"""WITH {_KINDS}, {_DIRTY}
SELECT device_id, ingestion_timestamp, raw_value, coalesce(problem, 'no patient') AS problem
FROM judged WHERE problem IS NOT NULL OR NOT regexp_matches(device_id, '_P[0-9]+$')""",
        "stream_quarantine_good": _from(
            "stored", "SELECT * FROM stored WHERE patient_id IS NOT NULL", _GOOD
        ),
        "stream_ttl": _from(
            "stored", "SELECT * FROM stored WHERE patient_id IS NOT NULL", _AFRESH
        ),
        "stream_sums_final": _ALL_STORED,
        "stream_duplicates": _ALL_STORED,
        "stream_observed": _OBSERVED,
        "retention_7d": """SELECT event_id, ts, value FROM events
WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAYS""",
        "tier_split": """SELECT event_id, ts, value,
  CASE WHEN ts < (SELECT max(ts) FROM events) - INTERVAL 1 DAY THEN 'cold' ELSE 'hot' END AS tier
FROM events""",
        "tiered_table": """SELECT event_id, ts, value,
  CASE WHEN ts < TIMESTAMP '2024-01-20' THEN 'cold' ELSE 'hot' END AS tier
FROM events WHERE ts >= TIMESTAMP '2024-01-05'""",
        "tiered_by_day": """SELECT event_id, ts, value,
  CASE WHEN ts < TIMESTAMP '2024-01-20' THEN 'cold' ELSE 'hot' END AS tier
FROM events WHERE ts >= TIMESTAMP '2024-01-05'""",
        "incremental_copy": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
        "cdc_out_of_order": _CDC,
        "cdc_apply": _CDC,
        "mock_readings": _mock(),
    }


def _mock() -> str:
    """The made-up records of seed 7, with the mixing written out step by step."""

    def mixed(field: int) -> str:
        x, add = "(event_id % 2147483648)", 7 * 12345 + field * 7919 + 1
        for m in (1103515245, 69069, 1664525):
            x = f"(({x} * {m} + {add}) % 2147483648)"
        return f"({x} // 64)"

    kinds = "['HEART_RATE', 'TEMPERATURE', 'OXYGEN_SATURATION']"
    return f"""SELECT event_id + 1 AS iteration,
  ({kinds})[1 + ({mixed(1)} % 3)::INT] AS measurement_type,
  (300 + {mixed(2)} % 1101)::DOUBLE / 10 AS value,
  'MEDICAL_P' || (1 + {mixed(3)} % 99)::VARCHAR AS device_id,
  ({mixed(4)} % 101)::DOUBLE AS battery FROM events"""


_SAMPLES = """samples AS (
  SELECT event_type AS metric, 'i' || user_id % 3 AS instance, 'e' || user_id % 2 AS env, ts,
    value, ((event_id * 3 + floor(value)::BIGINT % 3) % 1000)::DOUBLE AS counter,
    CASE WHEN event_id % 5 <> 0 THEN value END AS gap,
    date_trunc('day', ts) + INTERVAL 1 DAY AS eval_time
  FROM events)"""
_LAST = """daily AS (
  SELECT metric, instance, env, eval_time, arg_max(value, ts) AS value FROM samples GROUP BY ALL)"""


def _rates(keys: str, at: str, seconds: int) -> str:
    return f"""rates AS (
  SELECT {keys}, {at} AS eval_time,
    sum(CASE WHEN counter < before THEN counter ELSE counter - before END) / {seconds} AS value
  FROM (SELECT {keys}, ts, counter, lag(counter) OVER (PARTITION BY {keys} ORDER BY ts) AS before
    FROM (SELECT {keys}, ts, max(counter) AS counter FROM samples GROUP BY ALL))
  WHERE before IS NOT NULL GROUP BY ALL)"""


def _metrics() -> dict[str, str]:
    series = "metric, instance, env"
    day = "date_trunc('day', ts) + INTERVAL 1 DAY"
    rates = f"WITH {_SAMPLES},\n{_rates(series, day, 86400)}\n"
    daily = f"WITH {_SAMPLES},\n{_LAST}\n"
    plain = f"WITH {_SAMPLES}\n"
    hour = "date_trunc('hour', ts) + INTERVAL 1 HOUR"
    return {
        "metric_rate": rates + f"SELECT {series}, eval_time, round(value, 10) AS value FROM rates",
        "metric_rate_hourly": f"WITH {_SAMPLES},\n{_rates('metric', hour, 3600)}\n"
        "SELECT metric, eval_time, round(value, 10) AS value FROM rates",
        "metric_rate_stepped": f"WITH {_SAMPLES},\n{_rates('metric', hour, 1)}\n"
        """SELECT metric, eval_time, round(sum(value) / 10800, 10) AS value FROM (
  SELECT metric, eval_time + to_hours(unnest(range(3))) AS eval_time, value FROM rates) GROUP BY ALL""",
        "metric_irate": plain
        + f"""SELECT {series}, eval_time,
  round((CASE WHEN counter < before THEN counter ELSE counter - before END)
    / ((epoch_us(ts) - epoch_us(earlier))::DOUBLE / 1000000), 10) AS value
FROM (SELECT {series}, eval_time, ts, counter,
    lag(counter) OVER w AS before, lag(ts) OVER w AS earlier,
    row_number() OVER (PARTITION BY {series}, eval_time ORDER BY ts DESC) AS place
  FROM samples WINDOW w AS (PARTITION BY {series}, eval_time ORDER BY ts))
WHERE place = 1 AND before IS NOT NULL""",
        "metric_instant": plain
        + f"""SELECT {series}, arg_max(value, ts) AS value FROM samples
WHERE ts <= TIMESTAMP '2024-01-15' AND ts > TIMESTAMP '2024-01-15' - INTERVAL 5 DAYS GROUP BY ALL""",
        "metric_instant_range": plain
        + f""", grid AS (
  SELECT DISTINCT {series}, time_bucket(INTERVAL 10 MINUTE, ts) + to_minutes(10 * unnest(range(5))) AS eval_time
  FROM samples)
SELECT {series}, eval_time, value FROM (
  SELECT {series}, g.eval_time, arg_max(s.value, (s.ts, s.value)) AS value
  FROM grid g JOIN (SELECT {series}, ts, value FROM samples) s USING ({series})
  WHERE s.ts <= g.eval_time AND s.ts > g.eval_time - INTERVAL 30 MINUTE
  GROUP BY {series}, g.eval_time)""",
        "metric_instant_range_busy": plain
        + """, grid AS (
  SELECT unnest(generate_series(TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-15', INTERVAL 1 MINUTE)) AS eval_time),
kept AS (SELECT ts, max(value) AS value FROM samples GROUP BY ts)
SELECT 'all' AS metric, eval_time, value
FROM grid ASOF JOIN kept ON grid.eval_time >= kept.ts WHERE kept.ts > eval_time - INTERVAL 5 MINUTE""",
        "metric_select_regex": plain
        + f"""SELECT {series}, count(*) AS n, max(value) AS max_value FROM samples
WHERE env = 'e1' AND (metric LIKE 'c%' OR metric LIKE 'v%') AND instance IN ('i0', 'i2')
GROUP BY ALL""",
        "metric_sum_avg_count": daily
        + """SELECT eval_time, round(sum(value), 2) AS sum_value, round(avg(value), 9) AS avg_value,
  count(value) AS n_series FROM daily GROUP BY eval_time""",
        "metric_sum_by": rates
        + "SELECT eval_time, env, round(sum(value), 10) AS value FROM rates GROUP BY eval_time, env",
        "metric_avg_by": daily
        + "SELECT eval_time, metric, round(avg(value), 9) AS value FROM daily GROUP BY eval_time, metric",
        "metric_sum_without": daily
        + "SELECT metric, env, eval_time, round(sum(value), 2) AS value FROM daily GROUP BY ALL",
        "metric_vector_add": rates
        + """SELECT eval_time, round(c.value + v.value, 6) AS value
FROM (SELECT eval_time, sum(value * 1000) AS value FROM rates WHERE metric = 'click' GROUP BY eval_time) c
JOIN (SELECT eval_time, sum(value * 1000) AS value FROM rates WHERE metric = 'view' GROUP BY eval_time) v
USING (eval_time)""",
        "metric_topk": daily
        + """SELECT eval_time, metric, instance, value FROM (
  SELECT *, row_number() OVER (PARTITION BY eval_time ORDER BY value DESC, metric, instance) AS place
  FROM (SELECT eval_time, metric, instance, round(sum(value), 2) AS value FROM daily GROUP BY ALL))
WHERE place <= 10""",
        "metric_panel_sets": daily
        + """SELECT panel, eval_time, metric, instance, env, round(value, 2) AS value FROM (
  SELECT 'by metric' AS panel, eval_time, metric, NULL::VARCHAR AS instance, NULL::VARCHAR AS env, sum(value) AS value
  FROM daily GROUP BY eval_time, metric
  UNION ALL SELECT 'by instance', eval_time, NULL, instance, NULL, sum(value) FROM daily GROUP BY eval_time, instance
  UNION ALL SELECT 'by metric and env', eval_time, metric, NULL, env, sum(value) FROM daily GROUP BY eval_time, metric, env
  UNION ALL SELECT 'all', eval_time, NULL, NULL, NULL, sum(value) FROM daily GROUP BY eval_time)""",
        "metric_label_values": plain
        + "SELECT DISTINCT instance AS label_value FROM samples WHERE metric = 'click'",
        "metric_range_reduce": plain
        + f"""SELECT {series}, max(gap) AS max_value,
  arg_max(gap, ts) FILTER (WHERE gap IS NOT NULL) AS last_not_null
FROM samples GROUP BY ALL""",
        "metric_panel": plain
        + """SELECT metric, instance, eval_time, arg_max(value, ts) AS value FROM samples
WHERE metric IN ('click', 'view', 'error') GROUP BY ALL""",
    }


def oracle_sql() -> dict[str, str]:
    """SQL by query name."""
    return {**_pipeline(), **_serving(), **_tables(), **_metrics()}
