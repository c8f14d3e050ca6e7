"""Stages together: pivot, totals, skew, and the shape of the plans."""

import contextlib
import datetime as dt
import io
import math
import re

import pytest
from pyspark.sql import functions as F

from tests.rows import NOON, as_dicts, at, bag, raw_frame, reading
from wardline.operators import serve
from wardline.operators.enrich import enrich, split_bad
from wardline.operators.route import route
from wardline.operators.score import score_all
from wardline.operators.totals import load_typed, totals
from wardline.operators.window import tumble_pivot
from wardline.plans.catalog import CATALOG
from wardline.plans.pipeline import (
    early_warning,
    fixed_clocks,
    scored_readings,
    scored_readings_by_branch,
    stored_table,
)
from wardline.plans.readings import raw_readings
from wardline.schemas import ENRICHED, ROUTED, SCORED, SCORES, STORED, TOTALS
from wardline.vitals import CODES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def full_plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def test_missing_vital_adds_nothing(spark):
    raw = raw_frame(spark, [reading("HEART_RATE", "140"), reading("TEMPERATURE", "39.05")])
    row = early_warning(raw, fixed_clocks()).first()
    assert (row.heart_rate_value, row.heart_rate_score) == (140.0, 3.0)
    # A value between two bands scores nothing, but is shown and trusted.
    assert (row.temperature_value, row.temperature_score) == (39.05, 0.0)
    assert row.temperature_trust_score == 1.0
    assert (row.respiratory_rate_value, row.respiratory_rate_score) == (None, 0.0)
    assert row.respiratory_rate_trust_score == 0.0
    assert (row.news2_score, row.news2_trust_score) == (3.0, 2.0)


def test_highest_value_highest_score_mean_trust(spark):
    raw = raw_frame(
        spark,
        [
            reading(value="45", when=at(seconds=1)),
            reading(value="70", when=at(seconds=59), battery=None, device_id="BASIC_hr_P0001"),
        ],
    )
    row = early_warning(raw, fixed_clocks()).first()
    assert (row.heart_rate_value, row.heart_rate_score) == (70.0, 1.0)
    # 0.7 * (1.0 + 0.46) / 2 + 0.3
    assert row.heart_rate_trust_score == pytest.approx(0.811, abs=1e-12)
    assert row.measurement_timestamp == at(seconds=1)


def test_windows_are_closed_below_and_open_above(spark):
    raw = raw_frame(
        spark, [reading(when=at(seconds=s)) for s in (0, 59.999, 60)]
    )
    rows = as_dicts(early_warning(raw, fixed_clocks()), "window_start")
    assert [r["window_start"] for r in rows] == [NOON, at(minutes=1)]
    assert rows[0]["window_end"] == at(minutes=1)


def test_readings_without_patient_are_one_group(spark):
    raw = raw_frame(spark, [reading(device_id="a"), reading(device_id="b"), reading()])
    rows = as_dicts(early_warning(raw, fixed_clocks()), "patient_id")
    assert [r["patient_id"] for r in rows] == [None, "P0001"]


def test_unknown_type_goes_nowhere(spark):
    raw = raw_frame(spark, [reading("BODY_WEIGHT", "80")])
    assert early_warning(raw, fixed_clocks()).count() == 0
    assert all(df.count() == 0 for df in route(enrich(raw)).values())


def test_nan_reading_is_highest(spark):
    raw = raw_frame(spark, [reading(value="NaN"), reading(value="70")])
    row = early_warning(raw, fixed_clocks()).first()
    assert math.isnan(row.heart_rate_value)
    assert row.heart_rate_score == 3.0


def test_faulty_readings_stop_the_job_or_are_set_aside(spark):
    faulty = [
        reading(value="n/a"), reading(value="NaN"), reading(value="Infinity"),
        reading(measurement_timestamp=None),
    ]
    raw = raw_frame(spark, [reading(), reading(value=None), *faulty])
    good, bad = split_bad(raw)
    assert good.count() == 2
    problems = sorted(r.problem for r in bad.collect())
    assert problems == ["no measurement time", "not a number", "not finite", "not finite"]
    assert enrich(raw, "quarantine").count() == 2
    for row, message in ((faulty[0], "not a number"), (faulty[3], "measurement time")):
        with pytest.raises(Exception, match=message):
            early_warning(raw_frame(spark, [row])).collect()
    with pytest.raises(ValueError):
        enrich(raw, "ignore")


def test_schemas(spark, sf_dir):
    raw = raw_readings(spark, sf_dir)
    at_ = fixed_clocks()
    enriched = enrich(raw, clock=at_.enrichment)
    pairs = [
        (enriched, ENRICHED),
        (route(enriched)[CODES[0]], ROUTED),
        (score_all(enriched).drop("measurement_type"), SCORED),
        (tumble_pivot(scored_readings(raw, at_), clock=at_.union), SCORES),
        (early_warning(raw, at_), TOTALS),
        (stored_table(raw, at_), STORED),
        (early_warning(raw), TOTALS),
    ]
    for df, schema in pairs:
        typed = [(f.name, f.dataType.simpleString()) for f in schema]
        assert [n for n, _ in df.dtypes] == [n for n, _ in typed]
        # Times a stage stamps itself carry a zone until they are stored.
        assert [(n, t) for n, t in df.dtypes if t != "timestamp"] == [
            p for p, (_, t) in zip(typed, df.dtypes) if t != "timestamp"
        ]


def test_one_pass_equals_six_branches(spark, sf_dir):
    raw = raw_readings(spark, sf_dir)
    one = scored_readings(raw, fixed_clocks())
    six = scored_readings_by_branch(raw, fixed_clocks())
    assert bag(one) == bag(six)
    clock = fixed_clocks().union
    assert bag(tumble_pivot(one, clock=clock)) == bag(tumble_pivot(six, clock=clock))


def test_ranges_hold(spark, sf_dir):
    raw = raw_readings(spark, sf_dir)
    scored = scored_readings(raw, fixed_clocks())
    limits = scored.agg(
        F.min("quality_weight"), F.max("quality_weight"), F.min("trust_score"),
        F.max("trust_score"), F.min("score"), F.max("score"),
    ).first()
    assert 0.4 <= limits[0] <= limits[1] <= 1.0
    assert 0.34 - 1e-12 <= limits[2] <= limits[3] <= 1.0
    assert (limits[4], limits[5]) == (0, 3)
    final = early_warning(raw, fixed_clocks())
    top = final.agg(F.min("news2_score"), F.max("news2_score"), F.max("news2_trust_score")).first()
    assert 0 <= top[0] <= top[1] <= 18 and top[2] <= 6


def test_order_and_splits_do_not_change_a_bit(spark, sf_dir):
    raw = raw_readings(spark, sf_dir)
    first = bag(early_warning(raw.repartition(7), fixed_clocks()))
    assert bag(early_warning(raw.orderBy(F.rand(3)).coalesce(2), fixed_clocks())) == first


def test_a_third_of_all_readings_for_one_patient_and_minute(spark):
    """Heavy keys are combined before the shuffle: few rows of them travel."""
    n = 30_000
    ids = spark.range(n, numPartitions=8)
    hot = F.col("id") % 3 == 0
    raw = ids.select(
        F.when(hot, F.lit(NOON)).otherwise(
            F.timestamp_add("SECOND", (F.col("id") % 3000).cast("int"), F.lit(NOON))
        ).cast("timestamp_ntz").alias("measurement_timestamp"),
        F.lit("HEART_RATE").alias("measurement_type"),
        (F.col("id") % 100).cast("string").alias("raw_value"),
        F.when(hot, "MEDICAL_hr_P1").otherwise(
            F.concat(F.lit("MEDICAL_hr_P"), (F.col("id") % 50 + 2).cast("string"))
        ).alias("device_id"),
        F.lit(90.0).alias("battery"),
        F.lit(0.9).alias("signal_strength"),
        F.lit(NOON).cast("timestamp_ntz").alias("ingestion_timestamp"),
    )
    final = early_warning(raw, fixed_clocks())
    row = final.filter((F.col("patient_id") == "P1")).collect()
    assert len(row) == 1
    assert row[0].heart_rate_value == 99.0
    assert row[0].heart_rate_trust_score == 1.0


def test_pipeline_has_one_shuffle_and_reads_two_columns(spark, sf_dir):
    text = plan(CATALOG["load_typed"](spark, sf_dir))
    keyed = re.findall(r"Exchange hashpartitioning\(patient_id", text)
    assert len(keyed) == 1
    assert len(re.findall(r"Exchange ", text)) - len(re.findall("RoundRobin", text)) == 1
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in text
    assert text.index("partial_max") > text.index("Exchange hashpartitioning(patient_id")
    assert "PythonUDF" not in text and "BatchEvalPython" not in text


def test_patient_and_type_filters_reach_the_files(spark, tmp_path):
    raw = raw_frame(spark, [reading(k, "70") for k in CODES])
    enrich(raw).write.parquet(str(tmp_path / "enriched"))
    stored = str(tmp_path / "stored")
    stored_table(raw).write.parquet(stored)
    text = full_plan(route(spark.read.parquet(str(tmp_path / "enriched")))["HEART_RATE"])
    assert "EqualTo(measurement_type,HEART_RATE)" in text
    trend = serve.half_hour_mean(
        spark.read.parquet(stored), "heart_rate_value", "P0001", positive_only=True
    )
    text = full_plan(trend)
    assert "EqualTo(patient_id,P0001)" in text
    assert "GreaterThan(heart_rate_value,0.0)" in text
    assert re.search(
        r"ReadSchema: struct<patient_id:string,window_start:timestamp_ntz,heart_rate_value:double>",
        text,
    )


def test_distinct_patients_skips_all_scoring(spark, sf_dir):
    text = plan(CATALOG["distinct_patients"](spark, sf_dir))
    assert "CASE" not in text.split("HashAggregate")[0]
    assert "max(" not in text


def test_stored_times_are_cut_not_rounded(spark):
    raw = raw_frame(spark, [reading(when=at(milliseconds=999))])
    row = stored_table(raw, fixed_clocks()).first()
    assert row.measurement_timestamp == NOON
    assert row.storage_timestamp.microsecond == 0


def test_load_time_defaults_to_now(spark):
    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    row = load_typed(totals(tumble_pivot(scored_readings(raw_frame(spark, [reading()]))))).first()
    after = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert before <= row.storage_timestamp <= after
    assert before <= row.enrichment_timestamp <= row.aggregation_timestamp <= after


def test_trends(spark):
    raw = raw_frame(
        spark,
        [
            reading(value="60", when=at(minutes=1)),
            reading(value="80", when=at(minutes=2)),
            reading(value="0", when=at(minutes=3)),
            reading(value="100", when=at(minutes=31)),
            reading("TEMPERATURE", "37", when=at(minutes=31)),
            reading(value="10", patient="P0002"),
        ],
    )
    final = stored_table(raw, fixed_clocks())
    one = serve.half_hour_mean(final, "heart_rate_value", "P0001", positive_only=True)
    assert [tuple(r) for r in one.collect()] == [(NOON, 70.0), (at(minutes=30), 100.0)]
    every = serve.half_hour_mean(final, "heart_rate_value", "P0001")
    assert [r["mean"] for r in every.collect()] == [pytest.approx(140 / 3), 100.0]
    bound = serve.half_hour_bound(final, "heart_rate", "P0001")
    assert [tuple(r) for r in bound.collect()] == [(NOON, 70.0), (at(minutes=30), 100.0)]
    # A patient id is data, never SQL.
    assert serve.half_hour_bound(final, "news2", "x' OR '1'='1").count() == 0
    assert [r[0] for r in serve.patients(final).collect()] == ["P0001", "P0002"]
    assert serve.half_hour_all(final).count() == 3
