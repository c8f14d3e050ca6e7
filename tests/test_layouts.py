"""Bucketed tables, tiers by day, half-hour roll-ups and sets of labels."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.rows import at, bag, raw_frame, reading
from wardline.operators import metrics, serve
from wardline.plans.pipeline import fixed_clocks, stored_table
from wardline.plans.readings import raw_readings
from wardline.sources import folders
from wardline.sources.bucketed import drop, file_bucket, new_name, save_bucketed
from wardline.sources.tier_days import TierDays
from wardline.sources.upsert import bucket_of
from wardline.streaming.partitioned import partitioned_at
from wardline.streaming.rollup import add_minutes, rollup_at, trends_of

AT = fixed_clocks


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def bucketed(spark, sf_dir, tmp_path):
    name = new_name()
    rows = stored_table(raw_readings(spark, sf_dir), AT())
    yield save_bucketed(rows, name, "patient_id", sort_by=["window_start"], path=str(tmp_path / "t"))
    drop(spark, name)


def test_aggregates_by_the_bucketed_key_need_no_exchange(bucketed):
    for df in (serve.half_hour_all(bucketed), bucketed.groupBy("patient_id").count()):
        assert "Exchange" not in plan_of(df)
    latest = bucketed.groupBy("patient_id").agg(F.max("window_start").alias("last"))
    assert "Exchange" not in plan_of(bucketed.hint("merge").join(latest, "patient_id"))


def test_a_look_up_reads_one_bucket(bucketed):
    one = serve.half_hour_mean(bucketed.filter("patient_id = 'P00000001'"), "news2_score")
    assert "SelectedBucketsCount: 1 out of 4" in plan_of(one)
    assert one.count() > 0


def test_files_are_named_by_bucket(bucketed):
    wrong = bucketed.filter(file_bucket() != bucket_of(F.col("patient_id")))
    assert wrong.count() == 0 and bucketed.select(file_bucket().alias("b")).distinct().count() == 4


SCHEMA = "id long, ts timestamp_ntz"


def tiers(spark, tmp_path):
    days = spark.createDataFrame([(i, dt.datetime(2025, 1, 1 + i % 10, i % 24)) for i in range(60)], SCHEMA)
    return TierDays(spark, str(tmp_path / "t"), days.schema, "ts"), days


def test_tiers_together_never_change(spark, tmp_path):
    table, days = tiers(spark, tmp_path)
    assert table.read().count() == 0
    table.append(days)
    everything = bag(days)
    assert bag(table.read()) == everything and table.boundary() is None
    table.move(dt.date(2025, 1, 4))
    assert bag(table.read()) == everything
    late = spark.createDataFrame([(1000, dt.datetime(2025, 1, 2)), (1001, dt.datetime(2025, 1, 9))], SCHEMA)
    table.append(late)
    table.move(dt.date(2025, 1, 4))  # nothing to do
    table.move(dt.date(2025, 1, 8))
    everything = bag(days.union(late))
    assert bag(table.read()) == everything
    cold = table.read(tier=True).filter("tier = 'cold'")
    assert {r.ts.day for r in cold.collect()} == set(range(1, 8)) and table.boundary() == dt.date(2025, 1, 8)
    some = table.read((dt.date(2025, 1, 7), dt.date(2025, 1, 8)))
    assert {r.ts.day for r in some.collect()} == {7, 8}
    table.purge(dt.date(2025, 1, 9))
    assert {r.ts.day for r in table.read().collect()} == {9, 10}


def test_a_move_that_died_is_done_again(spark, tmp_path):
    table, days = tiers(spark, tmp_path)
    table.append(days)
    everything = bag(days)
    drop_hot, table._drop = table._drop, lambda *_: None
    table.move(dt.date(2025, 1, 4))  # copied and parted, but the hot folders stand
    assert bag(table.read()) == everything
    folders.delete(spark, f"{table.root}/boundary/2025-01-04/_SUCCESS")  # copied, but not parted
    assert table.boundary() is None and bag(table.read()) == everything
    table._drop = drop_hot
    table.move(dt.date(2025, 1, 4))
    assert bag(table.read()) == everything
    table.move(dt.date(2025, 1, 6))
    assert bag(table.read()) == everything


def test_tiers_prune_by_day(spark, tmp_path):
    table, days = tiers(spark, tmp_path)
    table.append(days)
    table.move(dt.date(2025, 1, 4))
    plan = table.read((dt.date(2025, 1, 2), dt.date(2025, 1, 5)))._jdf.queryExecution().toString()
    assert plan.count("PartitionFilters: [isnotnull(_day") >= 2


def final(spark, readings):
    return stored_table(raw_frame(spark, readings), AT()).filter("patient_id IS NOT NULL")


def test_a_roll_up_follows_changed_minutes_and_replays(spark, tmp_path):
    first = [reading(value=str(60 + m), when=at(minutes=m)) for m in range(0, 70, 7)]
    first += [reading("TEMPERATURE", "37.5", "P0002", at(minutes=3)), reading(patient="P0003", value="0")]
    second = [reading(value="150", when=at(minutes=7)), reading("TEMPERATURE", "39.5", "P0002", at(minutes=3))]
    minutes = partitioned_at(spark, str(tmp_path / "m"), null_key="drop")
    rollup = rollup_at(spark, str(tmp_path / "r"), null_key="drop")
    add_minutes(minutes, rollup, final(spark, first), 0)
    add_minutes(minutes, rollup, final(spark, first), 0)  # comes again as a whole
    changed = final(spark, second).select("patient_id", "window_start")
    rows = final(spark, first + second).join(changed, ["patient_id", "window_start"], "left_semi").select(*minutes.schema.names)
    add_minutes(minutes, rollup, rows, 1)
    expected = serve.half_hour_all(final(spark, first + second))
    rounded = lambda df: bag(df.select("patient_id", "time_window", *(F.round(c, 9).alias(c) for c in serve.TRENDS)))
    assert rounded(trends_of(rollup.read())) == rounded(expected)
    # died after the roll-up and before the minutes: the pending rows are taken, not worked out again
    folders.delete(spark, minutes.rows_path)
    add_minutes(minutes, rollup, rows, 1)
    assert rounded(trends_of(rollup.read())) == rounded(expected)


def test_sets_of_labels_equal_their_aggregates_with_one_exchange(spark):
    rows = [(m, i, e, float(v)) for v, (m, i, e) in enumerate([("a", "x", None), ("a", "y", "p"), ("b", "x", "p"), (None, "y", "q")] * 3)]
    vector = spark.createDataFrame(rows, "metric string, instance string, env string, value double")
    sets = {"one": ["metric"], "two": ["instance", "env"], "none": []}
    for how in ("sum", "avg", "count", "min", "max"):
        got = metrics.aggregate_sets(vector, how, sets)
        assert got.columns == ["panel", "metric", "instance", "env", "value"]
        for name, by in sets.items():
            part = got.filter(F.col("panel") == name).select(*by, "value")
            assert bag(part) == bag(metrics.aggregate_by(vector, how, by))
    assert plan_of(metrics.aggregate_sets(vector, "sum", sets)).count("Exchange") == 1
    with pytest.raises(ValueError):
        metrics.aggregate_sets(vector, "sum", {"a": ["metric", "env"], "b": ["env", "metric"]})
