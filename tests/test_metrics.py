"""Metric queries against brute force, with resets, gaps and one very busy series."""

import datetime as dt
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.rows import NOON, at
from wardline.operators import metrics as M

SCHEMA = "metric string, instance string, ts timestamp_ntz, value double"
SERIES = ["metric", "instance"]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def _end(ts, seconds):
    start = dt.datetime(1970, 1, 1)
    return start + dt.timedelta(seconds=((ts - start) // dt.timedelta(seconds=seconds) + 1) * seconds)


def _grown(a, b):
    return b if b < a else b - a


def _by_series(rows):
    """One sample per series and time, the largest, in order of time."""
    best = {}
    for metric, instance, ts, value in rows:
        best[metric, instance, ts] = max(value, best.get((metric, instance, ts), value))
    series = defaultdict(list)
    for (metric, instance, ts), value in sorted(best.items()):
        series[metric, instance].append((ts, value))
    return series


def brute_rate(rows, seconds, last_two=False):
    out = defaultdict(float)
    for key, samples in _by_series(rows).items():
        for (t0, a), (t1, b) in zip(samples, samples[1:]):
            end = _end(t1, seconds)
            if not last_two:
                out[*key, end] += _grown(a, b) / seconds
            elif _end(t0, seconds) == end:
                out[*key, end] = _grown(a, b) / (t1 - t0).total_seconds()
    return dict(out)


def as_map(df):
    return {(r.metric, r.instance, r.eval_time): r.value for r in df.collect()}


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.sampled_from("ab"), st.integers(0, 900), st.integers(0, 50)),
        min_size=30,
        max_size=120,
    ),
    st.sampled_from(["5 minutes", "1 minute", "20 seconds"]),
)
def test_rates(spark, points, piece):
    rows = [("m", i, at(seconds=s), float(v)) for i, s, v in points]
    df = frame(spark, rows)
    got = as_map(M.counter_rate(df, SERIES, "5 minutes", piece=piece))
    assert got == pytest.approx(brute_rate(rows, 300))
    got = as_map(M.irate(df, SERIES, "5 minutes"))
    assert got == pytest.approx(brute_rate(rows, 300, last_two=True))


@pytest.mark.parametrize("step", [None, "30 seconds"])
def test_a_steady_counter_has_its_true_rate(spark, step):
    rows = [("m", "a", at(seconds=10 * i), float(10 * i)) for i in range(60)]
    got = as_map(M.counter_rate(frame(spark, rows), SERIES, "1 minute", step))
    whole = [v for (_, _, end), v in got.items() if at(seconds=70) <= end <= at(seconds=590)]
    assert len(whole) >= 8 and whole == pytest.approx([1.0] * len(whole))


def test_one_series_with_a_third_of_all_samples(spark):
    n = 60_000
    hot = F.col("id") % 3 == 0
    df = spark.range(n, numPartitions=8).select(
        F.lit("m").alias("metric"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("i"), F.col("id") % 40)).alias("instance"),
        F.timestamp_micros(
            F.lit(1_742_126_400_000_000) + F.col("id") * 5000
        ).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 1000).cast("double").alias("value"),
    )
    rows = [tuple(r) for r in df.collect()]
    rate = M.counter_rate(df, SERIES, "5 minutes")
    assert as_map(rate) == pytest.approx(brute_rate(rows, 300))
    last = M.irate(df, SERIES, "5 minutes")
    assert as_map(last) == pytest.approx(brute_rate(rows, 300, last_two=True))
    # Ranked groups are cut down before they travel.
    text = last._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") >= 2
    # No task holds the whole of the busy series and window.
    text = rate._jdf.queryExecution().executedPlan().toString()
    assert any("_piece" in x.split(")")[0] for x in text.split("Exchange hashpartitioning")[1:])


def test_instant(spark):
    rows = [("m", "a", at(seconds=s), float(s)) for s in (0, 60, 120)]
    rows.append(("m", "b", at(minutes=-10), 7.0))
    df = frame(spark, rows)
    got = M.instant(df, SERIES, "2025-03-16 12:01:30").collect()
    assert [(r.instance, r.value) for r in got] == [("a", 60.0)]
    got = M.instant(df, SERIES, "2025-03-16 12:01:30", "1 hour").collect()
    assert sorted((r.instance, r.value) for r in got) == [("a", 60.0), ("b", 7.0)]


def test_matchers_match_whole_values(spark):
    rows = [(m, "a", NOON, 1.0) for m in ("cpu", "cpu_total", "mem")]
    df = frame(spark, rows)
    assert M.select_series(df, matching={"metric": "cpu"}).count() == 1
    assert M.select_series(df, matching={"metric": "cpu|mem"}).count() == 2
    assert M.select_series(df, {"metric": "mem"}, {"instance": "a|b"}).count() == 1


def test_aggregation_by_label(spark):
    rows = [
        ("m", "a", NOON, 1.0), ("m", "b", NOON, 3.0), ("n", "a", NOON, 5.0),
    ]
    df = frame(spark, rows).drop("ts")
    total = {how: M.aggregate_by(df, how).first().value for how in ("sum", "avg", "count", "min", "max")}
    assert total == {"sum": 9.0, "avg": 3.0, "count": 3, "min": 1.0, "max": 5.0}
    assert {r.metric: r.value for r in M.sum_by(df, ["metric"]).collect()} == {"m": 4.0, "n": 5.0}
    assert {r.metric: r.value for r in M.sum_without(df, ["instance"]).collect()} == {"m": 4.0, "n": 5.0}
    assert sorted(r.value for r in M.scaled(df, 2.0).collect()) == [2.0, 6.0, 10.0]
    assert sorted(r[0] for r in M.label_values(df, "instance").collect()) == ["a", "b"]
    assert [r[0] for r in M.label_values(df, "instance", "n").collect()] == ["a"]


def test_vector_match_is_one_to_one(spark):
    left = spark.createDataFrame([(1, 10.0), (2, 20.0)], "t int, value double")
    right = spark.createDataFrame([(2, 1.0), (3, 2.0)], "t int, value double")
    assert [tuple(r) for r in M.vector_add(left, right, ["t"]).collect()] == [(2, 21.0)]
    twice = right.union(right)
    with pytest.raises(Exception, match="more than one value"):
        M.vector_add(left, twice, ["t"]).collect()


def test_topk_per_time(spark):
    rows = [(t, f"k{i:02d}", float(i // 2)) for t in (1, 2) for i in range(30)]
    df = spark.createDataFrame(rows, "t int, k string, value double")
    got = sorted((r.t, r.k) for r in M.topk(df, 3, ["t"], ["k"]).collect())
    assert got == [(t, k) for t in (1, 2) for k in ("k26", "k28", "k29")]


def test_range_reducers_skip_unknown_values(spark):
    rows = [("m", "a", at(seconds=0), 9.0), ("m", "a", at(seconds=1), 4.0), ("m", "a", at(seconds=2), None)]
    row = M.range_reduce(frame(spark, rows), SERIES).first()
    assert (row.max_value, row.last_not_null) == (9.0, 4.0)


def test_labels_and_panels(spark):
    df = spark.createDataFrame(
        [("cpu", {"name": "x", "job": "j"}, NOON, 1.0), ("cpu", {"name": "y"}, NOON, 2.0),
         ("mem", {"name": "x"}, NOON, 3.0)],
        "metric string, labels map<string,string>, ts timestamp_ntz, value double",
    )
    lifted = M.lift_labels(df, ["name", "job"])
    assert lifted.columns == ["metric", "ts", "value", "name", "job"]
    got = M.panel(lifted, ["cpu"], "name", "1 minute").collect()
    assert sorted((r.metric, r.name, r.value) for r in got) == [("cpu", "x", 1.0), ("cpu", "y", 2.0)]
    assert got[0].eval_time == at(minutes=1)


def test_window_lengths():
    assert [M.window_seconds(w) for w in ("1 minute", "5 minutes", "30 seconds", "2 hours", "1 day")] == [
        60, 300, 30, 7200, 86400,
    ]
