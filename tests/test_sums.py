"""Stored sums: late readings, idle windows, replays; repeated records; measures of batches."""

import datetime as dt

import pytest

from tests.rows import NOON, at, bag, raw_frame, reading
from wardline.plans import catalog
from wardline.plans.pipeline import fixed_clocks, scored_readings, stored_table
from wardline.schemas import RAW
from wardline.sources.json_topics import without_repeats
from wardline.streaming.observed import BatchMeasures
from wardline.streaming.partitioned import partitioned_at, start_partitioned
from wardline.streaming.pipeline import UNTIL_DONE
from wardline.streaming.sums import add_sums, final_of, start_sums, sums_at

AT = fixed_clocks


def batch_result(spark, readings):
    return bag(stored_table(raw_frame(spark, readings), AT()).filter("patient_id IS NOT NULL"))


def some(n=12):
    kinds = [("HEART_RATE", "140"), ("TEMPERATURE", "38.5"), ("CONSCIOUSNESS", "0")]
    return [
        reading(k, v, f"P000{p}", at(seconds=20 * s), battery=float(10 * s % 100))
        for p in (1, 2)
        for s in range(n)
        for k, v in kinds
    ]


def added(spark, table, readings, batch, minute, lifetime=None):
    add_sums(table, scored_readings(raw_frame(spark, readings), AT()), batch, at(minutes=minute), lifetime)


def test_sums_of_batches_equal_one_batch_and_a_replay_counts_once(spark, tmp_path):
    table, readings = sums_at(spark, str(tmp_path), null_key="drop"), some()
    added(spark, table, readings[0::3], 0, 0)
    added(spark, table, readings[1::3], 1, 60)
    added(spark, table, readings[2::3], 2, 9999)
    assert bag(final_of(table, AT())) == batch_result(spark, readings)
    added(spark, table, readings[2::3], 2, 10_000)
    assert bag(final_of(table, AT())) == batch_result(spark, readings)


def test_idle_windows_start_afresh_and_others_stay(spark, tmp_path):
    table, five = sums_at(spark, str(tmp_path), null_key="drop"), dt.timedelta(minutes=5)
    early = [reading(value="140", when=at(seconds=1)), reading(value="90", patient="P0002", when=at(seconds=1))]
    within = [reading(value="60", when=at(seconds=2))]
    after = [reading(value="50", when=at(seconds=3))]
    added(spark, table, early, 0, 0, five)
    added(spark, table, within, 1, 5, five)  # exactly the lifetime: still alive
    assert bag(final_of(table, AT())) == batch_result(spark, early + within)
    added(spark, table, after, 2, 11, five)
    assert bag(final_of(table, AT())) == batch_result(spark, after + early[1:])


def test_one_patient_is_read_from_one_bucket(spark, tmp_path):
    table = sums_at(spark, str(tmp_path), null_key="drop")
    added(spark, table, some(), 0, 0)
    mine = final_of(table, AT(), key="P0001")
    assert {r.patient_id for r in mine.collect()} == {"P0001"}
    assert "PartitionFilters: [isnotnull(_bucket" in mine._jdf.queryExecution().toString()


def arrivals(spark, folder, readings):
    raw_frame(spark, readings).coalesce(1).write.mode("append").parquet(folder)


def stream_of(spark, folder):
    return spark.readStream.schema(RAW).parquet(folder)


def test_the_stream_restarts_and_keeps_late_readings(spark, tmp_path):
    table, readings = sums_at(spark, str(tmp_path / "t"), null_key="drop"), some()
    for part in (readings[0::2], readings[1::2]):
        arrivals(spark, str(tmp_path / "raw"), part)
        start_sums(
            stream_of(spark, str(tmp_path / "raw")), table, str(tmp_path / "c"), trigger=UNTIL_DONE, at=AT()
        ).awaitTermination()
    assert bag(final_of(table, AT())) == batch_result(spark, readings)


def test_repeats_on_a_batch(spark):
    rows = raw_frame(spark, [*some(2), *some(2), reading(value="71")])
    assert without_repeats(rows, "1 hour").count() == len(some(2)) + 1


def test_repeats_on_a_stream_with_bounded_state(spark, tmp_path):
    """An hour of readings a run; each run brings the one before again. State is that of four hours, not all."""
    folder, out, held = str(tmp_path / "raw"), str(tmp_path / "out"), []
    hours = [
        [reading(value=str(60 + m), when=at(hours=h, minutes=m), ingestion_timestamp=at(hours=h, minutes=m)) for m in range(60)]
        for h in range(6)
    ]
    for h, now in enumerate(hours):
        arrivals(spark, folder, now + now[:10] + (hours[h - 1] if h else []))
        query = (
            without_repeats(stream_of(spark, folder), "2 hours")
            .writeStream.option("checkpointLocation", str(tmp_path / "c"))
            .option("path", out)
            .trigger(**UNTIL_DONE)
            .start()
        )
        query.awaitTermination()
        held.append(query.lastProgress.stateOperators[0].numRowsTotal)
    got = spark.read.parquet(out)
    assert got.dtypes == raw_frame(spark, []).dtypes
    assert bag(got) == bag(raw_frame(spark, sum(hours, [])))
    assert held[-3:] == [240, 240, 240]


def test_repeats_are_remembered_on_disk_in_any_session(spark, tmp_path, monkeypatch):
    """Spark's own default holds all state on the heap."""
    provider = "spark.sql.streaming.stateStore.providerClass"
    heap = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    before = spark.conf.get(provider)
    folder = tmp_path / "shared"
    monkeypatch.setattr(catalog, "shared_dir", lambda spark, name: f"{folder}/{name}")
    spark.createDataFrame([(i * 1250, i) for i in range(40)], "event_id long, user_id long").write.parquet(
        str(tmp_path / "events.parquet")
    )
    spark.conf.set(provider, heap)
    try:
        rows = catalog.CATALOG["stream_duplicates"](spark, str(tmp_path)).count()
        assert spark.conf.get(provider) == heap
    finally:
        spark.conf.set(provider, before)
    assert rows == catalog.CATALOG["news2_pipeline"](spark, str(tmp_path)).where("patient_id is not null").count() > 0
    state = [f.suffix for f in folder.rglob("state/0/*/*")]
    assert ".delta" not in state and {".zip", ".changelog"} & set(state)


def test_measures_of_batches(spark, tmp_path):
    measures, folder = BatchMeasures(keep=2), str(tmp_path / "raw")
    table = partitioned_at(spark, str(tmp_path / "t"), null_key="drop")
    spark.streams.addListener(measures)
    try:
        for minute in (0, 10, 20):
            arrivals(spark, folder, [reading(when=at(minutes=minute)), reading(patient="P0002", when=at(minutes=minute))])
            start_partitioned(
                stream_of(spark, folder), table, str(tmp_path / "c"), lateness="1 hour", trigger=UNTIL_DONE, at=AT()
            ).awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(measures)
    rows = sorted(measures.table(spark).collect(), key=lambda r: r.batch_id)
    assert [(r.n_input, r.n_rows) for r in rows] == [(2, 2), (2, 2)]
    assert all(r.rows_per_second > 0 and r.avg_union_latency == r.max_union_latency for r in rows)
    assert all(r.max_overall_latency >= r.avg_overall_latency > 0 for r in rows)
    assert table.read().count() == 6


def test_readings_without_patient_stop_the_sums(spark, tmp_path):
    table = sums_at(spark, str(tmp_path))
    with pytest.raises(Exception, match="full key"):
        added(spark, table, [reading(device_id="nobody")], 0, 0)
    assert NOON.year == 2025 and table.read().count() == 0
