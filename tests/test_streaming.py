"""Streams: same result as the batch for any arrival, restarts, late rows, lifetimes."""

import os
import time

import pytest
from pyspark.sql import functions as F

from tests.rows import NOON, as_dicts, at, bag, raw_frame, reading
from wardline.plans.catalog import CATALOG
from wardline.plans.pipeline import fixed_clocks, scored_readings, stored_table
from wardline.plans.readings import raw_readings
from wardline.schemas import RAW_PAYLOAD
from wardline.sources.json_topics import read_json_folder
from wardline.streaming.pipeline import (
    UNTIL_DONE,
    Staged,
    add_to_windows,
    start_fused,
    stored_table_at,
    sums_table_at,
)

AT = fixed_clocks


def write_files(spark, folder, batches):
    """One JSON file per batch of readings, with rising modification times."""
    os.makedirs(folder, exist_ok=True)
    start = len(os.listdir(folder))
    # A file that a running query may list has to be whole and have its time: it is moved in.
    drafts = f"{folder}-drafts"
    os.makedirs(drafts, exist_ok=True)
    for n, readings in enumerate(batches, start):
        lines = raw_frame(spark, readings).toJSON().collect()
        path = os.path.join(drafts, f"{n:04d}.json")
        with open(path, "w") as out:
            out.write("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))
        os.replace(path, os.path.join(folder, f"{n:04d}.json"))


def run_fused(spark, root, late="keep", **options):
    source = read_json_folder(spark, f"{root}/raw", files_per_batch=1)
    table = stored_table_at(spark, f"{root}/table", null_key="drop")
    query = start_fused(
        source, table, f"{root}/checkpoint", late=late, trigger=UNTIL_DONE, at=AT(), **options
    )
    query.awaitTermination()
    return table, query


def some_readings():
    kinds = [("HEART_RATE", "140"), ("TEMPERATURE", "38.5"), ("CONSCIOUSNESS", "0")]
    return [
        reading(k, v, f"P000{p}", at(seconds=20 * s), battery=float(10 * s % 100))
        for p in (1, 2)
        for s in range(12)
        for k, v in kinds
    ]


def batch_result(spark, readings):
    return bag(stored_table(raw_frame(spark, readings), AT()))


@pytest.mark.parametrize("step", [1, 5, 7])
def test_any_order_and_split_gives_the_batch_result(spark, tmp_path, step):
    readings = some_readings()
    shuffled = sorted(readings, key=lambda r: hash((step, r[0], r[3])))
    write_files(spark, str(tmp_path / "raw"), [shuffled[i::4] for i in range(4)])
    table, query = run_fused(spark, str(tmp_path), compact_every=step)
    assert len(query.recentProgress) >= 4
    assert bag(table.latest()) == batch_result(spark, readings)


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    readings = some_readings()
    raw = str(tmp_path / "raw")
    write_files(spark, raw, [readings[0::3], readings[1::3]])
    run_fused(spark, str(tmp_path))
    write_files(spark, raw, [readings[2::3]])
    table, query = run_fused(spark, str(tmp_path))
    assert sum(p.numInputRows for p in query.recentProgress) == len(readings[2::3])
    assert bag(table.latest()) == batch_result(spark, readings)
    table, query = run_fused(spark, str(tmp_path))
    assert sum(p.numInputRows for p in query.recentProgress) == 0
    assert table.compact() > 0
    assert bag(table.latest()) == batch_result(spark, readings)


def test_a_stream_starts_after_the_backlog(spark, tmp_path):
    raw = str(tmp_path / "raw")
    write_files(spark, raw, [[reading(value="1")], [reading(value="2")], [reading(value="3")]])
    source = read_json_folder(spark, raw, start_after="2023-11-14 22:13:21")
    rows = []
    query = (
        source.writeStream.foreachBatch(lambda df, n: rows.extend(df.collect()))
        .option("checkpointLocation", str(tmp_path / "c"))
        .trigger(**UNTIL_DONE)
        .start()
    )
    query.awaitTermination()
    assert [r.raw_value for r in rows] == ["3"]
    assert [f.name for f in source.schema] == [*RAW_PAYLOAD.names, "ingestion_timestamp"]


def test_late_rows_are_kept_or_dropped(spark, tmp_path):
    batches = [
        [reading(value="60", when=at(seconds=5))],
        [reading(value="60", when=at(minutes=30))],
        [reading(value="60", when=at(minutes=31))],
        [reading(value="150", when=at(seconds=10))],  # half an hour late
    ]
    for late, value in (("keep", 150.0), ("drop", 60.0)):
        root = str(tmp_path / late)
        write_files(spark, f"{root}/raw", batches)
        table, query = run_fused(spark, root, late, lateness="10 seconds")
        first = table.latest().filter(F.col("window_start") == NOON).first()
        assert first.heart_rate_value == value
        dropped = sum(
            s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators
        )
        assert dropped == (late == "drop")
    with pytest.raises(ValueError):
        run_fused(spark, root, "maybe")


def test_watermark_bounds_the_state(spark, tmp_path):
    batches = [[reading(when=at(minutes=5 * n))] for n in range(8)]
    write_files(spark, str(tmp_path / "raw"), batches)
    _, query = run_fused(spark, str(tmp_path), "drop", lateness="1 minute")
    kept = [s.numRowsTotal for p in query.recentProgress for s in p.stateOperators]
    assert kept[-1] <= 2


def test_reading_without_patient_stops_the_strict_table(spark, tmp_path):
    write_files(spark, str(tmp_path / "raw"), [[reading(device_id="nobody")]])
    table = stored_table_at(spark, str(tmp_path / "table"))
    source = read_json_folder(spark, str(tmp_path / "raw"))
    query = start_fused(source, table, str(tmp_path / "c"), trigger=UNTIL_DONE, at=AT())
    with pytest.raises(Exception):
        query.awaitTermination()


def test_stages_stamp_their_own_clocks(spark, tmp_path):
    write_files(spark, str(tmp_path / "raw"), [some_readings()])
    staged = Staged(spark, str(tmp_path / "out"), late="keep")
    staged.run_through(read_json_folder(spark, str(tmp_path / "raw")))
    final = staged.stored.latest()
    assert final.count() == len(batch_result(spark, some_readings()))
    order = ["enrichment", "routing", "scoring", "union", "aggregation", "storage"]
    for earlier, later in zip(order, order[1:]):
        wrong = F.col(f"{earlier}_timestamp") > F.col(f"{later}_timestamp")
        assert final.filter(wrong).count() == 0
    assert final.filter("enrichment_timestamp < scoring_timestamp").count() == final.count()
    routed = spark.read.parquet(str(tmp_path / "out" / "routed"))
    assert routed.select("measurement_type").distinct().count() == 3
    scores = staged.scores.latest()
    assert "news2_score" not in scores.columns and scores.count() == final.count()


@pytest.mark.parametrize("file_format", ["json", "parquet"])
def test_staged_equals_batch(spark, tmp_path, file_format):
    readings = some_readings()
    raw = str(tmp_path / "raw")
    write_files(spark, raw, [readings[0::2]])
    staged = Staged(
        spark, str(tmp_path / "out"), late="keep", at=AT(), file_format=file_format
    )
    staged.run_through(read_json_folder(spark, raw))
    write_files(spark, raw, [readings[1::2]])
    staged.run_through(read_json_folder(spark, raw))
    assert bag(staged.stored.latest()) == batch_result(spark, readings)


def test_fused_stream_equals_batch_on_test_tables(spark, sf_dir):
    final = CATALOG["stream_tumble_final"](spark, sf_dir)
    batch = stored_table(raw_readings(spark, sf_dir), AT()).filter("patient_id IS NOT NULL")
    assert bag(final) == bag(batch)
    assert as_dicts(final, "patient_id")[0]["patient_id"].startswith("P")


@pytest.mark.parametrize("late", ["keep", "drop"])
def test_bad_readings_are_written_beside(spark, tmp_path, late):
    readings = [
        reading(value="60"),
        reading(value="n/a"),
        reading(value="NaN"),
        reading(device_id="nobody"),
        reading(when=None),
    ]
    write_files(spark, str(tmp_path / "raw"), [readings])
    bad = str(tmp_path / "bad")
    table, _ = run_fused(spark, str(tmp_path), late, on_bad="quarantine", quarantine=bad)
    for query in spark.streams.active:
        query.awaitTermination()
    problems = sorted(r.problem for r in spark.read.parquet(bad).collect())
    assert problems == ["no measurement time", "no patient", "not a number", "not finite"]
    assert bag(table.latest()) == batch_result(spark, readings[:1])
    with pytest.raises(ValueError):
        run_fused(spark, str(tmp_path), late, on_bad="quarantine")


def test_a_combined_batch_that_comes_again_counts_once(spark, tmp_path):
    table = sums_table_at(spark, str(tmp_path / "sums"), "error", 4)
    scored = scored_readings(raw_frame(spark, some_readings()), AT())
    for batch, writer in ((0, "a"), (0, "a"), (0, "b")):
        changed = add_to_windows(table, scored, batch, writer)
        n = changed.agg(F.sum("heart_rate_n")).first()[0]
        assert n == 24 * (1 if writer == "a" else 2)
        table.compact_if(2 if writer == "a" else 1)
    assert table.latest().agg(F.sum("heart_rate_n")).first()[0] == 48


def test_stages_run_side_by_side(spark, tmp_path):
    readings = some_readings()
    write_files(spark, str(tmp_path / "raw"), [readings[0::2]])
    staged = Staged(
        spark,
        str(tmp_path / "out"),
        late="keep",
        at=AT(),
        trigger={"processingTime": "1 second"},
    )
    queries = staged.start(read_json_folder(spark, str(tmp_path / "raw")))
    try:
        write_files(spark, str(tmp_path / "raw"), [readings[1::2]])
        expected = batch_result(spark, readings)
        deadline = time.time() + 120
        while time.time() < deadline:
            assert all(q.isActive for q in queries), [q.exception() for q in queries]
            if os.path.exists(tmp_path / "out" / "stored" / "_versions"):
                if bag(staged.stored.latest()) == expected:
                    break
            time.sleep(1)
        assert bag(staged.stored.latest()) == expected
    finally:
        for query in queries:
            query.stop()
