"""Upsert tables, tiered tables, ingest and topics."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.rows import NOON, at, bag, raw_frame, reading
from wardline.operators.latest import DELETED, apply_cdc, latest_per_key
from wardline.operators.lifecycle import tier_split, within_retention
from wardline.schemas import RAW, RAW_PAYLOAD
from wardline.session import shared_dir
from wardline.sources import ingest
from wardline.sources.json_topics import (
    decode_append,
    decode_changes,
    decode_upsert,
    encode_append,
    encode_upsert,
    read_json_folder,
    topic_layout,
)
from wardline.sources.tiered import TieredTable
from wardline.sources.upsert import UpsertTable
from wardline.sources.versions import Versions

SCHEMA = "k string, t timestamp_ntz, v int, _deleted boolean"


def rows(spark, *items):
    return spark.createDataFrame([(*i, False) if len(i) == 3 else i for i in items], SCHEMA)


def content(df):
    return sorted((r.k, r.t, r.v) for r in df.collect())


@pytest.fixture
def table(spark, tmp_path):
    return UpsertTable(spark, str(tmp_path / "t"), ["k", "t"], day_column="t")


# -- upsert --------------------------------------------------------------------------------


def test_last_write_wins_and_replays_do_nothing(spark, table):
    assert table.upsert(rows(spark, ("a", NOON, 1), ("b", NOON, 1)), 0, writer="w")
    assert table.upsert(rows(spark, ("a", NOON, 2)), 1, writer="w")
    assert not table.upsert(rows(spark, ("a", NOON, 99)), 1, writer="w")
    assert not table.upsert(rows(spark, ("a", NOON, 99)), 0, writer="w")
    assert content(table.latest()) == [("a", NOON, 2), ("b", NOON, 1)]


def test_deleted_keys_vanish_and_can_come_back(spark, table):
    table.upsert(rows(spark, ("a", NOON, 1), ("b", NOON, 1)), 0)
    table.compact()
    table.upsert(rows(spark, ("a", NOON, None, True)), 1)
    assert content(table.latest()) == [("b", NOON, 1)]
    table.compact()
    assert content(table.latest()) == [("b", NOON, 1)]
    table.upsert(rows(spark, ("a", NOON, 5)), 2)
    assert content(table.latest()) == [("a", NOON, 5), ("b", NOON, 1)]


def test_compaction_rewrites_only_what_changed(spark, table):
    monday, tuesday = NOON, at(days=1)
    table.upsert(rows(spark, *[(f"k{i}", d, i) for i in range(20) for d in (monday, tuesday)]), 0)
    table.compact()
    before = content(table.latest())
    _, state = Versions(spark, table.path).read()
    assert len({p.split("/")[0] for p in state["base"]}) == 2
    table.upsert(rows(spark, ("k3", tuesday, 333)), 1)
    assert table.compact() == 1
    _, after = Versions(spark, table.path).read()
    assert sum(state["base"][p] != v for p, v in after["base"].items()) == 1
    changed = [r if r[:2] != ("k3", tuesday) else ("k3", tuesday, 333) for r in before]
    assert content(table.latest()) == changed
    assert table.compact() == 0


def test_readers_keep_their_state_while_others_write_and_compact(spark, table):
    table.upsert(rows(spark, ("a", NOON, 1)), 0)
    old = table.latest()
    table.compact()
    between = table.latest()
    table.upsert(rows(spark, ("a", NOON, 2)), 1)
    table.compact()
    assert content(old) == content(between) == [("a", NOON, 1)]
    assert len(table.vacuum()) == 3
    assert table.compact_if(1) == 0
    assert content(table.latest()) == [("a", NOON, 2)]


def test_folders_without_a_commit_do_not_count(spark, table):
    table.upsert(rows(spark, ("a", NOON, 1)), 0)
    # A writer that died after its files and before its commit, then tried again.
    rows(spark, ("z", NOON, 9)).write.parquet(f"{table.path}/changes/_batch={1:012d}")
    assert content(table.latest()) == [("a", NOON, 1)]
    table.upsert(rows(spark, ("b", NOON, 2)), 1)
    assert content(table.latest()) == [("a", NOON, 1), ("b", NOON, 2)]


def test_of_two_writers_one_fails(spark, tmp_path):
    versions = Versions(spark, str(tmp_path / "v"))
    assert versions.read() == (-1, {})
    assert versions.commit(-1, {"n": 1}) == 0
    with pytest.raises(Exception):
        versions.commit(-1, {"n": 2})
    assert versions.read() == (0, {"n": 1})
    for n in range(12):
        versions.commit(n, {"n": n})
    versions.prune(3)
    assert versions.numbers() == [10, 11, 12]


def test_missing_keys(spark, tmp_path):
    bad = rows(spark, (None, NOON, 1), ("a", NOON, 1))
    strict = UpsertTable(spark, str(tmp_path / "strict"), ["k", "t"])
    with pytest.raises(Exception, match="NULL in key column k"):
        strict.upsert(bad, 0)
    with pytest.raises(FileNotFoundError):
        strict.latest()
    loose = UpsertTable(spark, str(tmp_path / "loose"), ["k", "t"], null_key="drop")
    loose.upsert(bad, 0)
    assert content(loose.latest()) == [("a", NOON, 1)]
    with pytest.raises(ValueError):
        UpsertTable(spark, "x", ["k"], null_key="keep")
    with pytest.raises(ValueError):
        UpsertTable(spark, "x", ["k"], day_column="t")


def test_one_key_reads_one_bucket(spark, table):
    table.upsert(rows(spark, *[(f"k{i}", NOON, i) for i in range(40)]), 0)
    table.compact()
    table.upsert(rows(spark, ("k7", at(minutes=1), 70)), 1)
    one = table.latest("k7")
    assert content(one) == [("k7", NOON, 7), ("k7", at(minutes=1), 70)]
    _, state = Versions(spark, table.path).read()
    assert len(state["base"]) == 4
    read = {f for f in one.inputFiles() if "/base/" in f}
    assert len({f.rsplit("_bucket=", 1)[1].split("/")[0] for f in read}) == 1


def test_days_read_only_their_folders(spark, table):
    days = [at(days=-d) for d in range(4)]
    table.upsert(rows(spark, *((k, t, 1) for k in "abcd" for t in days)), 0)
    table.compact()
    table.upsert(rows(spark, ("a", days[1], 2), ("e", days[3], 2)), 1)
    wanted = (days[2].date(), days[1].date())
    some = table.latest(days=wanted)
    parts = {f.split("_day=")[1].split("/")[0] for f in some.inputFiles() if "_day=" in f}
    assert parts == {d.isoformat() for d in wanted}
    expected = [(k, t, 2 if (k, t) == ("a", days[1]) else 1) for k in "abcd" for t in (days[2], days[1])]
    assert content(some) == sorted(expected)
    assert content(table.latest("a", days=wanted)) == [("a", days[2], 1), ("a", days[1], 2)]
    assert content(table.latest("e", days=wanted)) == []


def test_old_days_are_let_go(spark, table):
    days = [at(days=-d) for d in range(4)]
    table.upsert(rows(spark, *(("a", t, 1) for t in days)), 0)
    assert table.retain(days[1].date()) == 2
    assert content(table.latest()) == [("a", days[1], 1), ("a", days[0], 1)]
    assert table.retain(days[1].date()) == 0
    table.upsert(rows(spark, ("a", days[3], 2)), 1)  # late, until the next time
    assert table.retain(days[1].date()) == 1
    table.vacuum()
    assert content(table.latest()) == [("a", days[1], 1), ("a", days[0], 1)]
    by_key = UpsertTable(spark, table.path + "2", ["k"])
    for call in (lambda: by_key.retain(days[0].date()), lambda: by_key.latest(days=(NOON.date(), NOON.date()))):
        with pytest.raises((ValueError, FileNotFoundError)):
            call()


def test_many_versions_of_one_key(spark):
    n = 50_000
    log = spark.range(n, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(
            F.concat(F.lit("k"), F.col("id") % 100)
        ).alias("k"),
        F.col("id").alias("v"),
    )
    last = {r.k: r.v for r in latest_per_key(log, ["k"], ["v"]).collect()}
    assert last["hot"] == n - 1 - (n - 1) % 3
    assert len(last) == 101
    text = latest_per_key(log, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in text and "Window" not in text


def test_cdc(spark):
    row = T.StructType().add("id", "integer").add("name", "string")
    schema = T.StructType().add("op", "string").add("before", row).add("after", row).add("n", "integer")
    changes = [
        ("r", None, (1, "a"), 1), ("r", None, (2, "b"), 2), ("u", (1, "a"), (1, "A"), 3),
        ("d", (2, "b"), None, 4), ("c", None, (3, "c"), 5), ("d", (3, "c"), None, 6),
        ("c", None, (3, "again"), 7),
    ]
    df = apply_cdc(spark.createDataFrame(changes, schema).orderBy(F.rand(1)), ["id"], ["n"])
    assert sorted(map(tuple, df.collect())) == [(1, "A"), (3, "again")]


# -- tiers ---------------------------------------------------------------------------------


def test_hot_and_cold_together_never_change(spark, tmp_path):
    table = TieredTable(spark, str(tmp_path / "hot"), str(tmp_path / "cold"), "t")
    schema = "t timestamp_ntz, v int"
    first = [(at(hours=h), h) for h in range(10)] + [(None, -1)]
    table.append(spark.createDataFrame(first, schema))
    table.append(spark.createDataFrame([(at(hours=20), 20)], schema))
    whole = bag(table.read())
    assert table.tier(at(hours=5)) == 1
    assert bag(table.read()) == whole
    assert sorted(r.v for r in table.cold().collect()) == [0, 1, 2, 3, 4]
    # A late row for an old time is hot until the next move.
    table.append(spark.createDataFrame([(at(hours=1), 100)], schema))
    assert table.hot().filter("v = 100").count() == 1
    table.tier(at(hours=5))
    assert table.cold().filter("v = 100").count() == 1
    assert table.tier(at(hours=5)) == 0
    table.tier(at(hours=30))
    assert [r.v for r in table.hot().collect()] == [-1]
    table.purge(at(hours=4))
    assert sorted(r.v for r in table.read().collect()) == [-1, 4, 5, 6, 7, 8, 9, 20]
    assert table.purge(at(hours=4)) == 0
    table.vacuum()
    assert table.read().count() == 8


def test_moves_of_a_table_that_is_not_there(spark, tmp_path):
    table = TieredTable(spark, str(tmp_path / "hot"), str(tmp_path / "cold"), "t")
    assert table.tier(NOON) == 0
    assert table.purge(NOON) == 0


def test_of_two_appends_at_a_time_the_loser_touches_nothing(spark, tmp_path):
    table = TieredTable(spark, str(tmp_path / "hot"), str(tmp_path / "cold"), "t")
    one = spark.createDataFrame([(NOON, 1)], "t timestamp_ntz, v int")
    table.append(one)
    stale = table._versions.read()
    table.append(one)
    table._versions.read = lambda: stale
    with pytest.raises(Exception):
        table.append(one.withColumn("v", F.lit(9)))
    again = TieredTable(spark, str(tmp_path / "hot"), str(tmp_path / "cold"), "t")
    assert [r.v for r in again.read().collect()] == [1, 1]


def test_retention_and_split(spark):
    df = spark.createDataFrame([(at(days=-d), d) for d in (0, 6, 7, 8)], "t timestamp_ntz, d int")
    assert sorted(r.d for r in within_retention(df, "t").collect()) == [0, 6, 7]
    assert sorted(r.d for r in within_retention(df, "t", 1, at(days=-6)).collect()) == [0, 6, 7]
    hot, cold = tier_split(df, "t")
    assert [r.d for r in hot.collect()] == [0]
    assert cold.count() == 3
    empty = df.limit(0)
    assert within_retention(empty, "t").count() == 0


# -- ingest --------------------------------------------------------------------------------


def test_incremental_copy(spark, tmp_path):
    target = str(tmp_path / "copy")
    source = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert ingest.incremental_copy(source.limit(0), "k", target) is None
    assert ingest.incremental_copy(source.filter("k < 40"), "k", target) == 39
    assert ingest.incremental_copy(source, "k", target) == 99
    assert ingest.incremental_copy(source, "k", target) == 99
    assert bag(ingest.read_copy(spark, target)) == bag(source)
    marks = ingest.copy_tables({"a": source}, {"a": "k"}, str(tmp_path), "jdbc-")
    assert marks == {"a": 99}
    assert ingest.read_copy(spark, str(tmp_path / "jdbc-a")).count() == 100


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz", "decimal(12,2)", "string"])
def test_incremental_copy_by_other_ids(spark, tmp_path, kind):
    day = F.date_add(F.lit("2024-01-01"), F.col("id").cast("int"))
    source = spark.range(90).select((F.col("id") / 4 if kind[:3] == "dec" else day).cast(kind).alias("k"))
    target = str(tmp_path / "copy")
    top = source.agg(F.max("k")).first()[0]
    assert ingest.incremental_copy(source.limit(50), "k", target) < top
    assert ingest.incremental_copy(source, "k", target) == top
    assert ingest.incremental_copy(source, "k", target) == top
    assert bag(ingest.read_copy(spark, target)) == bag(source)
    assert len([p for p in (tmp_path / "copy").iterdir() if p.name.startswith("_run=")]) == 2


def test_incremental_copy_filters_in_the_source(spark, tmp_path):
    source = str(tmp_path / "source")
    spark.range(100).write.parquet(source)
    target = str(tmp_path / "copy")
    ingest.incremental_copy(spark.read.parquet(source).filter("id < 50"), "id", target)
    ingest.incremental_copy(spark.read.parquet(source), "id", target)
    assert ingest.read_copy(spark, target).distinct().count() == 100


def test_mock_records(spark):
    rules = {
        "n": ingest.Counting(10, 5),
        "user": ingest.Numbered("User_", 1, 9),
        "kind": ingest.Choice(("x", "y")),
        "v": ingest.Between(0, 9, 10),
    }
    df = ingest.mock_readings(spark, 500, rules, seed=3)
    got = df.collect()
    assert [r.n for r in got] == [10 + 5 * i for i in range(500)]
    assert {r.user for r in got} == {f"User_{i}" for i in range(1, 10)}
    assert {r.kind for r in got} == {"x", "y"}
    assert {r.v for r in got} == {i / 10 for i in range(10)}
    assert ingest.mock_readings(spark, 500, rules, seed=3).collect() == got
    assert ingest.mock_readings(spark, 500, rules, seed=4).collect() != got
    assert spark.range(2**40, 2**40 + 3).transform(
        lambda d: ingest.mock_records(d, "id", rules)
    ).count() == 3


# -- topics --------------------------------------------------------------------------------


def frame(spark, payload, when=NOON):
    value = payload if isinstance(payload, str) else json.dumps(payload)
    return spark.createDataFrame([(None, value.encode(), when)], "key binary, value binary, timestamp timestamp")


def test_raw_messages_are_read_as_sent(spark):
    payload = {
        "measurement_timestamp": "2025-03-16T21:00:00.123", "measurement_type": "HEART_RATE",
        "raw_value": 98.5, "device_id": "MEDICAL_P0011", "battery": 80, "signal_strength": None,
        "unknown_field": 1,
    }
    row = decode_append(frame(spark, payload), RAW, "ingestion_timestamp").first()
    assert row.measurement_timestamp == dt.datetime(2025, 3, 16, 21, 0, 0, 123000)
    assert (row.raw_value, row.battery, row.signal_strength) == ("98.5", 80.0, None)
    assert row.ingestion_timestamp == NOON


@pytest.mark.parametrize(
    "text",
    [
        "2025-03-16T21:00:00.123", "2025-03-16T21:00:00.123Z", "2025-03-16T21:00:00.123456",
        "2025-03-16 21:00:00.123", "2025-03-16T22:00:00.123+01:00",
    ],
)
def test_any_form_of_time(spark, text):
    df = decode_append(frame(spark, {"measurement_timestamp": text}), RAW, "ingestion_timestamp")
    assert df.first().measurement_timestamp == dt.datetime(2025, 3, 16, 21, 0, 0, 123000)


def test_broken_json(spark):
    broken = frame(spark, '{"raw_value": ')
    with pytest.raises(Exception):
        decode_append(broken, RAW, "ingestion_timestamp").collect()
    row = decode_append(broken, RAW, "ingestion_timestamp", on_bad="null").first()
    assert row.raw_value is None and row.ingestion_timestamp == NOON


def test_append_frames_on_the_wire(spark):
    df = raw_frame(spark, [reading(battery=None)])
    sent = encode_append(df, RAW, "ingestion_timestamp").first()
    assert sent.key is None
    assert json.loads(bytes(sent.value)) == {
        "measurement_timestamp": "2025-03-16T12:00:00.000", "measurement_type": "HEART_RATE",
        "raw_value": "70", "device_id": "MEDICAL_heart_rate_P0001", "battery": None,
        "signal_strength": 0.9,
    }


def test_keyed_frames_on_the_wire(spark):
    df = rows(spark, ("a", NOON, 1), ("a", NOON, None, True), ("b", NOON, 2), ("b", NOON, 3))
    df = df.withColumn("n", F.monotonically_increasing_id())
    frames = encode_upsert(df, ["k", "t"], "n")
    sent = sorted(frames.collect(), key=lambda r: r.offset)
    assert json.loads(bytes(sent[0].key)) == {"k": "a", "t": "2025-03-16 12:00:00.000"}
    assert json.loads(bytes(sent[0].value)) == {"k": "a", "t": "2025-03-16 12:00:00.000", "v": 1}
    assert sent[1].value is None
    schema = T.StructType([f for f in df.schema if f.name not in (DELETED, "n")])
    assert content(decode_upsert(frames, schema)) == [("b", NOON, 3)]


def test_keyed_frames_as_changes(spark, table):
    df = rows(spark, ("a", NOON, 1), ("a", NOON, None, True), ("b", NOON, 2), ("b", NOON, 3))
    frames = encode_upsert(df.withColumn("n", F.monotonically_increasing_id()), ["k", "t"], "n")
    schema = T.StructType([f for f in df.schema if f.name != DELETED])
    changes = decode_changes(frames, ["k", "t"], schema)
    assert [(r.k, r.t, r.v, r[DELETED]) for r in changes.filter("k = 'a'").orderBy("offset").collect()] == [
        ("a", NOON, 1, False), ("a", NOON, None, True)
    ]
    table.upsert(changes, 0, ["offset"])
    assert content(table.latest()) == [("b", NOON, 3)]


def test_folder_of_json(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "1.json").write_text(
        '{"measurement_timestamp": "2025-03-16T12:00:00.5Z", "raw_value": 1, "device_id": "d"}\n'
    )
    df = read_json_folder(spark, str(folder), streaming=False)
    row = df.first()
    assert row.measurement_timestamp.microsecond == 500000
    assert row.raw_value == "1"
    # No record time in the row: the file's.
    age = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - row.ingestion_timestamp
    assert dt.timedelta() <= age < dt.timedelta(minutes=5)
    assert [f.name for f in df.schema] == [*RAW_PAYLOAD.names, "ingestion_timestamp"]
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=1)
    assert read_json_folder(spark, str(folder), start_after=str(later), streaming=False).count() == 0


def test_layout(spark):
    assert topic_layout(spark.range(30)).rdd.getNumPartitions() == 3


def test_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(f"{root}/x-")
    assert shared_dir(spark, "x") != shared_dir(spark, "x")


def test_another_writer_counts_for_itself(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path / "t"), ["k"], buckets=8)
    make = lambda *ids: spark.createDataFrame([(i, i) for i in ids], "k long, v long")
    assert table.upsert(make(1, 2), 7, writer="old checkpoint")
    assert table.upsert(make(3), 0, writer="new checkpoint")
    table.upsert(make(4), 0)
    with pytest.raises(ValueError, match="written before"):
        table.upsert(make(5), 0)
    assert sorted(r.k for r in table.latest().collect()) == [1, 2, 3, 4]


def test_look_up_by_number_in_a_reopened_table(spark, tmp_path):
    path = str(tmp_path / "t")
    table = UpsertTable(spark, path, ["k"], buckets=8)
    table.upsert(spark.range(40).selectExpr("id as k", "id * 2 as v"), 0)
    table.compact()
    again = UpsertTable(spark, path, ["k"], buckets=8)
    assert [again.latest(i).first().v for i in range(40)] == [2 * i for i in range(40)]
    with pytest.raises(ValueError, match="laid out"):
        UpsertTable(spark, path, ["k"]).latest()


def test_a_key_that_repeats_needs_an_order(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path / "t"), ["k"])
    twice = spark.createDataFrame([(1, 1), (1, 2)], "k long, v long")
    with pytest.raises(ValueError, match="repeats"):
        table.upsert(twice, 0)
    table.upsert(twice, 0, ["v"])
    assert table.latest().collect() == [(1, 2)]


def test_a_batch_without_a_column_keeps_it(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path / "t"), ["k"])
    table.upsert(spark.createDataFrame([(1, "a")], "k long, v string"), 0)
    table.upsert(spark.createDataFrame([(2, 5)], "k long, n long"), 1)
    assert sorted(table.latest().collect()) == [(1, "a", None), (2, None, 5)]
