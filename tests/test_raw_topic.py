"""The topic of JSON files that streams read, and merges of a table's first and of expired rows."""

import datetime as dt
import glob

from pyspark.sql import functions as F

from wardline.plans import catalog
from wardline.plans.pipeline import fixed_clocks, scored_readings
from wardline.plans.readings import raw_readings, readings_from_events
from wardline.sources.json_topics import read_json_folder
from wardline.sources.partitioned import PartitionedTable
from wardline.streaming import sums
from wardline.streaming.sums import LAST_SEEN, add_sums, sums_at


def _events(spark, path, n):
    rows = spark.range(n).select(F.col("id").alias("event_id"), (F.col("id") % 7).alias("user_id"))
    rows.withColumn("event_id", F.when(F.col("event_id") % 90 != 0, F.col("event_id")).otherwise(3)).write.parquet(f"{path}/events.parquet")


def test_files_of_a_topic_grow_in_number_not_in_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "EVENTS_PER_FILE", 50, raising=False)
    _events(spark, tmp_path, 1000)
    out = catalog.CATALOG["archived_topic"](spark, str(tmp_path))
    topic = max(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/archived-*"), key=lambda p: len(glob.glob(f"{p}/archive/**/part-*", recursive=True)))
    files = glob.glob(f"{topic}/**/part-*.json*", recursive=True)
    assert len(files) == 21  # three batches of seven
    assert max(spark.read.json(f).count() for f in files) <= 6 * 50
    expected = raw_readings(spark, str(tmp_path))
    assert sorted(map(str, out.select(*expected.columns).collect())) == sorted(map(str, expected.collect()))


def test_topic_of_few_events(spark, tmp_path):
    _events(spark, tmp_path, 100)
    assert catalog._raw_topic(spark, str(tmp_path), str(tmp_path / "raw")) == 2
    assert len(glob.glob(str(tmp_path / "raw" / "part-*"))) == 6
    assert read_json_folder(spark, str(tmp_path / "raw"), streaming=False).count() == 600


def test_first_batch_is_not_kept_in_memory(spark, tmp_path, monkeypatch):
    kept, persist = [], type(spark.range(1)).persist
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda df, *a: (kept.append(df), persist(df, *a))[1])
    rows = spark.range(20).select("id", (F.col("id") * 2).alias("x"))
    table = PartitionedTable(spark, str(tmp_path / "t"), rows.schema, ["id"])
    for batch in (0, 1):
        table.writer()(rows.withColumn("x", F.col("x") + batch), batch)
        assert len(kept) == batch
    assert sorted((r.id, r.x) for r in table.read().collect()) == [(n, 2 * n + 1) for n in range(20)]


def test_expired_sums_without_new_readings_are_not_merged_again(spark, tmp_path, monkeypatch):
    events = spark.range(60).select(F.col("id").alias("event_id"), (F.col("id") % 3).alias("user_id"))
    scored = scored_readings(readings_from_events(events), fixed_clocks()).where("patient_id is not null")
    table, noon = sums_at(spark, str(tmp_path / "t"), null_key="drop"), dt.datetime(2024, 3, 1, 12)
    add_sums(table, scored, 0, noon, dt.timedelta(minutes=5))
    before = table.read().collect()
    some = scored.where("measurement_timestamp < timestamp_ntz'2024-01-01 00:02:00'")
    merged, merge = [], sums.merge_sums
    monkeypatch.setattr(sums, "merge_sums", lambda rows, *a: (merged.append(rows.count()), merge(rows, *a))[1])
    add_sums(table, some, 1, noon + dt.timedelta(minutes=20), dt.timedelta(minutes=5))
    after = {(r.patient_id, r.window_start): r for r in table.read().collect()}
    new = {k for k, r in after.items() if r[LAST_SEEN] > noon}
    assert merged == [len(new)] and 0 < len(new) < len(before) == len(after)
    assert all(after[r.patient_id, r.window_start] == r for r in before if (r.patient_id, r.window_start) not in new)
