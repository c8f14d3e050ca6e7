"""Keyed rows in partitioned folders: order across batches, replays, deletions, pruning."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.sources import folders
from wardline.sources.partitioned import PartitionedTable
from tests.rows import bag

SCHEMA = T.StructType(
    [T.StructField("k", T.LongType()), T.StructField("at", T.TimestampNTZType()), T.StructField("v", T.StringType())]
)
DAY = dt.datetime(2025, 1, 1)
CHANGE = "k long, at timestamp_ntz, v string, seq long, _deleted boolean"


def table(spark, tmp_path, **other):
    other = {"keys": ["k"], "order": ["seq"], **other}
    return PartitionedTable(spark, str(tmp_path / "t"), SCHEMA, **other)


def changes(spark, *rows):
    return spark.createDataFrame([(k, DAY + dt.timedelta(days=d), v, seq, gone) for k, d, v, seq, gone in rows], CHANGE)


def values(df):
    return sorted((r.k, r.v) for r in df.collect())


def test_a_later_batch_with_an_older_sequence_changes_nothing(spark, tmp_path):
    t = table(spark, tmp_path)
    t.write(changes(spark, (1, 0, "ten", 10, False), (2, 0, "a", 1, False)), 0)
    t.write(changes(spark, (1, 0, "five", 5, False), (2, 0, None, 4, True), (3, 0, "c", 2, False)), 1)
    t.write(changes(spark, (2, 0, "revived?", 3, False), (1, 0, "six", 6, True)), 2)
    assert values(t.read()) == [(1, "ten"), (3, "c")]
    t.write(changes(spark, (2, 0, "b", 9, False)), 3)
    assert values(t.read()) == [(1, "ten"), (2, "b"), (3, "c")]
    assert t.read().columns == SCHEMA.names


def test_several_versions_and_repeated_rows_in_one_batch(spark, tmp_path):
    t = table(spark, tmp_path)
    t.write(changes(spark, (1, 0, "a", 1, False), (1, 0, "c", 3, False), (1, 0, "c", 3, False), (1, 0, "b", 2, False)), 0)
    assert values(t.read()) == [(1, "c")]


def test_deletions_are_forgotten_after_a_while(spark, tmp_path):
    t = table(spark, tmp_path, buckets=1, forget_after=10)
    t.write(changes(spark, (1, 0, None, 5, True), (2, 0, "b", 5, False)), 0)
    stored = spark.read.parquet(t.rows_path)
    assert stored.count() == 2
    t.write(changes(spark, (3, 0, "c", 15, False)), 1)
    assert spark.read.parquet(t.rows_path).filter("_deleted").count() == 1  # exactly the limit: kept
    t.write(changes(spark, (3, 0, "d", 16, False)), 2)
    assert spark.read.parquet(t.rows_path).filter("_deleted").count() == 0
    assert values(t.read()) == [(2, "b"), (3, "d")]


def test_a_time_as_order_with_a_span(spark, tmp_path):
    t = table(spark, tmp_path, order=["at"], buckets=1, forget_after=dt.timedelta(days=1))
    t.write(changes(spark, (1, 0, None, 0, True)), 0)
    t.write(changes(spark, (2, 3, "b", 0, False)), 1)
    assert spark.read.parquet(t.rows_path).count() == 1


def test_a_batch_that_died_half_way_comes_again(spark, tmp_path):
    t = table(spark, tmp_path, keys=["k", "at"], buckets=2, day_column="at")
    first = changes(spark, *((k, k % 3, "old", 1, False) for k in range(12)))
    second = changes(spark, *((k, k % 3, "new", 2, False) for k in range(0, 12, 2)))
    t.write(first, 0)
    t.write(second, 1)
    expected = bag(t.read())
    gone = f"{t.rows_path}/{folders.names(spark, t.rows_path)[0]}"
    folders.delete(spark, gone)
    assert bag(t.read()) != expected
    t.write(second, 1)
    assert bag(t.read()) == expected and t.read().count() == 12
    assert folders.names(spark, f"{t.path}/pending") == ["000000000001"]


def test_an_unfinished_pending_folder_is_written_anew(spark, tmp_path):
    t = table(spark, tmp_path)
    t.write(changes(spark, (1, 0, "a", 1, False)), 0)
    t._merged(t._placed(changes(spark, (9, 0, "half", 2, False))), None).write.parquet(f"{t.path}/pending/{1:012d}")
    folders.delete(spark, f"{t.path}/pending/{1:012d}/_SUCCESS")
    t.write(changes(spark, (2, 0, "b", 2, False)), 1)
    assert values(t.read()) == [(1, "a"), (2, "b")]


def test_only_touched_folders_are_replaced(spark, tmp_path):
    t = table(spark, tmp_path, keys=["k", "at"], buckets=1, day_column="at")
    t.write(changes(spark, (1, 0, "a", 1, False), (2, 1, "b", 1, False)), 0)
    files = lambda: {p.name for p in (tmp_path / "t/rows/_day=2025-01-01").rglob("*.parquet")}
    before = files()
    t.write(changes(spark, (3, 1, "c", 2, False)), 1)
    assert files() == before and values(t.read()) == [(1, "a"), (2, "b"), (3, "c")]


def test_keys_that_are_null(spark, tmp_path):
    rows = changes(spark, (1, 0, "a", 1, False)).union(spark.sql("SELECT null, null, 'x', 1L, false"))
    with pytest.raises(Exception, match="full key"):
        table(spark, tmp_path / "a").write(rows, 0)
    t = table(spark, tmp_path / "b", null_key="drop")
    t.write(rows, 0)
    assert values(t.read()) == [(1, "a")]


def test_combined_rows(spark, tmp_path):
    t = table(spark, tmp_path)
    longest = lambda rows: rows.groupBy("k").agg(
        F.max("at").alias("at"), F.max_by("v", F.length("v")).alias("v"), F.max("seq").alias("seq")
    )
    t.write(changes(spark, (1, 0, "aaaa", 1, False), (2, 0, "b", 1, False)), 0, longest)
    t.write(changes(spark, (1, 0, "cc", 2, False), (2, 0, "bb", 2, False)), 1, longest)
    assert values(t.read()) == [(1, "aaaa"), (2, "bb")]


def test_reading_prunes_folders_and_nothing_is_there_at_first(spark, tmp_path):
    t = table(spark, tmp_path, keys=["k", "at"], day_column="at")
    assert t.read().count() == 0 and t.read().columns == SCHEMA.names
    t.write(changes(spark, *((k, k % 4, "v", 1, False) for k in range(40))).limit(0), 0)
    assert t.read().count() == 0
    t.write(changes(spark, *((k, k % 4, "v", 1, False) for k in range(40))), 1)
    one = t.read(7)
    assert values(one) == [(7, "v")]
    plan = one._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan
    two = t.read(days=(dt.date(2025, 1, 2), dt.date(2025, 1, 3)))
    assert {r.at.day for r in two.collect()} == {2, 3}
    assert "_day" in two._jdf.queryExecution().toString().split("PartitionFilters")[1][:60]
    t.retain(dt.date(2025, 1, 4))
    assert {r.at.day for r in t.read().collect()} == {4}
    with pytest.raises(ValueError):
        table(spark, tmp_path).read(days=(dt.date(2025, 1, 2), dt.date(2025, 1, 3)))
    with pytest.raises(ValueError):
        table(spark, tmp_path, day_column="at")
