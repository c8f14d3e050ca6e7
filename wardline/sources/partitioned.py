"""Keyed rows in plain partitioned Parquet: the row with the highest sequence wins, whenever it arrives.

The rows lie in folders ``rows/_day=D/_bucket=B``. A batch merges what it brings with the folders it touches and
replaces these folders whole, by Spark's dynamic partition overwrite. There is no other state: no log, no
version file, nothing to compact.

Spark replaces folders one after the other, so a job that dies in between leaves some of them old, some new and one
perhaps missing. The merged rows are therefore written to ``pending`` first. When the batch comes again, as
it does on a stream that restarts, it takes its rows from there and replaces the same folders again.
One writer at a time; readers should not read while a batch replaces folders.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.operators.latest import DELETED, latest_per_key
from wardline.sources import folders
from wardline.sources.upsert import bucket_of
from wardline.vitals import BUCKETS

_DAY, _BUCKET = "_day", "_bucket"
#: Order of a stream's rows where they have none of their own.
BATCH = "_batch"
#: While rows are combined: whether they come from the batch at hand.
FRESH = "_fresh"


class PartitionedTable:
    """Rows by key. ``schema`` is that of the rows read back; ``order`` names what tells a key's versions apart.

    ``order`` columns that ``schema`` lacks are stored as longs beside the rows. A boolean ``_deleted`` column
    marks rows that remove their key. They are kept, so that an older change that comes later does not revive
    the key, until ``forget_after`` (a number, or a time span if the first order column is a time) below the newest
    change of a batch; without it for ever. A change that comes even later would revive its key.

    ``day_column``, one of the keys, splits the rows by day; ``buckets`` split by the first key. ``null_key`` is
    ``"error"`` or ``"drop"``, for rows without a full key.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        order: Sequence[str] = (BATCH,),
        buckets: int = BUCKETS,
        day_column: str | None = None,
        null_key: str = "error",
        forget_after: int | dt.timedelta | None = None,
    ) -> None:
        if null_key not in ("error", "drop"):
            raise ValueError(f"null_key must be 'error' or 'drop', not {null_key!r}")
        if day_column is not None and day_column not in keys:
            raise ValueError("day_column must be a key column: a key may not change its day")
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.order = list(keys), list(order)
        self.buckets, self.day_column = buckets, day_column
        self.null_key, self.forget_after = null_key, forget_after
        beside = [T.StructField(c, T.LongType()) for c in self.order if c not in schema.names]
        self._stored = T.StructType([*schema.fields, *beside, T.StructField(DELETED, T.BooleanType())])
        self._parts = ([_DAY] if day_column else []) + [_BUCKET]
        self._full = T.StructType(
            [
                *self._stored.fields,
                *(T.StructField(p, T.DateType() if p == _DAY else T.IntegerType()) for p in self._parts),
            ]
        )

    @property
    def rows_path(self) -> str:
        return f"{self.path}/rows"

    # -- writing ---------------------------------------------------------------------------

    def write(
        self,
        rows: DataFrame,
        batch_id: int,
        combine: Callable[[DataFrame], DataFrame] | None = None,
    ) -> None:
        """Merge one batch into the table; batches count upwards, and the last one may come again.

        ``combine`` turns the rows of the touched folders and of the batch, told apart by a boolean column
        ``_fresh``, into one row per key; otherwise the highest order wins.
        """
        pending = f"{self.path}/pending/{batch_id:012d}"
        if not folders.exists(self.spark, f"{pending}/_SUCCESS"):
            fresh = self._placed(rows)
            # looked at for its folders and for its rows, so kept: a stream's batch is to run once
            again = self.forget_after is not None or folders.exists(self.spark, self.rows_path)
            if again:
                fresh = fresh.persist()
            try:
                self._merged(fresh, combine).write.mode("overwrite").parquet(pending)
            finally:
                if again:
                    fresh.unpersist()
        (
            self.spark.read.schema(self._full)
            .parquet(pending)
            .hint("rebalance", *self._parts)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*self._parts)
            .parquet(self.rows_path)
        )
        for name in folders.names(self.spark, f"{self.path}/pending"):
            if name < f"{batch_id:012d}":
                folders.delete(self.spark, f"{self.path}/pending/{name}")

    def writer(
        self, then: Callable[[DataFrame], DataFrame] = lambda rows: rows
    ) -> Callable[[DataFrame, int], None]:
        """For ``foreachBatch``: ``then`` on the batch, and the batch number as order if none is given."""

        def write(rows: DataFrame, batch_id: int) -> None:
            rows = then(rows)
            if BATCH in self.order and BATCH not in rows.columns:
                rows = rows.withColumn(BATCH, F.lit(batch_id).cast("long"))
            self.write(rows, batch_id)

        return write

    def _placed(self, rows: DataFrame) -> DataFrame:
        if DELETED not in rows.columns:
            rows = rows.withColumn(DELETED, F.lit(False))
        lacking = F.lit(False)
        for key in self.keys:
            lacking = lacking | F.col(key).isNull()
        if self.null_key == "drop":
            rows = rows.filter(~lacking)
        else:
            first = self.keys[0]
            stop = F.raise_error(F.lit("a row without a full key")).cast(self.schema[first].dataType)
            rows = rows.withColumn(first, F.when(lacking, stop).otherwise(F.col(first)))
        rows = rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in self._stored))
        if self.day_column:
            rows = rows.withColumn(_DAY, F.col(self.day_column).cast("date"))
        return rows.withColumn(_BUCKET, bucket_of(F.col(self.keys[0]), self.buckets))

    def _merged(self, fresh: DataFrame, combine: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
        both = fresh.withColumn(FRESH, F.lit(True))
        if folders.exists(self.spark, self.rows_path):
            # at most one row for each folder of the table
            touched = F.broadcast(fresh.select(*self._parts).distinct())
            old = self.spark.read.schema(self._full).parquet(self.rows_path)
            old = old.join(touched, self._parts, "left_semi")
            both = both.unionByName(old.withColumn(FRESH, F.lit(False)))
        if combine is not None:
            return self._placed(combine(both.drop(*self._parts))).select(*self._full.names)
        both = both.drop(FRESH)
        whole = F.xxhash64(*(c for c in self._full.names if c not in self._parts))
        merged = latest_per_key(both.withColumn("_whole", whole), self.keys, [*self.order, DELETED, "_whole"])
        if self.forget_after is not None:
            newest = fresh.agg(F.max(self.order[0]).alias("newest")).first()["newest"]
            if newest is not None:
                limit = F.lit(newest - self.forget_after).cast(self._full[self.order[0]].dataType)
                merged = merged.filter(~F.col(DELETED) | (F.col(self.order[0]) >= limit))
        return merged.select(*self._full.names)

    # -- reading ---------------------------------------------------------------------------

    def read(self, key: Any = None, days: tuple[dt.date, dt.date] | None = None) -> DataFrame:
        """The current rows; with the first key only its bucket is read, with days (both included) only those."""
        if not folders.exists(self.spark, self.rows_path):
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self._full).parquet(self.rows_path)
        if key is not None:
            kind = self.schema[self.keys[0]].dataType
            literal = F.lit(key).cast(kind)
            bucket = self.spark.range(1).select(bucket_of(literal, self.buckets)).first()[0]
            rows = rows.filter((F.col(_BUCKET) == bucket) & (F.col(self.keys[0]) == literal))
        if days is not None:
            if not self.day_column:
                raise ValueError("the table is not split by day")
            rows = rows.filter(F.col(_DAY).between(F.lit(days[0]), F.lit(days[1])))
        return rows.filter(~F.col(DELETED)).select(*self.schema.names)

    def retain(self, first_day: dt.date) -> None:
        """Let the folders of all earlier days go, unread."""
        for name in folders.names(self.spark, self.rows_path):
            day = name.removeprefix(f"{_DAY}=")
            if day != name and day < first_day.isoformat():
                folders.delete(self.spark, f"{self.rows_path}/{name}")
