"""A stored table with a unique key: change log, merged view, compaction.

Layout below ``path``::

    changes/_run=R/_batch=N/               the rows of the N-th batch of the table
    base/_version=R/_day=D/_bucket=B/      merged rows, one folder R per compaction
    _versions/                             which of these count (see ``versions``)

R is random, so that a writer which loses the race for a commit has touched nothing of the winner's.

Writers only add folders, so readers of an older state are never disturbed until ``vacuum``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.operators.latest import DELETED, latest_per_key
from wardline.sources.versions import Versions
from wardline.vitals import BUCKETS

_BATCH = "_batch"
# Folder columns; the leading underscore keeps them apart from the columns of the rows.
_RUN, _VERSION, _DAY, _BUCKET = "_run", "_version", "_day", "_bucket"


def bucket_of(column: Column, buckets: int = BUCKETS) -> Column:
    """The hash bucket of a key."""
    return F.pmod(F.hash(column), F.lit(buckets))


class UpsertTable:
    """Rows by key, last write wins.

    ``day_column``, one of the keys, splits the merged rows by date as well, so that compaction rewrites only
    the days that changed, ``retain`` drops whole folders and ``latest`` reads only the days asked for. ``null_key`` says what happens
    to a row without a full key: ``"error"`` stops the write, ``"drop"`` leaves the row out.

    Keys, buckets and day column are stored with the first batch; opening the table with others raises.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        buckets: int = BUCKETS,
        day_column: str | None = None,
        null_key: str = "error",
    ) -> None:
        if null_key not in ("error", "drop"):
            raise ValueError(f"null_key must be 'error' or 'drop', not {null_key!r}")
        if day_column is not None and day_column not in keys:
            raise ValueError("day_column must be a key column: a key may not change its day")
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.buckets, self.day_column, self.null_key = buckets, day_column, null_key
        self._versions = Versions(spark, self.path)

    # -- writing ---------------------------------------------------------------------------

    def upsert(
        self,
        rows: DataFrame,
        batch_id: int,
        order: Sequence[str] = (),
        writer: str | None = None,
        combine: Callable[[DataFrame], DataFrame] | None = None,
    ) -> bool:
        """Write one batch; False if this writer committed it before (a replay).

        Batch numbers count per ``writer``: a stream's checkpoint, say. Without a writer a number that was
        used before raises, as nothing tells a replay from new rows. A boolean ``_deleted`` column marks
        rows that remove their key. ``order`` names the columns that tell which of several rows of
        one key in the batch is the last; without it a key that repeats stops the write.

        ``combine`` turns several rows of a key into one. Then new rows do not replace those of their keys
        but are combined with them; of the table only the folders that can hold these keys are read, and
        if another writer commits in between, the commit fails as any other.
        """
        version, state = self._read()
        name = writer or ""
        if batch_id <= state.get("writers", {}).get(name, -1):
            if writer is None:
                raise ValueError(f"batch {batch_id} was written before; name the writer if it is a replay")
            return False
        if combine is not None:
            if DELETED in rows.columns or order:
                raise ValueError("rows to combine are neither deletions nor ordered")
            fresh = self._checked(rows).persist()
            try:
                rows = combine(self._same_keys(state, fresh).unionByName(fresh, allowMissingColumns=True))
                return self._write(version, state, rows.withColumn(DELETED, F.lit(False)), batch_id, name, False)
            finally:
                fresh.unpersist()
        if DELETED not in rows.columns:
            rows = rows.withColumn(DELETED, F.lit(False))
        rows = self._checked(rows)
        if order:
            rows = latest_per_key(rows, self.keys, order)
        return self._write(version, state, rows, batch_id, name, not order)

    def _write(
        self, version: int, state: dict[str, Any], rows: DataFrame, batch_id: int, name: str, check: bool
    ) -> bool:
        place, run = state.get("next", 0), uuid.uuid4().hex
        target = f"{self.path}/changes/{_RUN}={run}"
        rows.write.parquet(f"{target}/{_BATCH}={place:012d}")
        if check:
            self._refuse_repeats(f"{target}/{_BATCH}={place:012d}")
        entry = {"run": run, "place": place, "writer": name, "batch": batch_id}
        self._versions.commit(
            version,
            {
                **state,
                "base": state.get("base", {}),
                "batches": [*state.get("batches", []), entry],
                "next": place + 1,
                "writers": {**state.get("writers", {}), name: batch_id},
                "layout": self._layout(),
                "schema": self._widened(state, rows.drop(DELETED).schema).jsonValue(),
            },
        )
        return True

    def _layout(self) -> dict[str, Any]:
        return {"keys": self.keys, "buckets": self.buckets, "day_column": self.day_column}

    def _read(self) -> tuple[int, dict[str, Any]]:
        version, state = self._versions.read()
        if state and state["layout"] != self._layout():
            raise ValueError(f"the table is laid out by {state['layout']}, not {self._layout()}")
        return version, state

    def _refuse_repeats(self, folder: str) -> None:
        again = self.spark.read.parquet(folder).groupBy(*self.keys).count().filter("count > 1")
        if again.limit(1).count():
            self._versions.delete(folder.rsplit("/", 1)[0])
            raise ValueError("a key repeats in the batch: name the columns that order its rows")

    @staticmethod
    def _widened(state: dict[str, Any], new: T.StructType) -> T.StructType:
        """The columns so far, then new ones: a batch without a column leaves it null in its rows."""
        old = T.StructType.fromJson(state["schema"]) if state else T.StructType()
        kinds = {f.name: f.dataType for f in old}
        for f in new:
            if f.name in kinds and kinds[f.name] != f.dataType:
                raise ValueError(f"column {f.name} is {kinds[f.name].simpleString()}, not {f.dataType.simpleString()}")
        extra = [T.StructField(f.name, f.dataType) for f in new if f.name not in kinds]
        return T.StructType([*(T.StructField(f.name, f.dataType) for f in old), *extra])

    def writer(self, order: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` function; creates the table with the first batch."""

        def write(rows: DataFrame, batch_id: int) -> None:
            self.upsert(rows, batch_id, order, writer_of(rows))

        return write

    def _checked(self, rows: DataFrame) -> DataFrame:
        if self.null_key == "drop":
            return rows.dropna(subset=self.keys)
        for key in self.keys:
            problem = F.raise_error(F.lit(f"NULL in key column {key}"))
            rows = rows.withColumn(
                key, F.coalesce(F.col(key), problem.cast(rows.schema[key].dataType))
            )
        return rows

    # -- reading ---------------------------------------------------------------------------

    def _schema(self, state: dict[str, Any]) -> T.StructType:
        if not state:
            raise FileNotFoundError(f"no table at {self.path}")
        return T.StructType.fromJson(state["schema"])

    def _changes(self, state: dict[str, Any]) -> DataFrame:
        """All rows written since the last compaction, with the batch that wrote them."""
        schema = self._schema(state)
        stored = T.StructType([*schema.fields, T.StructField(DELETED, T.BooleanType())])
        if not state["batches"]:
            return self.spark.createDataFrame([], stored).withColumn(
                _BATCH, F.lit(0).cast("bigint")
            )
        folders = [T.StructField(_RUN, T.StringType()), T.StructField(_BATCH, T.LongType())]
        layout = T.StructType([*stored.fields, *folders])
        paths = [
            f"{self.path}/changes/{_RUN}={b['run']}/{_BATCH}={b['place']:012d}" for b in state["batches"]
        ]
        reader = self.spark.read.schema(layout).option("basePath", f"{self.path}/changes")
        return reader.parquet(*paths).drop(_RUN)

    def _base(
        self, state: dict[str, Any], parts: Sequence[str] | None = None
    ) -> DataFrame | None:
        """Merged rows, of the named folders only if any are named; None if there are none."""
        layout = T.StructType(
            [
                *self._schema(state).fields,
                T.StructField(_VERSION, T.StringType()),
                T.StructField(_DAY, T.DateType()),
                T.StructField(_BUCKET, T.IntegerType()),
            ]
        )
        wanted = state["base"] if parts is None else {
            p: state["base"][p] for p in parts if p in state["base"]
        }
        if not wanted:
            return None
        reader = self.spark.read.schema(layout).option("basePath", f"{self.path}/base")
        return reader.parquet(*(f"{self.path}/base/_version={v}/{p}" for p, v in wanted.items()))

    def changelog(self) -> DataFrame:
        """Rows written since the last compaction, each with ``_batch`` and ``_deleted``."""
        return self._changes(self._read()[1])

    def batch(self, batch_id: int, writer: str | None = None) -> DataFrame:
        """The rows of a writer's committed batch that is not compacted yet, deletions left out."""
        _, state = self._read()
        same = [b for b in state["batches"] if (b["writer"], b["batch"]) == (writer or "", batch_id)]
        rows = self._changes({**state, "batches": same})
        return rows.filter(~F.col(DELETED)).drop(DELETED, _BATCH)

    def latest(self, first_key: Any = None, days: tuple[dt.date, dt.date] | None = None) -> DataFrame:
        """The table as of now; with a value for the first key, only its bucket is read.

        ``days``, the first and the last one wanted, leaves out the folders of all others.
        Only the keys of recent changes take part in the merge: the base is unique already,
        so it needs no aggregation, and Spark broadcasts the changed keys if they are small.
        """
        _, state = self._read()
        recent = self._changes(state)
        parts = list(state.get("base", {}))
        wanted = F.lit(True)
        if first_key is not None:
            parts = self._in_bucket(state, parts, first_key)
            wanted = wanted & (F.col(self.keys[0]) == first_key)
        if days is not None:
            if self.day_column is None:
                raise ValueError("the table is not laid out by day")
            first, last = (d.isoformat() for d in days)
            parts = [p for p in parts if first <= _day_of(p) <= last]
            wanted = wanted & F.to_date(self.day_column).between(*map(F.lit, days))
        base = self._base(state, parts)
        return self._merged(state, None if base is None else base.filter(wanted), recent.filter(wanted))

    def _in_bucket(self, state: dict[str, Any], parts: Sequence[str], first_key: Any) -> list[str]:
        """Those of the folders that are of the one bucket that can hold a key."""
        # Hashes depend on the type: 5 as an int is another bucket than 5 as a bigint.
        kind = self._schema(state)[self.keys[0]].dataType
        typed = F.lit(first_key).cast(kind)
        one = self.spark.range(1).select(bucket_of(typed, self.buckets).alias("b"))
        suffix = f"/_bucket={one.first()['b']}"
        return [p for p in parts if p.endswith(suffix)]

    def _same_keys(self, state: dict[str, Any], rows: DataFrame) -> DataFrame:
        """The table's rows that have a key of ``rows``."""
        if not state:
            return rows.limit(0)
        keys = rows.select(*self.keys).distinct()
        base = self._base(state, self._folders(keys))
        base = None if base is None else base.join(keys, self.keys, "left_semi")
        recent = self._changes(state).join(keys, self.keys, "left_semi")
        return self._merged(state, base, recent)

    def _folders(self, rows: DataFrame) -> list[str]:
        """Names of the folders the rows belong to: at most days times buckets of them."""
        places = self._placed(rows).select(_DAY, _BUCKET).distinct()
        return [_folder(row._day, row._bucket) for row in places.collect()]

    def _merged(
        self, state: dict[str, Any], base: DataFrame | None, recent: DataFrame
    ) -> DataFrame:
        names = self._schema(state).names
        if base is not None and not state["batches"]:
            return base.select(*names)
        newest = latest_per_key(recent, self.keys, [_BATCH])
        alive = newest.filter(~F.col(DELETED)).select(*names)
        if base is None:
            return alive
        changed = recent.select(*self.keys).distinct()
        kept = base.select(*names).join(changed, self.keys, "left_anti").select(*names)
        return kept.unionByName(alive)

    # -- upkeep ----------------------------------------------------------------------------

    def _placed(self, rows: DataFrame) -> DataFrame:
        day = (
            F.to_date(F.col(self.day_column)) if self.day_column else F.lit(None).cast("date")
        )
        return rows.withColumn(_DAY, day).withColumn(
            _BUCKET, bucket_of(F.col(self.keys[0]), self.buckets)
        )

    def compact_if(self, batches: int) -> int:
        """Compact once the change log has grown to that many batches."""
        _, state = self._read()
        return self.compact() if len(state.get("batches", [])) >= batches else 0

    def compact(self) -> int:
        """Fold the change log into the base; rewrites only days and buckets that changed.

        The rows of a folder are dealt to as many tasks as their size asks for (rebalance), so
        a bucket with a great share of the table is not one task. Gives the folders rewritten.
        """
        version, state = self._read()
        recent = self._changes(state)
        touched = self._folders(recent)
        if not touched:
            return 0
        merged = self._placed(self._merged(state, self._base(state, touched), recent))
        run = uuid.uuid4().hex
        target = f"{self.path}/base/{_VERSION}={run}"
        merged.hint("rebalance", _DAY, _BUCKET).write.partitionBy(_DAY, _BUCKET).parquet(target)
        present = {
            f"{day.rsplit('/', 1)[1]}/{bucket.rsplit('/', 1)[1]}"
            for day in self._versions.folders(target)
            for bucket in self._versions.folders(day)
        }
        base = {p: v for p, v in state["base"].items() if p not in touched}
        base.update({p: run for p in touched if p in present})
        self._versions.commit(version, {**state, "base": base, "batches": []})
        return len(touched)

    def retain(self, since: dt.date) -> int:
        """Let go of the days before ``since``: compacts, then drops their folders unread.

        Gives the number of folders. Rows of such days that come later stay until the next time.
        """
        if self.day_column is None:
            raise ValueError("the table is not laid out by day")
        self.compact()
        version, state = self._read()
        kept = {p: v for p, v in state["base"].items() if _day_of(p) >= since.isoformat()}
        gone = len(state["base"]) - len(kept)
        if gone:
            self._versions.commit(version, {**state, "base": kept})
        return gone

    def vacuum(self) -> list[str]:
        """Delete folders the newest state does not name; readers must be on that state."""
        _, state = self._read()
        alive = {f"{_RUN}={b['run']}" for b in state.get("batches", [])}
        alive |= {f"_version={v}" for v in state.get("base", {}).values()}
        gone = [
            folder
            for part in ("changes", "base")
            for folder in self._versions.folders(f"{self.path}/{part}")
            if folder.rsplit("/", 1)[1] not in alive
        ]
        for folder in gone:
            self._versions.delete(folder)
        self._versions.prune()
        return gone


def writer_of(rows: DataFrame) -> str:
    """Inside ``foreachBatch``: the id of the running query, which stays with its checkpoint."""
    name = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not name:
        raise RuntimeError("not called from a streaming query")
    return name


def _day_of(part: str) -> str:
    return part.split("/", 1)[0].removeprefix(f"{_DAY}=")


def _folder(day: Any, bucket: int) -> str:
    name = "__HIVE_DEFAULT_PARTITION__" if day is None else day.isoformat()
    return f"_day={name}/_bucket={bucket}"
