"""Windows as stored partial sums: late readings are added, and sums that have been idle start afresh.

A batch combines its own readings to sums per patient and window, merges them with the stored sums of the same days
and buckets, and replaces those folders (``PartitionedTable``). The stream itself has no state, and no
Python runs per window: expiry is a comparison of the batch's clock with the time a sum was last added to.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wardline.operators.totals import load_typed, totals
from wardline.operators.window import finish_window, merge_sums, window_sums
from wardline.plans.pipeline import Clocks, scored_readings
from wardline.schemas import RAW, STORED_KEY
from wardline.sources.partitioned import BATCH, FRESH, PartitionedTable
from wardline.streaming.pipeline import EVERY_MINUTE
from wardline.vitals import BUCKETS, STATE_TTL_MS

LAST_SEEN = "last_seen"


def sums_schema(spark: SparkSession) -> T.StructType:
    """The columns of ``window_sums``, and when they were last added to."""
    sums = window_sums(scored_readings(spark.createDataFrame([], RAW))).schema
    return T.StructType([*sums.fields, T.StructField(LAST_SEEN, T.TimestampNTZType())])


def sums_at(
    spark: SparkSession, path: str, null_key: str = "error", buckets: int = BUCKETS
) -> PartitionedTable:
    """The sums of every window, by day and patient bucket."""
    return PartitionedTable(
        spark, path, sums_schema(spark), STORED_KEY, buckets=buckets, day_column="window_start", null_key=null_key
    )


def add_sums(
    table: PartitionedTable,
    scored: DataFrame,
    batch_id: int,
    now: dt.datetime,
    lifetime: dt.timedelta | None = None,
) -> None:
    """Add a batch of scored readings to the stored sums, at the time ``now`` by the batch's clock.

    Sums that have not been added to for longer than ``lifetime`` are expired: new readings of their window
    replace them. A window without new readings stays as it is.
    """
    fresh = window_sums(scored).select(
        "*", F.lit(now).cast("timestamp_ntz").alias(LAST_SEEN), F.lit(batch_id).cast("long").alias(BATCH)
    )

    def combine(both: DataFrame) -> DataFrame:
        merged = lambda rows: merge_sums(rows, F.max(LAST_SEEN).alias(LAST_SEEN), F.max(BATCH).alias(BATCH))
        if lifetime is None:
            return merged(both)
        idle = F.col(LAST_SEEN) < F.lit(now - lifetime).cast("timestamp_ntz")
        alive = merged(both.filter(F.col(FRESH) | ~idle))
        # one row per window is stored, so idle sums without new readings have nothing to merge with
        kept = both.filter(~F.col(FRESH) & idle).join(both.filter(FRESH).select(*STORED_KEY), STORED_KEY, "left_anti")
        return alive.unionByName(kept.select(*alive.columns))

    table.write(fresh, batch_id, combine)


def final_of(table: PartitionedTable, at: Clocks = Clocks(), **what: Any) -> DataFrame:
    """The final table as the sums have it now; ``what`` is for ``PartitionedTable.read``."""
    wide = finish_window(table.read(**what).drop(LAST_SEEN), at.union)
    return load_typed(totals(wide, at.aggregation), at.storage)


def utc_now(batch_id: int) -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def start_sums(
    raw: DataFrame,
    table: PartitionedTable,
    checkpoint: str,
    lifetime: dt.timedelta | None = None,
    trigger: dict[str, Any] | None = None,
    on_bad: str = "fail",
    at: Clocks = Clocks(),
    clock: Callable[[int], dt.datetime] = utc_now,
) -> StreamingQuery:
    """Raw readings into stored sums, however late they are; ``final_of`` makes the final table of them.

    ``lifetime`` (``TTL`` is the deployment's five minutes) lets idle windows start afresh; None never does.
    ``clock`` gives the time of a batch.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        add_sums(table, scored_readings(rows, at, on_bad), batch_id, clock(batch_id), lifetime)

    return (
        raw.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_MINUTE))
        .start()
    )


TTL = dt.timedelta(milliseconds=STATE_TTL_MS)
