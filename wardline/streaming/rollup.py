"""Half-hour trends kept up to date by the stream: sums and counts per patient and half hour.

A batch brings minutes that are new and minutes that have changed. What they add to their half hours, less what
their former values had added, is merged into the roll-up; a trend then reads sums, thirty times fewer rows than
minutes. The roll-up is written before the minutes, so a batch that comes again after either finds its own
rows pending and adds nothing twice.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wardline.functions import half_hour
from wardline.operators.serve import TRENDS
from wardline.operators.totals import load_typed
from wardline.plans.pipeline import Clocks, early_warning
from wardline.schemas import STORED_KEY
from wardline.sources.partitioned import BATCH, FRESH, PartitionedTable
from wardline.streaming.pipeline import EVERY_MINUTE, LATENESS
from wardline.vitals import BUCKETS

KEY = ["patient_id", "time_window"]
_SUMS = [f"{name}_{part}" for name in TRENDS for part in ("sum", "n")]
SCHEMA = T.StructType(
    [
        T.StructField("patient_id", T.StringType()),
        T.StructField("time_window", T.TimestampNTZType()),
        *(T.StructField(c, T.LongType() if c.endswith("_n") else T.DoubleType()) for c in _SUMS),
    ]
)


def rollup_at(spark: SparkSession, path: str, null_key: str = "error", buckets: int = BUCKETS) -> PartitionedTable:
    """Sums and counts per patient and half hour, by day and patient bucket."""
    return PartitionedTable(
        spark, path, SCHEMA, KEY, buckets=buckets, day_column="time_window", null_key=null_key
    )


def half_hour_sums(minutes: DataFrame, sign: str = "1") -> DataFrame:
    """Sum and count of every trend's column per patient and half hour, times ``sign``, a SQL expression."""
    parts = []
    for name, (column, positive) in TRENDS.items():
        counts = f"{column} > 0" if positive else f"{column} IS NOT NULL"
        parts.append(F.expr(f"coalesce(sum(if({counts}, {column} * {sign}, NULL)), 0D)").alias(f"{name}_sum"))
        parts.append(F.expr(f"coalesce(sum(if({counts}, bigint({sign}), NULL)), 0L)").alias(f"{name}_n"))
    return minutes.groupBy("patient_id", half_hour("window_start").alias("time_window")).agg(*parts)


def _added(both: DataFrame) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in _SUMS]
    return both.groupBy(*KEY).agg(*sums, F.max(BATCH).alias(BATCH))


def trends_of(rollup: DataFrame) -> DataFrame:
    """The means of all trends out of the sums; null where nothing counts."""
    means = [F.expr(f"if({n}_n > 0, {n}_sum / {n}_n, NULL)").alias(n) for n in TRENDS]
    return rollup.select(*KEY, *means)


def add_minutes(minutes: PartitionedTable, rollup: PartitionedTable, rows: DataFrame, batch_id: int) -> None:
    """Merge a batch of stored rows into the minutes and what they change into the roll-up."""
    rows = rows.withColumn(BATCH, F.lit(batch_id).cast("long")).persist()
    try:
        new = rows.filter("patient_id IS NOT NULL") if minutes.null_key == "drop" else rows
        former = minutes.read().join(new.select(*STORED_KEY), STORED_KEY, "left_semi")
        names = minutes.schema.names
        signed = new.select(*names, F.lit(1).alias("_sign")).unionByName(former.select(*names, F.lit(-1).alias("_sign")))
        changes = half_hour_sums(signed, "_sign").withColumn(BATCH, F.lit(batch_id).cast("long"))
        rollup.write(changes, batch_id, lambda both: _added(both.drop(FRESH)))
        minutes.write(rows, batch_id)
    finally:
        rows.unpersist()


def start_rollup(
    raw: DataFrame,
    minutes: PartitionedTable,
    rollup: PartitionedTable,
    checkpoint: str,
    lateness: str = LATENESS,
    trigger: dict[str, Any] | None = None,
    at: Clocks = Clocks(),
) -> StreamingQuery:
    """All stages in one query, into the minutes and the half-hour roll-up."""

    def write(rows: DataFrame, batch_id: int) -> None:
        add_minutes(minutes, rollup, load_typed(rows, at.storage), batch_id)

    return (
        early_warning(raw, at, lateness=lateness)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_MINUTE))
        .start()
    )
