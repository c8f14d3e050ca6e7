"""The fused stream into partitioned folders."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wardline.operators.totals import load_typed
from wardline.plans.pipeline import Clocks, early_warning
from wardline.schemas import STORED, STORED_KEY
from wardline.sources.partitioned import PartitionedTable
from wardline.streaming.observed import observed
from wardline.streaming.pipeline import EVERY_MINUTE, LATENESS
from wardline.vitals import BUCKETS


def partitioned_at(
    spark: SparkSession, path: str, null_key: str = "error", buckets: int = BUCKETS
) -> PartitionedTable:
    """The final table: unique per patient and window, by day and patient bucket; the later batch wins."""
    return PartitionedTable(
        spark, path, STORED, STORED_KEY, buckets=buckets, day_column="window_start", null_key=null_key
    )


def start_partitioned(
    raw: DataFrame,
    table: PartitionedTable,
    checkpoint: str,
    lateness: str = LATENESS,
    trigger: dict[str, Any] | None = None,
    at: Clocks = Clocks(),
) -> StreamingQuery:
    """All stages in one query; a window's totals replace those of earlier batches.

    Windows are state until ``lateness`` behind the newest reading; rows for older ones are dropped. A batch
    replaces the folders of the days and buckets its windows lie in. ``BatchMeasures`` sees each batch's hops.
    """
    return (
        observed(early_warning(raw, at, lateness=lateness))
        .writeStream.outputMode("update")
        .foreachBatch(table.writer(lambda rows: load_typed(rows, at.storage)))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_MINUTE))
        .start()
    )
