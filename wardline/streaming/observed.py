"""Measures of a running stream: rows per second and latency per hop, batch by batch.

The plan itself counts (``DataFrame.observe``): the measures are aggregated in the tasks that work on the rows
anyway, and come with each batch's progress. A listener keeps them as a small table.
"""

from __future__ import annotations

import threading
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from wardline.functions import whole_seconds
from wardline.operators.serve import HOPS

NAME = "hops"
_SCHEMA = "query string, batch_id long, n_input long, seconds double, rows_per_second double, n_rows long, " + ", ".join(
    f"avg_{name}_latency double, max_{name}_latency long" for name, _, _ in HOPS
)


def observed(final: DataFrame, name: str = NAME) -> DataFrame:
    """The same rows; each batch reports their number and the mean and longest latency of every hop, in seconds."""
    measures = [F.count("*").alias("n_rows")]
    for hop, start, end in HOPS:
        seconds = whole_seconds(f"{start}_timestamp", f"{end}_timestamp")
        measures += [F.avg(seconds).alias(f"avg_{hop}_latency"), F.max(seconds).cast("long").alias(f"max_{hop}_latency")]
    return final.observe(name, *measures)


class BatchMeasures(StreamingQueryListener):
    """Keeps the measures of each batch that had rows; ``keep`` batches at most, the oldest go first."""

    def __init__(self, name: str = NAME, keep: int = 10_000) -> None:
        self._name, self._keep, self._rows = name, keep, []
        self._lock = threading.Lock()

    def onQueryStarted(self, event: Any) -> None:
        pass

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        pass

    def onQueryProgress(self, event: Any) -> None:
        progress = event.progress
        found = progress.observedMetrics.get(self._name)
        if found is None or not found["n_rows"]:
            return
        seconds = progress.batchDuration / 1000
        rate = progress.numInputRows / seconds if seconds else None
        row = (str(progress.id), progress.batchId, progress.numInputRows, seconds, rate, *found)
        with self._lock:
            self._rows = [*self._rows, row][-self._keep :]

    def table(self, spark: SparkSession) -> DataFrame:
        """A row per batch so far: input rows, seconds, rows per second, and what ``observed`` measures."""
        with self._lock:
            rows = list(self._rows)
        return spark.createDataFrame(rows, _SCHEMA)
