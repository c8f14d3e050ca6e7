"""Hot and cold rows as two roots partitioned by day, and the day that parts them.

``hot/_day=D`` and ``cold/_day=D`` are plain Parquet folders; ``boundary/D`` names the first hot day. Readers take hot days
from the boundary on and cold days before it, so each half prunes its folders, and what lies in both while days are
being moved counts once. A move copies whole days, sets the boundary, and then lets the hot folders go; it may die
anywhere and be done again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.sources import folders

_DAY = "_day"


class TierDays:
    """Rows by day of ``ts``, which is not null; one writer or mover at a time."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, ts: str) -> None:
        self.spark, self.root, self.schema, self.ts = spark, root.rstrip("/"), schema, ts

    def boundary(self) -> dt.date | None:
        """The first hot day; None while nothing is cold."""
        names = [
            n for n in folders.names(self.spark, f"{self.root}/boundary")
            if folders.exists(self.spark, f"{self.root}/boundary/{n}/_SUCCESS")
        ]
        return dt.date.fromisoformat(max(names)) if names else None

    def append(self, rows: DataFrame) -> None:
        """Add rows; those of cold days go to the cold root."""
        placed = rows.select(*self.schema.names, F.col(self.ts).cast("date").alias(_DAY))
        first, parts = self.boundary(), {"hot": placed}
        if first is not None:
            cold = F.col(_DAY) < F.lit(first)
            parts = {"hot": placed.filter(~cold), "cold": placed.filter(cold)}
        for name, part in parts.items():
            part.hint("rebalance", _DAY).write.mode("append").partitionBy(_DAY).parquet(f"{self.root}/{name}")

    def _read(self, name: str) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(_DAY, T.DateType())])
        path = f"{self.root}/{name}"
        if not folders.exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def move(self, first_hot: dt.date) -> None:
        """Make all days before ``first_hot`` cold."""
        before = self.boundary()
        if before is not None and first_hot <= before:
            return
        days = self._read("hot").filter(F.col(_DAY) < F.lit(first_hot))
        if before is not None:  # what is left of an earlier move is cold already
            days = days.filter(F.col(_DAY) >= F.lit(before))
        (
            days.hint("rebalance", _DAY)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(_DAY)
            .parquet(f"{self.root}/cold")
        )
        days.limit(0).select(_DAY).write.mode("overwrite").parquet(f"{self.root}/boundary/{first_hot.isoformat()}")
        self._drop("hot", first_hot)

    def purge(self, first_kept: dt.date) -> None:
        """Let all days before ``first_kept`` go, hot or cold, unread."""
        for name in ("hot", "cold"):
            self._drop(name, first_kept)

    def _drop(self, name: str, first: dt.date) -> None:
        for folder in folders.names(self.spark, f"{self.root}/{name}"):
            day = folder.removeprefix(f"{_DAY}=")
            if day != folder and day < first.isoformat():
                folders.delete(self.spark, f"{self.root}/{name}/{folder}")

    def read(self, days: tuple[dt.date, dt.date] | None = None, tier: bool = False) -> DataFrame:
        """All rows, or those of some days (both included); ``tier`` adds the place a row is in."""
        first = self.boundary()
        hot, cold = self._read("hot"), self._read("cold")
        if first is None:
            cold = cold.filter(F.lit(False))
        else:
            hot, cold = hot.filter(F.col(_DAY) >= F.lit(first)), cold.filter(F.col(_DAY) < F.lit(first))
        if days is not None:
            wanted = F.col(_DAY).between(F.lit(days[0]), F.lit(days[1]))
            hot, cold = hot.filter(wanted), cold.filter(wanted)
        names = self.schema.names
        if not tier:
            return hot.select(*names).unionByName(cold.select(*names))
        return hot.select(*names, F.lit("hot").alias("tier")).unionByName(
            cold.select(*names, F.lit("cold").alias("tier"))
        )
