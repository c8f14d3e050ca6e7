"""A table that moves its older rows to a second, cheaper place and still reads as one.

Rows live in folders with random names below ``hot`` and ``cold``; the state file says which count. Each
move is one commit, so the two places never overlap and never miss a row, whenever a job stops.
"""

from __future__ import annotations

import datetime as dt
import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.sources.versions import Versions

_RUN = "_run"


class TieredTable:
    """Append, move what has cooled down, drop what has expired, read all of it."""

    def __init__(self, spark: SparkSession, hot: str, cold: str, ts: str) -> None:
        self.spark, self.ts = spark, ts
        self.places = {"hot": hot.rstrip("/"), "cold": cold.rstrip("/")}
        self._versions = Versions(spark, hot)

    def _write(self, rows: DataFrame, place: str) -> dict[str, Any]:
        """Write a run and describe it: its name and the range of its times."""
        run = uuid.uuid4().hex
        folder = f"{self.places[place]}/{_RUN}={run}"
        rows.write.parquet(folder)
        times = self.spark.read.schema(rows.schema).parquet(folder).select(
            F.col(self.ts).cast("timestamp_ntz").alias("t")
        )
        found = times.agg(
            F.min("t").alias("first"), F.max("t").alias("last"), F.count_if(F.col("t").isNull()).alias("n")
        ).first()
        return {
            "run": run,
            "first": found["first"] and found["first"].isoformat(),
            "last": found["last"] and found["last"].isoformat(),
            "untimed": found["n"] > 0,
        }

    def _rows(
        self, state: dict[str, Any], place: str, runs: list[dict[str, Any]] | None = None
    ) -> DataFrame:
        schema = T.StructType.fromJson(state["schema"])
        wanted = state[place] if runs is None else runs
        if not wanted:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema)
        return reader.parquet(*(f"{self.places[place]}/{_RUN}={r['run']}" for r in wanted))

    def append(self, rows: DataFrame) -> int:
        """Add rows to the hot place; gives the new version."""
        version, state = self._versions.read()
        run = self._write(rows, "hot")
        new = {
            "hot": [*state.get("hot", []), run],
            "cold": state.get("cold", []),
            "schema": rows.schema.jsonValue(),
        }
        return self._versions.commit(version, new)

    def _before(self, limit: dt.datetime) -> Column:
        """True for rows from before a time; a row without a time is never old."""
        return F.coalesce(F.col(self.ts) < F.lit(limit).cast("timestamp_ntz"), F.lit(False))

    def tier(self, older_than: dt.datetime) -> int:
        """Move rows from before a time to the cold place; gives the runs taken apart."""
        version, state = self._versions.read()
        taken, mixed, rest = _sorted_by_age(state.get("hot", []), older_than)
        if not taken:
            return 0
        old = self._before(older_than)
        cold = self._write(self._rows(state, "hot", taken).filter(old), "cold")
        if mixed:
            kept = self._rows(state, "hot", mixed).filter(~old)
            rest = [*rest, self._write(kept, "hot")]
        self._versions.commit(version, {**state, "hot": rest, "cold": [*state["cold"], cold]})
        return len(taken)

    def purge(self, before: dt.datetime) -> int:
        """Drop rows from before a time in both places; whole runs go without being read."""
        version, state = self._versions.read()
        new, touched = dict(state), 0
        for place in self.places:
            taken, mixed, rest = _sorted_by_age(state.get(place, []), before)
            touched += len(taken)
            if mixed:
                kept = self._rows(state, place, mixed).filter(~self._before(before))
                rest = [*rest, self._write(kept, place)]
            new[place] = rest
        if touched:
            self._versions.commit(version, new)
        return touched

    def hot(self) -> DataFrame:
        """Rows in the hot place."""
        return self._rows(self._versions.read()[1], "hot")

    def cold(self) -> DataFrame:
        """Rows in the cold place."""
        return self._rows(self._versions.read()[1], "cold")

    def read(self) -> DataFrame:
        """All rows, from one and the same state of both places."""
        _, state = self._versions.read()
        return self._rows(state, "hot").unionByName(self._rows(state, "cold"))

    def vacuum(self) -> list[str]:
        """Delete folders the newest state does not name; readers must be on that state."""
        _, state = self._versions.read()
        gone = [
            folder
            for place, path in self.places.items()
            for folder in self._versions.folders(path)
            if folder.rsplit("/", 1)[1].startswith(f"{_RUN}=")
            and folder.rsplit("=", 1)[1] not in [r["run"] for r in state.get(place, [])]
        ]
        for folder in gone:
            self._versions.delete(folder)
        self._versions.prune()
        return gone


def _sorted_by_age(
    runs: list[dict[str, Any]], before: dt.datetime
) -> tuple[list[dict[str, Any]], list[dict[str, Any]], list[dict[str, Any]]]:
    """Runs with rows from before a time, those of them with others as well, and the rest.

    The range of times written beside each run decides, so no data is read.
    """

    def is_old(text: str | None) -> bool:
        return text is not None and dt.datetime.fromisoformat(text) < before

    taken = [r for r in runs if is_old(r["first"])]
    mixed = [r for r in taken if r["untimed"] or not is_old(r["last"])]
    return taken, mixed, [r for r in runs if r not in taken]
