"""The pipeline on streams: fused into one query, or one query per stage."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wardline.operators.enrich import enrich, split_bad
from wardline.operators.route import route_together
from wardline.operators.score import score_together, with_trust
from wardline.operators.totals import load_typed, totals
from wardline.operators.window import finish_window, merge_sums, tumble_pivot, window_sums
from wardline.plans.pipeline import Clocks, early_warning, scored_readings
from wardline.schemas import ENRICHED, ROUTED, SCORED, SCORES_KEY, STORED_KEY
from wardline.sources import folders
from wardline.sources.upsert import UpsertTable, writer_of
from wardline.vitals import BUCKETS

# Exactly once comes from the checkpoint and the tables' commit per batch; a batch a minute.
EVERY_MINUTE: dict[str, Any] = {"processingTime": "60 seconds"}
UNTIL_DONE: dict[str, Any] = {"availableNow": True}
LATENESS = "5 minutes"
# Batches of the change log before it is folded into the table: an hour of them.
COMPACT_EVERY = 60


def _lateness(late: str, lateness: str) -> str | None:
    if late not in ("keep", "drop"):
        raise ValueError(f"late must be 'keep' or 'drop', not {late!r}")
    return lateness if late == "drop" else None


def stored_table_at(
    spark: SparkSession, path: str, null_key: str = "error", buckets: int = BUCKETS
) -> UpsertTable:
    """The final table: unique per patient and window, by day and patient bucket."""
    return UpsertTable(spark, path, STORED_KEY, buckets, "window_start", null_key)


def sums_table_at(spark: SparkSession, path: str, null_key: str, buckets: int) -> UpsertTable:
    """What is known of every window so far, so that a late reading can still be added to it."""
    return UpsertTable(spark, path, SCORES_KEY, buckets, "window_start", null_key)


def add_to_windows(sums: UpsertTable, scored: DataFrame, batch_id: int, writer: str) -> DataFrame:
    """Combine a batch of scored readings with the stored sums; the windows it changed, as they are now.

    The readings combine within the batch first, so sums of patients and minutes travel. A batch
    that comes again changes nothing and gives the same windows.
    """
    sums.upsert(window_sums(scored), batch_id, writer=writer, combine=merge_sums)
    return sums.batch(batch_id, writer)


def _parted(
    raw: DataFrame, on_bad: str, quarantine: str | None
) -> tuple[DataFrame, DataFrame | None]:
    """Readings to go on with, and those for the quarantine folder."""
    if on_bad == "fail":
        return raw, None
    if on_bad != "quarantine" or quarantine is None:
        raise ValueError("on_bad is 'fail', or 'quarantine' with a folder for the bad readings")
    return split_bad(raw, need_patient=True)


def start_fused(
    raw: DataFrame,
    table: UpsertTable,
    checkpoint: str,
    late: str = "keep",
    lateness: str = LATENESS,
    trigger: dict[str, Any] | None = None,
    on_bad: str = "fail",
    at: Clocks = Clocks(),
    compact_every: int = COMPACT_EVERY,
    quarantine: str | None = None,
) -> StreamingQuery:
    """All stages in one query, into the final table.

    ``late="keep"`` adds every reading to its window, however late, without state in the stream:
    the sums of each window stand in a table of their own below the final one, and a batch reads
    those it adds to. ``late="drop"`` keeps windows as state; those older than ``lateness`` are let
    go and rows for them dropped.

    ``on_bad="quarantine"`` writes readings that ``split_bad`` sets aside, those without a patient
    among them, to the folder ``quarantine``. With ``late="drop"`` a second query does that; if it fails, the
    next batch of this one fails too.
    """
    within = _lateness(late, lateness)
    good, bad = _parted(raw, on_bad, quarantine)
    if within is None:
        return _start_keeping(raw, table, checkpoint, trigger, on_bad, at, compact_every, quarantine)
    beside = None
    if bad is not None:
        beside = (
            bad.writeStream.option("checkpointLocation", f"{checkpoint}/quarantine")
            .option("path", quarantine)
            .trigger(**(trigger or EVERY_MINUTE))
            .start()
        )
    final = early_warning(good, at, on_bad, within)

    def write(rows: DataFrame, batch_id: int) -> None:
        if beside is not None and (failed := beside.exception()) is not None:
            raise RuntimeError("the query that sets bad readings aside has failed") from failed
        # A batch comes in as many parts as there is state; rebalanced, it is few files.
        final = load_typed(rows, at.storage).hint("rebalance")
        table.upsert(final, batch_id, writer=writer_of(rows))
        table.compact_if(compact_every)

    return (
        final.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_MINUTE))
        .start()
    )


def _start_keeping(
    raw: DataFrame,
    table: UpsertTable,
    checkpoint: str,
    trigger: dict[str, Any] | None,
    on_bad: str,
    at: Clocks,
    compact_every: int,
    quarantine: str | None,
) -> StreamingQuery:
    sums = sums_table_at(table.spark, f"{table.path}/sums", table.null_key, table.buckets)

    def write(rows: DataFrame, batch_id: int) -> None:
        writer = writer_of(rows)
        good, bad = _parted(rows, on_bad, quarantine)
        if bad is not None:
            # by writer and batch, so that a batch that comes again replaces itself
            folder = f"{quarantine}/_writer={writer}/_batch={batch_id:012d}"
            bad.write.mode("overwrite").parquet(folder)
        changed = add_to_windows(sums, scored_readings(good, at, on_bad), batch_id, writer)
        final = totals(finish_window(changed, at.union), at.aggregation)
        table.upsert(load_typed(final, at.storage), batch_id, writer=writer)
        for each in (sums, table):
            each.compact_if(compact_every)

    return (
        raw.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_MINUTE))
        .start()
    )


@dataclass
class Staged:
    """The staged pipeline: a durable folder between any two stages.

    Each stage is a query of its own and stamps its own clock, so the latency queries show
    real hops. Routed and scored readings of all vital signs share one folder partitioned by
    vital sign: one query and one write instead of six.

    ``retention``, such as ``"7d"``, lets the folders between stages forget files written longer ago than that: they are
    no longer listed, and ``drop_forgotten`` deletes them. It must be longer than a stage may be down. The raw
    folder has a life cycle of its own (``read_json_folder(archive=...)``).

    ``late`` is as in ``start_fused``. With ``on_bad="quarantine"`` a query of its own writes bad
    readings to ``quarantine``.
    """

    spark: SparkSession
    root: str
    late: str = "keep"
    lateness: str = LATENESS
    on_bad: str = "fail"
    null_key: str = "error"
    trigger: dict[str, Any] = field(default_factory=lambda: dict(EVERY_MINUTE))
    at: Clocks = Clocks()
    file_format: str = "parquet"
    compact_every: int = COMPACT_EVERY
    buckets: int = BUCKETS
    retention: str | None = None

    def _path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def _sink(self, df: DataFrame, name: str, by_type: bool) -> StreamingQuery:
        times = [
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if f.dataType.typeName() == "timestamp"
            else F.col(f.name)
            for f in df.schema
        ]
        writer = df.select(*times).writeStream.format(self.file_format).outputMode("append")
        if by_type:
            writer = writer.partitionBy("measurement_type")
        if self.retention is not None:
            writer = writer.option("retention", self.retention)
        return (
            writer.option("checkpointLocation", self._path("checkpoints", name))
            .option("path", self._path(name))
            .trigger(**self.trigger)
            .start()
        )

    def _source(self, name: str, schema: T.StructType, typed: bool) -> DataFrame:
        if typed:
            schema = T.StructType(
                [*schema.fields, T.StructField("measurement_type", T.StringType())]
            )
        reader = self.spark.readStream.schema(schema).format(self.file_format)
        return reader.load(self._path(name))

    def drop_forgotten(self) -> int:
        """Delete the files between stages that their folder no longer lists; how many there were.

        Files of a batch that is not committed yet are not listed either, so only files written before
        the oldest listed one go.
        """
        dropped = 0
        for name in ("enriched", "routed", "scored"):
            listed = set(self.spark.read.format(self.file_format).load(self._path(name)).inputFiles())
            found = folders.files(self.spark, self._path(name), f".{self.file_format}")
            oldest = min((at for file, at in found if file in listed), default=None)
            for file, at in found:
                if oldest is not None and file not in listed and at < oldest:
                    folders.delete(self.spark, file)
                    dropped += 1
        return dropped

    def enrich(self, raw: DataFrame) -> StreamingQuery:
        """Stage 1: raw to enriched readings."""
        good, _ = _parted(raw, self.on_bad, self._path("quarantine"))
        return self._sink(enrich(good, self.on_bad, self.at.enrichment), "enriched", False)

    def quarantine(self, raw: DataFrame) -> StreamingQuery | None:
        """Beside stage 1: bad readings to a folder; None if they stop the stream instead."""
        _, bad = _parted(raw, self.on_bad, self._path("quarantine"))
        return None if bad is None else self._sink(bad, "quarantine", False)

    def route(self) -> StreamingQuery:
        """Stage 2: enriched readings to one folder per vital sign."""
        rows = self._source("enriched", ENRICHED, False)
        return self._sink(route_together(rows, self.at.routing), "routed", True)

    def score(self) -> StreamingQuery:
        """Stage 3: points per reading, again one folder per vital sign."""
        rows = self._source("routed", ROUTED, True)
        return self._sink(score_together(rows, self.at.scoring), "scored", True)

    @property
    def sums(self) -> UpsertTable:
        """Sums per patient and window, to which late readings are added."""
        return sums_table_at(self.spark, self._path("sums"), self.null_key, self.buckets)

    @property
    def scores(self) -> UpsertTable:
        """Scores per patient and window, before the totals."""
        return UpsertTable(
            self.spark,
            self._path("scores"),
            SCORES_KEY,
            self.buckets,
            day_column="window_start",
            null_key=self.null_key,
        )

    @property
    def stored(self) -> UpsertTable:
        """The final table."""
        return stored_table_at(self.spark, self._path("stored"), self.null_key, self.buckets)

    def combine(self) -> StreamingQuery:
        """Stages 4 to 6: window and pivot into ``scores``, then totals into ``stored``.

        The totals are read back from the batch committed to ``scores``, so a replayed batch
        gives the same totals, and no stream has to follow a changing table.
        """
        scored = with_trust(self._source("scored", SCORED, True))
        lateness = _lateness(self.late, self.lateness)
        keep = lateness is None
        if not keep:
            scored = tumble_pivot(scored, lateness=lateness, clock=self.at.union)

        def write(rows: DataFrame, batch_id: int) -> None:
            writer = writer_of(rows)
            if keep:
                rows = finish_window(add_to_windows(self.sums, rows, batch_id, writer), self.at.union)
            self.scores.upsert(rows.hint("rebalance"), batch_id, writer=writer)
            final = totals(self.scores.batch(batch_id, writer), self.at.aggregation)
            self.stored.upsert(load_typed(final, self.at.storage), batch_id, writer=writer)
            for table in (self.sums, self.scores, self.stored) if keep else (self.scores, self.stored):
                table.compact_if(self.compact_every)

        return (
            scored.writeStream.outputMode("append" if keep else "update")
            .foreachBatch(write)
            .option("checkpointLocation", self._path("checkpoints", "combined"))
            .trigger(**self.trigger)
            .start()
        )

    def start(self, raw: DataFrame) -> list[StreamingQuery]:
        """Start every stage at once, to run side by side."""
        aside = self.quarantine(raw)
        stages = [self.enrich(raw), self.route(), self.score(), self.combine()]
        return stages if aside is None else [*stages, aside]

    def run_through(self, raw: DataFrame) -> None:
        """Bring all input there is now through every stage, one stage after another."""
        self.trigger = dict(UNTIL_DONE)
        aside = self.quarantine(raw)
        if aside is not None:
            aside.awaitTermination()
        self.enrich(raw).awaitTermination()
        self.route().awaitTermination()
        self.score().awaitTermination()
        self.combine().awaitTermination()
