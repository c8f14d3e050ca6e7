"""Every query of the package by name: ``(session, folder of the tables) -> DataFrame``."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline import functions as X
from wardline.functions import ntz
from wardline.operators import lifecycle, metrics, serve
from wardline.operators.enrich import enrich, split_bad
from wardline.operators.latest import apply_cdc, cdc_rows
from wardline.operators.route import route_together, route_vital
from wardline.operators.score import (
    score_all,
    score_together,
    score_vital,
    union_scores,
    with_trust,
)
from wardline.operators.totals import load_typed, mean_trust, totals, with_risk
from wardline.operators.window import tumble_pivot
from wardline.plans import clocks
from wardline.plans.pipeline import (
    early_warning,
    fixed_clocks,
    scored_readings,
    scored_readings_by_branch,
    stored_table,
)
from wardline.plans.readings import raw_readings, readings_from_events
from wardline.plans.samples import customer_changes, dirty, keyed_changes, metric_samples
from wardline.schemas import (
    ENRICHED,
    RAW,
    ROUTED,
    SCORED,
    SCORED_TOPICS,
    TOTALS,
)
from wardline.session import prepare, shared_dir, state_on_disk
from wardline.sources import folders, ingest
from wardline.sources.bucketed import file_bucket, new_name, save_bucketed
from wardline.sources.json_topics import (
    decode_append,
    decode_changes,
    decode_upsert,
    encode_append,
    encode_upsert,
    read_json_folder,
    without_repeats,
)
from wardline.sources.partitioned import BATCH, PartitionedTable
from wardline.sources.tier_days import TierDays
from wardline.sources.tiered import TieredTable
from wardline.sources.upsert import UpsertTable, bucket_of, writer_of
from wardline.streaming.pipeline import UNTIL_DONE, Staged, start_fused, stored_table_at
from wardline.streaming.observed import BatchMeasures
from wardline.streaming.partitioned import partitioned_at, start_partitioned
from wardline.streaming.rollup import rollup_at, start_rollup, trends_of
from wardline.streaming.sums import TTL, final_of, start_sums, sums_at
from wardline.vitals import CODES, WATERMARK

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}

# The patient a dashboard shows when none is chosen.
PATIENT = "P00000001"
SERIES = ["metric", "instance", "env"]
DAY = "1 day"
# Events in a file of a raw topic, about: six times as many readings, 30 MB of JSON before compression.
EVENTS_PER_FILE = 20_000


def query(name: str) -> Callable[[Query], Query]:
    """Register a query under a name."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(prepare(spark), sf_dir)

        CATALOG[name] = run
        return build

    return register


# -- readings: expressions and enrichment --------------------------------------------------


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    return enrich(raw_readings(spark, sf), clock=clocks.enrichment())


@query("parse_value")
def _(spark, sf):
    return raw_readings(spark, sf).select(
        "device_id",
        "measurement_timestamp",
        "raw_value",
        X.parse_value("raw_value").alias("value"),
    )


@query("quarantine_bad")
def _(spark, sf):
    _, bad = split_bad(dirty(raw_readings(spark, sf)))
    return bad.select("device_id", "ingestion_timestamp", "raw_value", "problem")


@query("quarantine_good")
def _(spark, sf):
    rows = enrich(dirty(raw_readings(spark, sf)), "quarantine", clocks.enrichment())
    return rows.select(*ENRICHED.names)


@query("patient_id_extract")
def _(spark, sf):
    rows = raw_readings(spark, sf)
    return rows.select("device_id", X.patient_id("device_id").alias("patient_id"))


@query("quality_factors")
def _(spark, sf):
    return raw_readings(spark, sf).select(
        "device_id",
        "battery",
        "signal_strength",
        X.device_tier_factor("device_id").alias("tier_factor"),
        X.battery_factor("battery").alias("battery_factor"),
        X.signal_factor("signal_strength").alias("signal_factor"),
    )


@query("quality_weight")
def _(spark, sf):
    weight = X.quality_weight("device_id", "battery", "signal_strength")
    return raw_readings(spark, sf).select(
        "device_id", "battery", "signal_strength", weight.alias("quality_weight")
    )


@query("freshness_weight")
def _(spark, sf):
    start, end = "measurement_timestamp", "ingestion_timestamp"
    return raw_readings(spark, sf).select(
        "device_id",
        start,
        end,
        X.whole_hours(start, end).alias("age_hours"),
        X.freshness_weight(start, end).alias("freshness_weight"),
    )


@query("enrich_measurements")
def _(spark, sf):
    return _enriched(spark, sf).select(*ENRICHED.names)


# -- routing and scoring -------------------------------------------------------------------


def _register_vital(code: str) -> None:
    @query(f"route_{code.lower()}")
    def _(spark, sf):
        return route_vital(_enriched(spark, sf), code, clocks.routing())

    @query(f"score_{code.lower()}")
    def _(spark, sf):
        routed = route_vital(_enriched(spark, sf), code, clocks.routing())
        return score_vital(routed, code, clocks.scoring())


for _code in CODES:
    _register_vital(_code)


@query("score_all_one_pass")
def _(spark, sf):
    return score_all(_enriched(spark, sf), clocks.routing(), clocks.scoring())


@query("trust_score")
def _(spark, sf):
    rows = with_trust(score_all(_enriched(spark, sf), clocks.routing(), clocks.scoring()))
    return rows.select(
        "measurement_type", "patient_id", "quality_weight", "freshness_weight", "trust_score"
    )


@query("union_scores")
def _(spark, sf):
    return scored_readings_by_branch(raw_readings(spark, sf), fixed_clocks())


# -- window, totals, stored form -----------------------------------------------------------


@query("tumble_pivot")
def _(spark, sf):
    scored = scored_readings(raw_readings(spark, sf), fixed_clocks())
    return tumble_pivot(scored, clock=clocks.union())


@query("news2_totals")
def _(spark, sf):
    scored = scored_readings(raw_readings(spark, sf), fixed_clocks())
    final = mean_trust(totals(tumble_pivot(scored, clock=clocks.union()), clocks.aggregation()))
    return final.select(
        "patient_id", "window_start", "news2_score", "news2_trust_score", "news2_mean_trust"
    )


@query("news2_pipeline")
def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Raw readings to early-warning totals per patient and minute."""
    return early_warning(raw_readings(spark, sf), fixed_clocks())


@query("news2_pipeline_by_branch")
def _(spark, sf):
    scored = scored_readings_by_branch(raw_readings(spark, sf), fixed_clocks())
    return totals(tumble_pivot(scored, clock=clocks.union()), clocks.aggregation())


@query("news2_pipeline_quarantine")
def _(spark, sf):
    return early_warning(dirty(raw_readings(spark, sf)), fixed_clocks(), "quarantine")


def _stored(spark: SparkSession, sf: str) -> DataFrame:
    return stored_table(raw_readings(spark, sf), fixed_clocks())


@query("load_typed")
def _(spark, sf):
    return _stored(spark, sf)


@query("risk_band")
def _(spark, sf):
    return with_risk(_stored(spark, sf)).select(
        "patient_id", "window_start", "news2_score", "risk"
    )


@query("hash_buckets")
def _(spark, sf):
    """Rows by bucket: all rows of a patient share one of four buckets."""
    rows = _stored(spark, sf).select("patient_id", bucket_of(F.col("patient_id")).alias("bucket"))
    per = rows.groupBy("patient_id").agg(
        F.count("*").alias("n"),
        (F.max("bucket") - F.min("bucket") + 1).cast("bigint").alias("n_buckets"),
        ((F.min("bucket") >= 0) & (F.max("bucket") < 4)).alias("in_range"),
    )
    return per


# -- serving -------------------------------------------------------------------------------


def _register_trend(name: str, column: str, positive: bool) -> None:
    @query(f"half_hour_{name}")
    def _(spark, sf):
        trend = serve.half_hour_mean(_stored(spark, sf), column, None, positive)
        return trend.withColumn("mean", F.round("mean", 10))


for _name, (_column, _positive) in serve.TRENDS.items():
    _register_trend(_name, _column, _positive)


@query("half_hour_all_patients")
def _(spark, sf):
    rows = serve.half_hour_all(_stored(spark, sf))
    return rows.select(
        "patient_id", "time_window", *(F.round(n, 10).alias(n) for n in serve.TRENDS)
    )


@query("half_hour_one_patient")
def _(spark, sf):
    rows = serve.half_hour_mean(_stored(spark, sf), "heart_rate_value", PATIENT, True)
    return rows.withColumn("mean", F.round("mean", 10))


@query("half_hour_bound_parameter")
def _(spark, sf):
    rows = serve.half_hour_bound(_stored(spark, sf), "news2", PATIENT)
    return rows.withColumn("mean", F.round("mean", 10))


@query("distinct_patients")
def _(spark, sf):
    return serve.patients(_stored(spark, sf))


@query("stage_latency_avg")
def _(spark, sf):
    rows = serve.stage_latency(_stored(spark, sf))
    return rows.select(*(F.round(c, 9).alias(c) for c in rows.columns))


@query("latency_max")
def _(spark, sf):
    return serve.max_latency(_stored(spark, sf))


# -- topics --------------------------------------------------------------------------------


@query("raw_topic")
def _(spark, sf):
    frames = encode_append(raw_readings(spark, sf), RAW, "ingestion_timestamp")
    return decode_append(frames, RAW, "ingestion_timestamp")


@query("topic_from_latest")
def _(spark, sf):
    """Only what arrives after the reader was set up: a quarter of the readings."""
    path, later = shared_dir(spark, "latest"), F.second("measurement_timestamp") % 20 == 5
    raw = raw_readings(spark, sf)
    raw.filter(~later).write.json(path)
    time.sleep(1.1)  # stores may keep whole seconds
    now = spark.sql("SELECT string(current_timestamp())").first()[0]
    time.sleep(1.1)
    raw.filter(later).write.mode("append").json(path)
    return read_json_folder(spark, path, start_after=now, streaming=False)


def _raw_topic(spark: SparkSession, sf: str, path: str) -> int:
    """All readings as a topic of JSON files, six or more; gives the files of a batch, a third of them.

    Events are dealt out to the files, a bounded number each, before they fan out to readings, so that what is
    shuffled is two numbers an event. JSON is long-winded, so the files are compressed.
    """
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "user_id")
    files = max(2, -(-events.count() // (3 * EVENTS_PER_FILE)))
    readings_from_events(events.repartition(3 * files)).write.option("compression", "snappy").json(path)
    return files


@query("archived_topic")
def _(spark, sf):
    """A topic read in batches that move what they have read to an archive; all of it is in the stream's output."""
    path = shared_dir(spark, "archived")
    files = _raw_topic(spark, sf, f"{path}/raw")
    for _ in range(2):
        (
            read_json_folder(spark, f"{path}/raw", files_per_batch=files, archive=f"{path}/archive")
            .withColumn("measurement_timestamp", F.col("measurement_timestamp").cast("timestamp_ntz"))
            .writeStream.option("checkpointLocation", f"{path}/checkpoint")
            .option("path", f"{path}/out")
            .trigger(**UNTIL_DONE)
            .start()
            .awaitTermination()
        )
    return spark.read.parquet(f"{path}/out")


@query("clock_now")
def _(spark, sf):
    """Readings enriched at the batch's own clock: all between the start of the query and its end."""
    began = spark.sql("SELECT cast(current_timestamp() AS timestamp_ntz)").first()[0]
    rows = enrich(raw_readings(spark, sf)).select(
        "measurement_type", ntz(F.col("enrichment_timestamp")).alias("at")
    )
    in_time = F.col("at").between(F.lit(began), F.lit(began + dt.timedelta(hours=1)))
    return rows.groupBy("measurement_type").agg(F.count("*").alias("n"), F.bool_and(in_time).alias("in_time"))


@query("enriched_topic")
def _(spark, sf):
    frames = encode_append(_enriched(spark, sf), ENRICHED, "enrichment_timestamp")
    return decode_append(frames, ENRICHED, "enrichment_timestamp")


@query("routed_folders")
def _(spark, sf):
    """Written by vital sign, one folder each, and all six read back."""
    path = shared_dir(spark, "routed")
    rows = route_together(_enriched(spark, sf), clocks.routing())
    rows.write.partitionBy("measurement_type").parquet(path)
    back = spark.read.schema(rows.schema).parquet(path)
    return back.select("measurement_type", *ROUTED.names)


@query("scored_topics")
def _(spark, sf):
    """Six topics of scored readings, coded, decoded and joined up."""
    enriched = _enriched(spark, sf)
    parts = {}
    for code in SCORED_TOPICS:
        scored = score_vital(
            route_vital(enriched, code, clocks.routing()), code, clocks.scoring()
        )
        frames = encode_append(scored, SCORED, "scoring_timestamp")
        parts[code] = decode_append(frames, SCORED, "scoring_timestamp")
    return union_scores(parts)


@query("scored_folders")
def _(spark, sf):
    path = shared_dir(spark, "scored")
    routed = route_together(_enriched(spark, sf), clocks.routing())
    rows = score_together(routed, clocks.scoring())
    rows.write.partitionBy("measurement_type").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@query("upsert_topic")
def _(spark, sf):
    """Current rows of a keyed topic with deletions."""
    log = keyed_changes(spark, sf)
    frames = encode_upsert(log, ["customer"], "position")
    fields = [f for f in log.schema if f.name not in ("_deleted", "position")]
    return decode_upsert(frames, type(log.schema)(fields))


@query("upsert_topic_stream")
def _(spark, sf):
    """The same topic as a stream into a keyed table, its second half by a second run."""
    path = shared_dir(spark, "frames")
    log = keyed_changes(spark, sf)
    fields = [f for f in log.schema if f.name not in ("_deleted", "position")]
    schema = type(log.schema)(fields)
    frames = encode_upsert(log, ["customer"], "position")
    table = UpsertTable(spark, f"{path}/table", ["customer"])
    half = frames.agg((F.max("offset") / 2).cast("bigint").alias("half")).first()["half"]

    def write(batch: DataFrame, batch_id: int) -> None:
        changes = decode_changes(batch, ["customer"], schema)
        table.upsert(changes, batch_id, ["offset"], writer_of(batch))

    for part in (frames.filter(F.col("offset") <= half), frames.filter(F.col("offset") > half)):
        part.write.mode("append").parquet(f"{path}/topic")
        (
            spark.readStream.schema(frames.schema)
            .parquet(f"{path}/topic")
            .writeStream.foreachBatch(write)
            .option("checkpointLocation", f"{path}/checkpoint")
            .trigger(**UNTIL_DONE)
            .start()
            .awaitTermination()
        )
    return table.latest().drop("offset")


@query("totals_topic")
def _(spark, sf):
    """The totals through their keyed topic: every row written twice, the last one counts."""
    final = early_warning(raw_readings(spark, sf), fixed_clocks())
    final = final.filter(F.col("patient_id").isNotNull())
    first = final.withColumn("news2_score", F.lit(-1.0)).withColumn("at", F.lit(0))
    both = first.unionByName(final.withColumn("at", F.lit(1)))
    frames = encode_upsert(both, ["patient_id", "window_start"], "at")
    return decode_upsert(frames, TOTALS)


# -- stored tables -------------------------------------------------------------------------


def _upserted(spark: SparkSession, sf: str, compact: bool) -> UpsertTable:
    """The change log by customer, written in two batches."""
    table = UpsertTable(spark, shared_dir(spark, "keyed"), ["customer"])
    log = keyed_changes(spark, sf)
    half = log.agg((F.max("position") / 2).cast("bigint").alias("half")).first()["half"]
    parts = (log.filter(F.col("position") <= half), log.filter(F.col("position") > half))
    for batch_id, part in enumerate(parts):
        table.upsert(part, batch_id, ["position"], writer="log")
        if compact:
            table.compact()
    return table


@query("upsert_latest")
def _(spark, sf):
    table = _upserted(spark, sf, compact=False)
    table.upsert(table.batch(0, "log"), 1, writer="log")  # a replayed batch changes nothing
    return table.latest().drop("position")


@query("upsert_two_writers")
def _(spark, sf):
    """Two writers that number their batches alike; neither's rows are lost."""
    table = UpsertTable(spark, shared_dir(spark, "keyed"), ["order_key"], buckets=8)
    log = keyed_changes(spark, sf).drop("_deleted")
    for writer, odd in (("a", 0), ("b", 1)):
        table.upsert(log.filter(F.col("order_key") % 2 == odd), 0, writer=writer)
    table.compact()
    return UpsertTable(spark, table.path, ["order_key"], buckets=8).latest().drop("position")


@query("latest_by_integer_key")
def _(spark, sf):
    """One customer looked up by number in the compacted table: one bucket is read."""
    table = _upserted(spark, sf, compact=True)
    key = table.latest().agg(F.max("customer")).first()[0]
    return table.latest(key).drop("position")


@query("unique_key_compact")
def _(spark, sf):
    return _upserted(spark, sf, compact=True).latest().drop("position")


@query("stored_table_by_day")
def _(spark, sf):
    """The stored table after upsert and compaction by day and bucket."""
    return _compacted(spark, sf).latest()


def _compacted(spark: SparkSession, sf: str) -> UpsertTable:
    table = stored_table_at(spark, shared_dir(spark, "stored"), null_key="drop")
    table.upsert(_stored(spark, sf), 0)
    table.compact()
    return table


@query("served_half_hour_one_patient")
def _(spark, sf):
    """A trend out of the stored table: one bucket of it is read."""
    mine = _compacted(spark, sf).latest(PATIENT)
    rows = serve.half_hour_mean(mine, "heart_rate_value", PATIENT, True)
    return rows.withColumn("mean", F.round("mean", 10))


@query("served_patients")
def _(spark, sf):
    return serve.patients(_compacted(spark, sf).latest())


@query("served_stage_latency")
def _(spark, sf):
    rows = serve.stage_latency(_compacted(spark, sf).latest())
    return rows.select(*(F.round(c, 9).alias(c) for c in rows.columns))



def _stream(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """A table as a stream. The pattern in the path lets it be one file or a folder of them."""
    schema = spark.read.parquet(f"{sf}/{table}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf}/{table}.parque[t]")


@query("upsert_auto_create")
def _(spark, sf):
    """A stream into a keyed table that its first batch creates."""
    path = shared_dir(spark, "sink")
    rows = _stream(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer"),
        F.col("o_orderkey").alias("order_key"),
        F.col("o_totalprice").alias("price"),
    )
    table = UpsertTable(spark, f"{path}/table", ["customer"])
    (
        rows.writeStream.foreachBatch(table.writer(["order_key"]))
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(**UNTIL_DONE)
        .start()
        .awaitTermination()
    )
    return table.latest()


# -- partitioned tables --------------------------------------------------------------------


def _run_twice_or_more(
    spark: SparkSession, path: str, parts: Sequence[DataFrame], write: Callable[[DataFrame, int], None]
) -> None:
    """Each part arrives while the stream is down; a new run of the stream takes it in."""
    for part in parts:
        part.write.mode("append").parquet(f"{path}/arrivals")
        (
            spark.readStream.schema(part.schema)
            .parquet(f"{path}/arrivals")
            .writeStream.foreachBatch(write)
            .option("checkpointLocation", f"{path}/checkpoint")
            .trigger(**UNTIL_DONE)
            .start()
            .awaitTermination()
        )


@query("overwrite_latest")
def _(spark, sf):
    """The change log by customer as a stream, its newer half first: the older half changes nothing newer."""
    path = shared_dir(spark, "overwrite")
    log = keyed_changes(spark, sf)
    schema = log.drop("_deleted", "position").schema
    table = PartitionedTable(spark, f"{path}/table", schema, ["customer"], ["position"])
    half = log.agg((F.max("position") / 2).cast("bigint").alias("half")).first()["half"]
    parts = [log.filter(F.col("position") > half), log.filter(F.col("position") <= half)]
    _run_twice_or_more(spark, path, parts, table.writer())
    return table.read()


@query("overwrite_replayed")
def _(spark, sf):
    """The stored table by day and bucket: early totals, then final ones, whose batch dies half-way and comes again."""
    table = partitioned_at(spark, shared_dir(spark, "overwrite"), null_key="drop")
    final = _stored(spark, sf).withColumn(BATCH, F.lit(1).cast("long"))
    early = final.withColumn("news2_score", F.lit(-1.0)).withColumn(BATCH, F.lit(0).cast("long"))
    table.write(early, 0)
    table.write(final, 1)
    # as if the job had ended after a folder was removed and before its new rows were in place
    folders.delete(spark, f"{table.rows_path}/{folders.names(spark, table.rows_path)[-1]}")
    table.write(final, 1)
    return table.read()


@query("overwrite_stream_final")
def _(spark, sf):
    """The fused stream over JSON files into partitioned folders, which each batch replaces whole."""
    path = shared_dir(spark, "overwrite")
    files = _raw_topic(spark, sf, f"{path}/raw")
    table = partitioned_at(spark, f"{path}/table", null_key="drop")
    start_partitioned(
        read_json_folder(spark, f"{path}/raw", files_per_batch=files),
        table,
        f"{path}/checkpoint",
        lateness="60 days",
        trigger=UNTIL_DONE,
        at=fixed_clocks(),
    ).awaitTermination()
    return table.read()


@query("cdc_out_of_order")
def _(spark, sf):
    """Change events on a stream in three runs: the snapshot, then the deletions, then the older updates."""
    path = shared_dir(spark, "changes")
    log = customer_changes(spark, sf)
    table = PartitionedTable(
        spark, f"{path}/table", log.schema["after"].dataType, ["c_custkey"], ["seq"], forget_after=1000
    )
    parts = [log.filter(F.col("seq") == n) for n in (0, 2, 1)]
    _run_twice_or_more(spark, path, parts, table.writer(lambda rows: cdc_rows(rows, ["seq"])))
    return table.read().withColumn("c_acctbal", F.round("c_acctbal", 2))


@query("tiered_by_day")
def _(spark, sf):
    """Two appends, two moves, late rows of a cold day and a purge; every remaining row with its place."""
    rows = _events(spark, sf)
    table = TierDays(spark, shared_dir(spark, "tiers"), rows.schema, "ts")
    late = F.col("event_id") % 10 == 3
    table.append(rows.filter(~late & (F.col("ts") < F.lit(dt.datetime(2024, 1, 15)))))
    table.append(rows.filter(~late & (F.col("ts") >= F.lit(dt.datetime(2024, 1, 15)))))
    table.move(dt.date(2024, 1, 10))
    table.append(rows.filter(late))
    table.move(dt.date(2024, 1, 20))
    table.purge(dt.date(2024, 1, 5))
    return table.read(tier=True)


@query("bucketed_half_hour")
def _(spark, sf):
    """All trends out of a table hashed by patient: no exchange."""
    rows = serve.half_hour_all(_bucketed(spark, sf))
    return rows.select("patient_id", "time_window", *(F.round(c, 10).alias(c) for c in serve.TRENDS))


@query("bucketed_one_patient")
def _(spark, sf):
    """A trend of one patient: one bucket of the table is read."""
    mine = _bucketed(spark, sf).filter(F.col("patient_id") == PATIENT)
    rows = serve.half_hour_mean(mine, "heart_rate_value", positive_only=True)
    return rows.select("time_window", F.round("mean", 10).alias("mean"))


@query("bucketed_files")
def _(spark, sf):
    """Rows per patient, and whether all lie in files of the bucket that the hash of the patient says."""
    rows = _bucketed(spark, sf).select("patient_id", file_bucket().alias("bucket"))
    right = F.col("bucket") == bucket_of(F.col("patient_id"))
    return rows.groupBy("patient_id").agg(F.count("*").alias("n"), F.bool_and(right).alias("in_its_bucket"))


def _bucketed(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "bucketed")
    return save_bucketed(_stored(spark, sf), new_name(), "patient_id", sort_by=["window_start"], path=path)


@query("rollup_half_hour")
def _(spark, sf):
    """All trends out of half-hour sums that the stream keeps; a quarter of the readings changes minutes once more."""
    path, late = shared_dir(spark, "rollup"), F.second("measurement_timestamp") % 20 == 5
    raw, minutes = raw_readings(spark, sf), partitioned_at(spark, f"{path}/minutes", null_key="drop")
    rollup = rollup_at(spark, f"{path}/rollup", null_key="drop")
    for part in (raw.filter(~late), raw.filter(late)):
        part.write.mode("append").json(f"{path}/raw")
        start_rollup(
            read_json_folder(spark, f"{path}/raw"), minutes, rollup, f"{path}/checkpoint",
            lateness="60 days", trigger=UNTIL_DONE, at=fixed_clocks(),
        ).awaitTermination()
    rows = trends_of(rollup.read())
    return rows.select("patient_id", "time_window", *(F.round(c, 10).alias(c) for c in serve.TRENDS))


# -- streams -------------------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    return readings_from_events(_stream(spark, sf, "events"))


@query("stream_tumble_final")
def _(spark, sf):
    """The fused stream over JSON files, a third of them a batch, late rows kept."""
    path = shared_dir(spark, "fused")
    files = _raw_topic(spark, sf, f"{path}/raw")
    stream = read_json_folder(spark, f"{path}/raw", files_per_batch=files)
    table = stored_table_at(spark, f"{path}/table", null_key="drop")
    start_fused(
        stream, table, f"{path}/checkpoint", late="keep", trigger=UNTIL_DONE, at=fixed_clocks()
    ).awaitTermination()
    return table.latest()


@query("stream_staged_final")
def _(spark, sf):
    """The staged stream, one durable folder between any two stages."""
    staged = Staged(
        spark, shared_dir(spark, "staged"), late="keep", null_key="drop", at=fixed_clocks()
    )
    staged.run_through(_event_stream(spark, sf))
    return staged.stored.latest()


def _with_late_rows(spark: SparkSession, sf: str, late: str) -> DataFrame:
    """A quarter of the readings arrives after all others, by a second run of the stream."""
    path = shared_dir(spark, "late")
    table = stored_table_at(spark, f"{path}/table", null_key="drop")
    raw, afterwards = raw_readings(spark, sf), F.second("measurement_timestamp") % 20 == 5
    for part in (raw.filter(~afterwards), raw.filter(afterwards)):
        part.write.mode("append").json(f"{path}/raw")
        start_fused(
            read_json_folder(spark, f"{path}/raw"),
            table,
            f"{path}/checkpoint",
            late=late,
            lateness=WATERMARK,
            trigger=UNTIL_DONE,
            at=fixed_clocks(),
        ).awaitTermination()
    return table.latest()


@query("stream_late_keep")
def _(spark, sf):
    """Late readings are added to their windows."""
    return _with_late_rows(spark, sf, "keep")


@query("stream_late_drop")
def _(spark, sf):
    """Late readings are dropped where the watermark has passed the end of their window."""
    return _with_late_rows(spark, sf, "drop")


def _quarantining(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    path = shared_dir(spark, "aside")
    dirty(raw_readings(spark, sf)).write.json(f"{path}/raw")
    table = stored_table_at(spark, f"{path}/table")
    start_fused(
        read_json_folder(spark, f"{path}/raw"),
        table,
        f"{path}/checkpoint",
        trigger=UNTIL_DONE,
        on_bad="quarantine",
        at=fixed_clocks(),
        quarantine=f"{path}/bad",
    ).awaitTermination()
    return table.latest(), spark.read.parquet(f"{path}/bad")


@query("stream_quarantine")
def _(spark, sf):
    """What a stream sets aside: no number, not finite, no time, no patient."""
    _, bad = _quarantining(spark, sf)
    return bad.select("device_id", "ingestion_timestamp", "raw_value", "problem")


@query("stream_quarantine_good")
def _(spark, sf):
    """The final table of the same stream; the table would refuse rows without a patient."""
    good, _ = _quarantining(spark, sf)
    return good


@query("stream_ttl")
def _(spark, sf):
    """Sums with a lifetime of five minutes: a fifth of the readings comes within it, a quarter after it.

    Windows that get readings after the lifetime start afresh with them; all others keep what they have.
    """
    path, second = shared_dir(spark, "ttl"), F.second("measurement_timestamp") % 20
    raw, table = raw_readings(spark, sf), sums_at(spark, f"{path}/table", null_key="drop")
    _sums_in_runs(
        spark, path, [raw.filter(~second.isin(5, 10)), raw.filter(second == 10), raw.filter(second == 5)], table,
        clock=lambda batch: dt.datetime(2024, 3, 1, 12) + dt.timedelta(minutes=(0, 4, 20)[batch]), lifetime=TTL,
    )
    return final_of(table, fixed_clocks())


def _sums_in_runs(spark, path, parts, table, within=None, **options):
    """Each part arrives while the stream is down."""
    for part in parts:
        part.write.mode("append").parquet(f"{path}/raw")
        stream = spark.readStream.schema(part.schema).parquet(f"{path}/raw")
        if within is not None:
            stream = without_repeats(stream, within)
        start_sums(
            stream, table, f"{path}/checkpoint", trigger=UNTIL_DONE, at=fixed_clocks(), **options
        ).awaitTermination()


@query("stream_sums_final")
def _(spark, sf):
    """The final table out of stored sums, a quarter of the readings late: none is lost and none counted twice."""
    path, late = shared_dir(spark, "sums"), F.second("measurement_timestamp") % 20 == 5
    raw, table = raw_readings(spark, sf), sums_at(spark, f"{path}/table", null_key="drop")
    _sums_in_runs(spark, path, [raw.filter(~late), raw.filter(late)], table)
    return final_of(table, fixed_clocks())


@query("stream_duplicates")
def _(spark, sf):
    """Readings sent again, in the same run and in the next one: each counts once.

    The second half by record time comes with all readings of the last day of the first half once more.
    """
    path = shared_dir(spark, "repeats")
    raw, table = raw_readings(spark, sf), sums_at(spark, f"{path}/table", null_key="drop")
    sent = F.col("ingestion_timestamp")
    ends = raw.agg(F.min(sent).alias("low"), F.max(sent).alias("high")).first()
    middle = ends["low"] + (ends["high"] - ends["low"]) / 2
    first, rest = raw.filter(sent <= F.lit(middle)), raw.filter(sent > F.lit(middle))
    again = first.filter(sent > F.lit(middle - dt.timedelta(hours=23)))
    # the first run has no watermark yet, so its state is all of its readings
    with state_on_disk(spark):
        _sums_in_runs(spark, path, [first.unionAll(again), rest.unionAll(again)], table, within="24 hours")
    return final_of(table, fixed_clocks())


@query("stream_observed")
def _(spark, sf):
    """What each batch of the fused stream reports of itself: rows, and mean and longest latency of each hop."""
    path, measures = shared_dir(spark, "observed"), BatchMeasures()
    raw, odd = raw_readings(spark, sf), F.minute("measurement_timestamp") % 2
    table = partitioned_at(spark, f"{path}/table", null_key="drop")
    spark.streams.addListener(measures)
    try:
        for part in (0, 1):
            raw.filter(odd == part).write.mode("append").json(f"{path}/raw")
            start_partitioned(
                read_json_folder(spark, f"{path}/raw"), table, f"{path}/checkpoint",
                lateness="60 days", trigger=UNTIL_DONE, at=fixed_clocks(),
            ).awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        rows = measures.table(spark)
    finally:
        spark.streams.removeListener(measures)
    order = Window.orderBy("batch_id")  # one row a batch
    rows = rows.withColumn("odd_minute", (F.row_number().over(order) - 1).cast("long"))
    hops = [c for c in rows.columns if c.endswith("_latency")]
    return rows.select(
        "odd_minute", "n_rows", *(F.round(c, 9).alias(c) if c.startswith("avg") else F.col(c) for c in hops)
    )


# -- metrics -------------------------------------------------------------------------------


def _samples(spark: SparkSession, sf: str, value: str = "value") -> DataFrame:
    rows = metrics.lift_labels(metric_samples(spark, sf), ["instance", "env"])
    return rows.select(*SERIES, "ts", F.col(value).alias("value"))


def _rates(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.counter_rate(_samples(spark, sf, "counter"), SERIES, DAY)


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.instant_per_window(_samples(spark, sf), SERIES, DAY)


def _rounded(df: DataFrame, digits: int = 10) -> DataFrame:
    return df.withColumn("value", F.round("value", digits))


@query("metric_rate")
def _(spark, sf):
    return _rounded(_rates(spark, sf))


@query("metric_rate_hourly")
def _(spark, sf):
    return _rounded(metrics.counter_rate(_samples(spark, sf, "counter"), ["metric"], "1 hour"))


@query("metric_rate_stepped")
def _(spark, sf):
    """Rates over three hours, every hour."""
    samples = _samples(spark, sf, "counter")
    return _rounded(metrics.counter_rate(samples, ["metric"], "3 hours", "1 hour"))


@query("metric_irate")
def _(spark, sf):
    return _rounded(metrics.irate(_samples(spark, sf, "counter"), SERIES, DAY))


@query("metric_instant")
def _(spark, sf):
    return metrics.instant(_samples(spark, sf), SERIES, "2024-01-15 00:00:00", "5 days")


@query("metric_instant_range")
def _(spark, sf):
    """The last values every ten minutes, none older than half an hour."""
    return metrics.instant_range(_samples(spark, sf), SERIES, "10 minutes", "30 minutes", piece=6)


@query("metric_instant_range_busy")
def _(spark, sf):
    """All samples as one series, in pieces of an hour, over ten days of the grid."""
    samples = _samples(spark, sf).select(F.lit("all").alias("metric"), "ts", "value")
    return metrics.instant_range(
        samples, ["metric"], "1 minute", "5 minutes", "2024-01-05 00:00:00", "2024-01-15 00:00:00", piece=60
    )


@query("metric_select_regex")
def _(spark, sf):
    rows = metrics.select_series(
        _samples(spark, sf), {"env": "e1"}, {"metric": "c.*|v.*", "instance": "i[02]"}
    )
    return rows.groupBy("metric", "instance", "env").agg(
        F.count("*").alias("n"), F.max("value").alias("max_value")
    )


@query("metric_sum_avg_count")
def _(spark, sf):
    """Sum, mean and number of series per day."""
    return _daily(spark, sf).groupBy("eval_time").agg(
        F.round(F.sum("value"), 2).alias("sum_value"),
        F.round(F.avg("value"), 9).alias("avg_value"),
        F.count("value").alias("n_series"),
    )


@query("metric_sum_by")
def _(spark, sf):
    return _rounded(metrics.sum_by(_rates(spark, sf), ["eval_time", "env"]))


@query("metric_avg_by")
def _(spark, sf):
    return _rounded(metrics.aggregate_by(_daily(spark, sf), "avg", ["eval_time", "metric"]), 9)


@query("metric_sum_without")
def _(spark, sf):
    return _rounded(metrics.sum_without(_daily(spark, sf), ["instance"]), 2)


@query("metric_vector_add")
def _(spark, sf):
    rates = metrics.scaled(_rates(spark, sf), 1000.0)
    left = metrics.sum_by(metrics.select_series(rates, {"metric": "click"}), ["eval_time"])
    right = metrics.sum_by(metrics.select_series(rates, {"metric": "view"}), ["eval_time"])
    return _rounded(metrics.vector_add(left, right, ["eval_time"]), 6)


@query("metric_topk")
def _(spark, sf):
    summed = _rounded(metrics.sum_by(_daily(spark, sf), ["eval_time", "metric", "instance"]), 2)
    return metrics.topk(summed, 10, ["eval_time"], ["metric", "instance"])


@query("metric_panel_sets")
def _(spark, sf):
    """Four panels of a dashboard in one pass over the daily values."""
    sets = {
        "by metric": ["eval_time", "metric"],
        "by instance": ["eval_time", "instance"],
        "by metric and env": ["eval_time", "metric", "env"],
        "all": ["eval_time"],
    }
    return _rounded(metrics.aggregate_sets(_daily(spark, sf), "sum", sets), 2)


@query("metric_label_values")
def _(spark, sf):
    return metrics.label_values(_samples(spark, sf), "instance", "click")


@query("metric_range_reduce")
def _(spark, sf):
    return metrics.range_reduce(_samples(spark, sf, "gap"), SERIES)


@query("metric_panel")
def _(spark, sf):
    return metrics.panel(_samples(spark, sf), ["click", "view", "error"], "instance", DAY)


# -- lifecycle -----------------------------------------------------------------------------


def _events(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf}/events.parquet")
    return rows.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "value")


@query("retention_7d")
def _(spark, sf):
    return lifecycle.within_retention(_events(spark, sf), "ts")


@query("tier_split")
def _(spark, sf):
    hot, cold = lifecycle.tier_split(_events(spark, sf), "ts", cooldown=86_400)
    return hot.withColumn("tier", F.lit("hot")).unionByName(
        cold.withColumn("tier", F.lit("cold"))
    )


def _event_table(spark: SparkSession, sf: str) -> UpsertTable:
    """Events by id and day, half of them still in the change log."""
    path = shared_dir(spark, "by-day")
    table = UpsertTable(spark, path, ["event_id", "ts"], buckets=2, day_column="ts")
    rows = _events(spark, sf)
    odd = F.col("event_id") % 2 == 1
    table.upsert(rows.filter(odd), 0)
    table.compact()
    table.upsert(rows.filter(~odd), 1)
    return table


@query("stored_days")
def _(spark, sf):
    """Five days of a keyed table: folders of other days are not read."""
    return _event_table(spark, sf).latest(days=(dt.date(2024, 1, 10), dt.date(2024, 1, 14)))


@query("stored_retention")
def _(spark, sf):
    """A keyed table after the days before the 15th were let go."""
    table = _event_table(spark, sf)
    table.retain(dt.date(2024, 1, 15))
    return table.latest()


@query("tiered_table")
def _(spark, sf):
    """Two appends, two moves and a purge; every remaining row with the place it is in."""
    path = shared_dir(spark, "tiered")
    table = TieredTable(spark, f"{path}/hot", f"{path}/cold", "ts")
    rows = _events(spark, sf)
    middle = dt.datetime(2024, 1, 15)
    table.append(rows.filter(F.col("ts") < F.lit(middle)))
    table.append(rows.filter(F.col("ts") >= F.lit(middle)))
    table.tier(dt.datetime(2024, 1, 10))
    table.tier(dt.datetime(2024, 1, 20))
    table.purge(dt.datetime(2024, 1, 5))
    return (
        table.hot()
        .withColumn("tier", F.lit("hot"))
        .unionByName(table.cold().withColumn("tier", F.lit("cold")))
    )


# -- ingest --------------------------------------------------------------------------------


@query("incremental_copy")
def _(spark, sf):
    """Orders copied in two steps: what was there at first, then the rest."""
    target = shared_dir(spark, "copy")
    orders = spark.read.parquet(f"{sf}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )
    half = orders.agg((F.max("o_orderkey") / 2).cast("bigint").alias("half")).first()["half"]
    ingest.incremental_copy(orders.filter(F.col("o_orderkey") <= half), "o_orderkey", target)
    ingest.incremental_copy(orders, "o_orderkey", target)
    ingest.incremental_copy(orders, "o_orderkey", target)  # nothing new
    return ingest.read_copy(spark, target)


@query("cdc_apply")
def _(spark, sf):
    rows = apply_cdc(customer_changes(spark, sf), ["c_custkey"], ["seq"])
    return rows.withColumn("c_acctbal", F.round("c_acctbal", 2))


@query("mock_readings")
def _(spark, sf):
    """One made-up record per event."""
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id")
    return ingest.mock_records(events, "event_id", ingest.READING_RULES, seed=7)


__all__ = ["CATALOG", "DAY", "PATIENT", "SERIES", "flagship"]
