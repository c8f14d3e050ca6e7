"""Topics: JSON rows on Kafka or in folders of JSON files.

A Kafka source or sink moves frames ``(key, value, timestamp)``. Coding and decoding of frames
are plain column expressions, so they work the same on any DataFrame of that shape.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wardline.functions import ntz
from wardline.operators.latest import DELETED, latest_per_key
from wardline.schemas import RAW_PAYLOAD, event_time
from wardline.vitals import TOPIC_PARTITIONS

# Time formats on the wire: append topics use ISO-8601, keyed topics the SQL form.
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSS"
SQL = "yyyy-MM-dd HH:mm:ss.SSS"
_TIMES = ("timestamp", "timestamp_ntz")


def _wire(schema: T.StructType) -> T.StructType:
    """The schema with times as strings: their format is read by us, not guessed."""
    return T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.dataType.typeName() in _TIMES else f.dataType)
            for f in schema
        ]
    )


def _read_time(text: Column, kind: T.DataType) -> Column:
    """A time in ISO or SQL form, with or without fraction, cut to milliseconds.

    A zone suffix is converted to UTC wall-clock time: a plain cast to a zone-less time would
    give NULL for a trailing ``Z`` without a word.
    """
    return F.date_trunc("millisecond", text.cast("timestamp")).cast(kind)


def _write_times(df: DataFrame, columns: Sequence[str], style: str) -> list[Column]:
    times = {f.name for f in df.schema if f.dataType.typeName() in _TIMES}
    return [
        F.date_format(F.col(c), style).alias(c) if c in times else F.col(c) for c in columns
    ]


def encode_append(df: DataFrame, schema: T.StructType, record_time: str) -> DataFrame:
    """Frames of an append topic: no key, JSON value, the record time beside it."""
    columns = [c for c in schema.names if c != record_time]
    value = F.to_json(F.struct(*_write_times(df, columns, ISO)), {"ignoreNullFields": "false"})
    return df.select(
        F.lit(None).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.col(record_time).cast("timestamp").alias("timestamp"),
    )


def decode_append(
    frames: DataFrame, schema: T.StructType, record_time: str, on_bad: str = "fail"
) -> DataFrame:
    """Rows of an append topic; the record time becomes the named column.

    ``schema`` is that of the result. A value that is no JSON fails the job, or with
    ``on_bad="null"`` gives a row without fields.
    """
    payload = T.StructType([f for f in schema if f.name != record_time])
    mode = {"mode": "FAILFAST" if on_bad == "fail" else "PERMISSIVE"}
    rows = frames.select(
        F.from_json(F.col("value").cast("string"), _wire(payload), mode).alias("row"),
        F.col("timestamp").alias("record_time"),
    )
    columns = []
    for f in schema:
        if f.name == record_time:
            columns.append(F.col("record_time").cast(f.dataType).alias(f.name))
        elif f.dataType.typeName() in _TIMES:
            columns.append(_read_time(F.col(f"row.{f.name}"), f.dataType).alias(f.name))
        else:
            columns.append(F.col(f"row.{f.name}").alias(f.name))
    return rows.select(*columns)


def encode_upsert(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Frames of a keyed topic: JSON key and value; a ``_deleted`` row gets a null value.

    ``order`` is the column that becomes the position of the frame in its topic.
    """
    columns = [c for c in df.columns if c not in (DELETED, order)]
    value = F.to_json(F.struct(*_write_times(df, columns, SQL)), {"ignoreNullFields": "false"})
    if DELETED in df.columns:
        value = F.when(~F.col(DELETED), value)
    return df.select(
        F.to_json(F.struct(*_write_times(df, keys, SQL))).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.col(order).cast("bigint").alias("offset"),
    )


def decode_upsert(frames: DataFrame, schema: T.StructType) -> DataFrame:
    """The current rows of a keyed topic: last value per key, keys with a null value gone.

    All frames of one key lie in one partition of the topic, so their offsets order them. The
    frames are merged before any JSON is read.
    """
    last = latest_per_key(frames.select("key", "value", "offset"), ["key"], ["offset"])
    alive = last.filter(F.col("value").isNotNull())
    return alive.select(_parsed("value", schema).alias("row")).select(*_fields("row", schema))


def decode_changes(frames: DataFrame, keys: Sequence[str], schema: T.StructType) -> DataFrame:
    """Every frame of a keyed topic as a change: the columns of ``schema``, ``_deleted``, ``offset``.

    A null value deletes its key, whose columns come from the frame's key. Row by row, so it works
    on streams; ``UpsertTable.upsert`` takes the changes, ordered by ``offset``.
    """
    of_key = T.StructType([f for f in schema if f.name in keys])
    rest = T.StructType([f for f in schema if f.name not in keys])
    rows = frames.select(
        _parsed("key", of_key).alias("of_key"),
        _parsed("value", rest).alias("row"),
        F.col("value").isNull().alias(DELETED),
        "offset",
    )
    return rows.select(*_fields("of_key", of_key), *_fields("row", rest), DELETED, "offset")


def _parsed(column: str, schema: T.StructType) -> Column:
    return F.from_json(F.col(column).cast("string"), _wire(schema), {"mode": "FAILFAST"})


def _fields(row: str, schema: T.StructType) -> list[Column]:
    return [
        _read_time(F.col(f"{row}.{f.name}"), f.dataType).alias(f.name)
        if f.dataType.typeName() in _TIMES
        else F.col(f"{row}.{f.name}").alias(f.name)
        for f in schema
    ]


def read_kafka(spark: SparkSession, servers: str, topic: str, start: str = "latest") -> DataFrame:
    """A stream of frames from Kafka; by default only what arrives from now on.

    Needs Spark's Kafka package on the class path.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", start)
        .load()
    )


def read_kafka_so_far(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """The frames a Kafka topic holds now, as a batch. Needs Spark's Kafka package on the class path."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("endingOffsets", "latest")
        .load()
    )


def write_kafka(frames: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Send a stream of frames to Kafka; frames without a key go to any partition.

    Kafka may see a frame twice after a failure; keyed topics are read by last value, so only
    append topics notice. Needs Spark's Kafka package on the class path.
    """
    return (
        frames.select("key", "value")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def read_json_folder(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW_PAYLOAD,
    record_time: str = "ingestion_timestamp",
    start_after: str | None = None,
    files_per_batch: int | None = None,
    streaming: bool = True,
    archive: str | None = None,
) -> DataFrame:
    """A stream (or batch) of JSON rows from a folder, one row per line, with a fixed schema.

    Producers must move whole files in: a file listed while it is being written is read as it is
    then and never again.

    The record time is a field of the rows if they have one, else the time the file was
    written. ``start_after`` leaves out files written up to that time: the file version of
    starting at the latest offset. Keep the time with the checkpoint, so that a restart uses
    the same one.

    A stream moves files it has consumed to ``archive``, a folder outside ``path``, so that the folder does not
    grow and is listed in constant time; one stream per folder then.
    """
    fields = [f for f in schema if f.name != record_time]
    wire = _wire(T.StructType([*fields, T.StructField(record_time, T.StringType())]))
    reader = (spark.readStream if streaming else spark.read).schema(wire)
    reader = reader.option("mode", "FAILFAST")
    if streaming and files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if streaming and archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    written = F.col("_metadata.file_modification_time")
    rows = reader.json(path)
    if start_after is not None:
        rows = rows.filter(written > F.lit(start_after).cast("timestamp"))
    kinds = {f.name: f.dataType for f in event_time(schema, "measurement_timestamp")}
    recorded = F.coalesce(
        _read_time(F.col(record_time), T.TimestampType()), F.date_trunc("millisecond", written)
    )
    return rows.select(
        *(
            _read_time(F.col(f.name), kinds[f.name]).alias(f.name)
            if f.dataType.typeName() in _TIMES
            else F.col(f.name)
            for f in fields
        ),
        ntz(recorded).alias(record_time),
    )


#: What a reading is known by, however often it is sent.
RECORD_ID = ("device_id", "measurement_timestamp", "measurement_type", "raw_value")


def without_repeats(
    rows: DataFrame, within: str, record_id: Sequence[str] = RECORD_ID, record_time: str = "ingestion_timestamp"
) -> DataFrame:
    """Each record once, though an at-least-once producer sent it again.

    On a stream a record is remembered until the newest record time is ``within`` past its own, and rows that
    come later than that are dropped; so state is what arrives in that time, and a repeat is known if it
    comes within it. Which of the repeats stays is not fixed. On a batch all repeats go.
    """
    if not rows.isStreaming:
        return rows.dropDuplicates(list(record_id))
    kind = rows.schema[record_time].dataType
    timed = rows.withColumn("_record_time", F.col(record_time).cast("timestamp")).withWatermark("_record_time", within)
    return timed.dropDuplicatesWithinWatermark(list(record_id)).select(
        *(F.col(c).cast(kind).alias(c) if c == record_time else c for c in rows.columns)
    )


def topic_layout(df: DataFrame, partitions: int = TOPIC_PARTITIONS) -> DataFrame:
    """Deal rows out to a fixed number of partitions, in no order; for small topics only."""
    return df.repartition(partitions)
