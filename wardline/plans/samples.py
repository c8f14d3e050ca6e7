"""Inputs derived from the given tables for metric, change-log and ingest queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators.latest import DELETED


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gauge and counter samples of the whole ``events`` table, with labels as a map.

    ``counter`` grows with every event and starts over at 1000; ``gap`` is the value with one
    in five unknown.
    """
    e = F.col("event_id")
    user = F.col("user_id")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_type").alias("metric"),
        F.create_map(
            F.lit("instance"),
            F.concat(F.lit("i"), (user % 3).cast("string")),
            F.lit("env"),
            F.concat(F.lit("e"), (user % 2).cast("string")),
        ).alias("labels"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        "value",
        ((e * 3 + F.floor("value") % 3) % 1000).cast("double").alias("counter"),
        F.when(e % 5 != 0, F.col("value")).alias("gap"),
    )


def dirty(raw: DataFrame) -> DataFrame:
    """Raw readings with faults: text and NaN values, and missing measurement times."""
    kind, at = F.col("measurement_type"), F.col("measurement_timestamp")
    value = (
        F.when((kind == "HEART_RATE") & (F.second(at) % 20 == 5), F.lit("n/a"))
        .when((kind == "TEMPERATURE") & (F.second(at) % 20 == 10), F.lit("NaN"))
        .otherwise(F.col("raw_value"))
    )
    lost = (kind == "CONSCIOUSNESS") & (F.minute(at) % 30 == 7)
    return raw.withColumn("raw_value", value).withColumn(
        "measurement_timestamp", F.when(~lost, at)
    )


def keyed_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a change log by customer: each order updates its customer's last order.

    A finished order removes the customer until the next one. ``position`` orders the log.
    """
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_custkey").alias("customer"),
        F.col("o_orderkey").alias("order_key"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("ordered_at"),
        (F.col("o_orderstatus") == "F").alias(DELETED),
        F.col("o_orderkey").alias("position"),
    )


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change events of the customer table: a snapshot, some updates, some deletes."""
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment"
    )
    now = F.struct(*rows.columns)
    raised = F.struct(
        "c_custkey", "c_name", (F.col("c_acctbal") + 100).alias("c_acctbal"), "c_mktsegment"
    )
    none = F.lit(None).cast(rows.select(now.alias("x")).schema["x"].dataType)
    third, seventh = F.col("c_custkey") % 3 == 0, F.col("c_custkey") % 7 == 0

    def event(op: str, before: object, after: object, seq: int) -> object:
        return F.struct(
            F.lit(op).alias("op"),
            before.alias("before"),
            after.alias("after"),
            F.lit(seq).alias("seq"),
        )

    events = F.array_compact(
        F.array(
            event("r", none, now, 0),
            F.when(third, event("u", now, raised, 1)),
            F.when(seventh, event("d", now, none, 2)),
        )
    )
    return rows.select(F.inline(events))
