"""Tables hashed by a key when they are written, so that queries by that key need no exchange."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.vitals import BUCKETS


def save_bucketed(
    rows: DataFrame,
    name: str,
    key: str,
    buckets: int = BUCKETS,
    sort_by: Sequence[str] = (),
    path: str | None = None,
) -> DataFrame:
    """Write a catalog table in ``buckets`` buckets by the hash of ``key``, and give it back.

    One exchange now, by the buckets' own hash, makes one file per bucket; aggregates and joins by the key
    read it as it lies, and a look-up of one key reads one bucket. Without ``path`` it lies in the warehouse. Take as many buckets as a day's tasks; a
    key with a great share of the rows makes its bucket long, and is better left to ``PartitionedTable``.
    """
    writer = (
        rows.repartition(buckets, key)
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key, *sort_by)
        .format("parquet")
    )
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return rows.sparkSession.table(name)


def new_name(prefix: str = "wardline") -> str:
    return f"{prefix}_{uuid.uuid4().hex}"


def file_bucket() -> Column:
    """The bucket that the file of a row belongs to, by the file's name."""
    return F.regexp_extract(F.col("_metadata.file_name"), r"_(\d+)(?:\..*)?$", 1).cast("int")


def drop(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
