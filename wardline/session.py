"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

#: State of any size: on local disk, with one bounded cache for all partitions of an executor.
_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # counting costs one more look-up for each row written
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def build_session(app: str = "wardline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on.

    The number of shuffle partitions is left to the cluster; adaptive execution merges small
    partitions and splits skewed ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.ansi.enabled": "true",
        # Recording the Python line of every column operation takes longer than planning.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # State of streams on local disk with logged changes, not on the heap.
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        **_REQUIRED,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session zone to UTC: all timestamps are zone-less UTC wall-clock times.

    The JVM does not compile methods of more than 8000 bytes, and a generated stage beyond that
    runs interpreted, five times slower; with the limit set Spark leaves such a stage to its
    operators one by one.
    """
    for key, value in _REQUIRED.items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started in here keep their state on local disk, whatever the session has; Spark's default is the heap."""
    before = {key: spark.conf.get(key, None) for key in _ON_DISK}
    for key, value in _ON_DISK.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's shared folder (``spark.checkpoint.dir``).

    Only a local session without that setting may use a temporary folder of the machine: on
    a cluster other hosts could not see it, and it is lost with its host.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="wardline-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
