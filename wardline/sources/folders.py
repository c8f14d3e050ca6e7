"""Folders of any store that Spark can reach, through Hadoop's file API."""

from __future__ import annotations

from typing import Any

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str) -> tuple[Any, Any]:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    fs, place = _at(spark, path)
    fs.delete(place, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """The names of what lies directly below a folder, in order; none if there is no such folder."""
    fs, place = _at(spark, path)
    if not fs.exists(place):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(place))


def files(spark: SparkSession, path: str, ending: str) -> list[tuple[str, int]]:
    """All files below a folder whose names end so, as Spark writes their paths, with their times in milliseconds."""
    fs, place = _at(spark, path)
    found, each = [], fs.listFiles(place, True)
    while each.hasNext():
        status = each.next()
        if status.getPath().getName().endswith(ending):
            uri = status.getPath().toUri().toString()
            if uri.startswith("file:/") and not uri.startswith("file:///"):
                uri = "file://" + uri.removeprefix("file:")
            found.append((uri, status.getModificationTime()))
    return found
