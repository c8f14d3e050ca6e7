"""Numbered state files: the commit point of tables made of plain Parquet folders.

A folder of data counts only once a state file names it. State files are written whole under
another name and renamed without overwriting, so of two writers only one gets a number, and
readers see the state before or after a commit and nothing in between.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession


class Versions:
    """The state files of one table, through Hadoop's file API (any store Spark can reach)."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._dir = f"{path.rstrip('/')}/_versions"

    def _path(self, name: str) -> Any:
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _fs(self) -> Any:
        return self._path(self._dir).getFileSystem(self._conf)

    def numbers(self) -> list[int]:
        """All committed version numbers, ascending."""
        fs, folder = self._fs(), self._path(self._dir)
        if not fs.exists(folder):
            return []
        names = (status.getPath().getName() for status in fs.listStatus(folder))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self) -> tuple[int, dict[str, Any]]:
        """The newest version and its state; version -1 and an empty state before any."""
        numbers = self.numbers()
        if not numbers:
            return -1, {}
        file = self._path(f"{self._dir}/{numbers[-1]:012d}.json")
        stream = self._fs().open(file)
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return numbers[-1], json.loads(text)

    def commit(self, after: int, state: dict[str, Any]) -> int:
        """Make ``state`` the version that follows ``after``; fails if another writer did."""
        fs = self._fs()
        draft = self._path(f"{self._dir}/.{uuid.uuid4().hex}.tmp")
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(state).encode()))
        finally:
            stream.close()
        keep = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self._gateway.new_array(keep, 1)
        options[0] = keep.NONE
        uri = fs.makeQualified(self._path(self._dir)).toUri()
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, self._conf)
        files.rename(draft, self._path(f"{self._dir}/{after + 1:012d}.json"), options)
        return after + 1

    def prune(self, keep: int = 10) -> None:
        """Delete all but the newest state files."""
        for number in self.numbers()[:-keep]:
            self.delete(f"{self._dir}/{number:012d}.json")

    def delete(self, folder: str) -> None:
        """Delete a folder or file."""
        self._fs().delete(self._path(folder), True)

    def folders(self, parent: str) -> list[str]:
        """The data folders directly below ``parent``."""
        fs, where = self._fs(), self._path(parent)
        if not fs.exists(where):
            return []
        return [s.getPath().toString() for s in fs.listStatus(where) if s.isDirectory()]
