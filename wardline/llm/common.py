"""Helpers the operators share: bounded slices of text, written intermediate tables, word hashes."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.session import shared_dir

#: Bytes of text, and documents, that one step inside a Python task handles at once.
SLICE_BYTES = 4 << 20
SLICE_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_map(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` whose workers can import this package, wherever they run."""
    context = df.sparkSession.sparkContext
    if not getattr(context, "_wardline_shipped", False):
        top = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="wardline-")) / f"{top.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(top.rglob("*.py")):
                out.write(source, source.relative_to(top.parent))
        context.addPyFile(str(archive))
        context._wardline_shipped = True
    return df.mapInArrow(run, schema)


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Cut the lineage: write to the cluster's shared folder and read the files back."""
    path = shared_dir(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(
    batches: Iterable[pa.RecordBatch], column: str, size: int = SLICE_BYTES, rows: int = SLICE_ROWS
) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a slice holds ``size`` bytes of ``column`` plus one value at most."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < n:
            done = ends[begin - 1] if begin else 0
            stop = int(np.searchsorted(ends, done + size, side="right"))
            stop = min(max(stop, begin + 1), begin + rows, n)
            yield batch.slice(begin, stop - begin)
            begin = stop


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return pc.fill_null(column.cast(pa.binary()), b"").to_pylist()


def as_text(column: pa.Array) -> list[str]:
    return pc.fill_null(column, "").to_pylist()


class WordHashes(dict):
    """XXH64 by word, computed once for each; forgets all when it holds ``limit`` words."""

    def __init__(self, limit: int = 400_000):
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_HASHES = WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return _HASHES.array(words)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on all bits."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x9E3779B97F4A7C15)
    values = values ^ (values >> np.uint64(29))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def rolling(hashes: np.ndarray, width: int, base: int) -> np.ndarray:
    """Hash of every run of ``width`` values, by doubling: about log2(width) passes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, span, run = np.uint64(base), 1, hashes
    result, covered = None, 0
    with np.errstate(over="ignore"):
        while True:
            if width & span:
                if result is None:
                    result, covered = run, span
                else:
                    # result covers the first words, run follows it
                    m = min(len(result), len(run) - covered)
                    result = result[:m] * power + run[covered : covered + m]
                    covered += span
            if span * 2 > width:
                break
            m = len(run) - span
            run = run[:m] * power + run[span : span + m]
            power = power * power
            span *= 2
        return mixed(result[:n])


def unsigned_crc32_mod(column, modulus: int):
    """crc32 of a column as text, modulo ``modulus``; null counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)
