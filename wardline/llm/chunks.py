"""Chunks of documents that can be visited again, and sets of hash values that travel packed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import arrow_map, as_bytes, rolling, slices, word_hashes

#: Bytes of text in a chunk, and rows.
CHUNK_BYTES = 8 << 20
CHUNK_ROWS = 1 << 14
BASE = 0x9E3779B97F4A7C15


class Words:
    """The words of a chunk's documents, one after the other."""

    def __init__(self, blob: bytes, lengths: list[int], lower: bool = False):
        text = zstandard.ZstdDecompressor().decompress(blob)
        text = text.lower() if lower else text
        self.words: list[bytes] = []
        begins, at = [0], 0
        for n in lengths:
            self.words += text[at : at + n].split()
            begins.append(len(self.words))
            at += n
        self.begins = np.array(begins)
        self.hashes = word_hashes(self.words)

    def runs(self, width: int, hashes: np.ndarray | None = None, base: int = BASE) -> np.ndarray:
        return rolling(self.hashes if hashes is None else hashes, width, base)

    def starts(self, width: int) -> np.ndarray:
        """Where a run of ``width`` words stands within one document."""
        n = len(self.words) - width + 1
        ok = np.ones(max(n, 0), bool)
        for d, b in enumerate(self.begins[1:]):
            ok[max(0, max(b - width + 1, self.begins[d])) : b] = False
        return ok

    def blocks(self, width: int) -> np.ndarray:
        """Where the non-overlapping blocks of each document begin."""
        parts = [np.arange(a, b - width + 1, width) for a, b in zip(self.begins, self.begins[1:])]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def pack(values: np.ndarray, *planes: bytes) -> tuple[int, bytes]:
    """Sorted distinct 64-bit values as the first and the differences, low bytes first; then more planes."""
    gaps = np.diff(values)
    width = max(1, -(-int(gaps.max(initial=0)).bit_length() // 8))
    low = gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return int(values[0]), bytes([width]) + low.tobytes() + b"".join(planes)


def unpack(first: int, n: int, data: bytes) -> tuple[np.ndarray, bytes]:
    width, m = data[0], n - 1
    raw = np.zeros((m, 8), np.uint8)
    raw[:, :width] = np.frombuffer(data, np.uint8, width * m, 1).reshape(width, m).T
    values = np.empty(n, np.uint64)
    values[0] = first
    with np.errstate(over="ignore"):
        np.cumsum(raw.view("<u8").ravel(), out=values[1:])
        values[1:] += np.uint64(first)
    return values, data[1 + width * m :]


def chunked(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(chunk, keys, lengths, blob)``: many documents a row, their texts (null: empty) compressed together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in slices(batches, "text", CHUNK_BYTES, CHUNK_ROWS):
            texts = as_bytes(batch.column("text"))
            packed = zstandard.ZstdCompressor(level=1).compress(b"".join(texts))
            keys = batch.column("key")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([chunk]),
                    pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                    pa.array([list(map(len, texts))], pa.list_(pa.int64())),
                    pa.array([packed], pa.binary()),
                ],
                ["chunk", "keys", "lengths", "blob"],
            )
            chunk += 1

    picked = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = dict(picked.dtypes)["key"]
    return arrow_map(picked, run, f"chunk long, keys array<{kind}>, lengths array<bigint>, blob binary")


def bucket_cuts(values: np.ndarray, bits: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each run of sorted values, and where the runs begin (one more at the end)."""
    top = values >> np.uint64(max(bits - 24, 0))
    bucket = (top * np.uint64(buckets)) >> np.uint64(min(bits, 24))
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    cuts = np.concatenate([[0], cuts, [len(values)]])
    return bucket[cuts[:-1]], cuts
