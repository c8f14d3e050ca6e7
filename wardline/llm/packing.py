"""Hierarchical packing of documents into sequences of several lengths.

A document's ids fill whole windows of the largest size first; what is left is routed to the
smallest tier that holds it. Windows of the largest tier are opened by its own pieces, longest
first, and their gaps filled from the shorter tiers, best fit first and the last piece cut to
measure. What then remains of a shorter tier fills windows of its own size in the same way.
Windows that are not full go on to the next round of the task, so that only a task's last few
windows are padded. Full windows of one length are dealt out to step groups of equal token
counts, costly windows (few long pieces) evenly among the groups of a round.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import arrow_map, as_text, slices, table
from wardline.llm.tokens import ids_of

SIZES = (256, 512, 1024, 2048)
#: Ids that a task holds before it packs a round.
ROUND_IDS = 1 << 22
STEP_IDS = 1 << 16
END = 1


class Pool:
    """Pieces ``(length, document, start)`` of one tier, in order of length."""

    def __init__(self):
        self.pieces: list[tuple[int, int, int]] = []

    def add(self, piece: tuple[int, int, int]) -> None:
        insort(self.pieces, piece)

    def fitting(self, room: int) -> tuple[int, int, int] | None:
        """The longest piece of at most ``room`` ids."""
        at = bisect_right(self.pieces, (room, 1 << 62, 0))
        return self.pieces.pop(at - 1) if at else None


def tier_of(length: int, sizes: tuple[int, ...]) -> int:
    return next(i for i, s in enumerate(sizes) if length <= s)


def pack_round(lengths: list[int], sizes: tuple[int, ...], last: bool) -> tuple[list[tuple[int, list]], list]:
    """Pack documents of these lengths: ``[(window size, [(document, start, length)])]`` and what is left.

    All windows are full, unless ``last``, when the rest is padded in the smallest window that
    holds it; else the rest is given back as ``(document, start, length)``.
    """
    largest = sizes[-1]
    windows: list[tuple[int, list]] = []
    pools = [Pool() for _ in sizes]
    for d, n in enumerate(lengths):
        whole = n // largest * largest
        windows += [(largest, [(d, s, largest)]) for s in range(0, whole, largest)]
        if n > whole:
            pools[tier_of(n - whole, sizes)].pieces.append((n - whole, d, whole))
    for p in pools:
        p.pieces.sort()

    def put_back(length: int, d: int, start: int) -> None:
        pools[tier_of(length, sizes)].add((length, d, start))

    def fill(size: int, tier: int) -> list | None:
        """A full window opened by the tier's longest piece; None if all the pools can't fill it."""
        window, room = [], size
        length, d, start = pools[tier].pieces.pop()
        window.append((d, start, length))
        room -= length
        for t in [*range(tier, -1, -1)]:
            while room and (piece := pools[t].fitting(room)):
                window.append((piece[1], piece[2], piece[0]))
                room -= piece[0]
        if room:  # no piece is short enough: cut one
            source = next((pools[t] for t in range(tier + 1) if pools[t].pieces), None)
            if source is None:
                for d, start, length in window:
                    put_back(length, d, start)
                return None
            length, d, start = source.pieces.pop(0)
            window.append((d, start, room))
            put_back(length - room, d, start + room)
        return window

    for tier in range(len(sizes) - 1, -1, -1):
        size = sizes[tier]
        while pools[tier].pieces:
            window = fill(size, tier)
            if window is None:
                break
            windows.append((size, window))
    rest = [(d, start, length) for p in pools for length, d, start in reversed(p.pieces)]
    if not last:
        return windows, rest
    while rest:
        window, room = [], largest
        while rest and room:
            d, start, length = rest.pop(0)
            take = min(length, room)
            window.append((d, start, take))
            room -= take
            if take < length:
                rest.insert(0, (d, start + take, length - take))
        used = largest - room
        windows.append((next(s for s in sizes if used <= s), window))
    return windows, []


def step_groups(windows: list[tuple[int, list]], step_ids: int) -> list[int]:
    """A group for each window: windows of one size, ``step_ids`` ids in all, the costly ones spread."""
    out = [0] * len(windows)
    base = 0
    for size in sorted({s for s, _ in windows}):
        own = [i for i, (s, _) in enumerate(windows) if s == size]
        own.sort(key=lambda i: -sum(n * n for _, _, n in windows[i][1]))
        groups = -(-len(own) * size // step_ids)
        for k, i in enumerate(own):  # there and back again, so that sums of costs stay close
            lap, at = divmod(k, groups)
            out[i] = base + (at if lap % 2 == 0 else groups - 1 - at)
        base += groups
    return out


SCHEMA = (
    "doc_tokens long, start long, length long, ids binary, sequence_id long, offset long, "
    "sequence_size long, step_group long"
)


def packed(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    sizes: tuple[int, ...] = SIZES,
    round_ids: int = ROUND_IDS,
    step_ids: int = STEP_IDS,
) -> DataFrame:
    """One row per piece: its place in its document and in its sequence, and its ids (packed uint32).

    Every row of ``docs`` is a document of its own, also with a key that is null or repeated; a
    null or empty text is its end id alone. The key's column comes first, under its own name.
    No shuffle: each task packs what it reads, in rounds of a bounded number of ids. Sequence and
    step numbers are unique: the task's number, then a count.
    """
    path = vocabulary or public_tokenizers.path("word_bpe_49k.json")
    end = np.array([END], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = ids_of(path, True, "<u4")
        base = TaskContext.get().partitionId() << 40
        held: list[tuple] = []  # key, ids, start of these ids, ids of the whole document
        sequences = steps = size = 0

        def pack(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, sequences, steps, size
            windows, rest = pack_round([len(ids) // 4 for _, ids, _, _ in held], sizes, last)
            groups = step_groups(windows, step_ids)
            rows: list[list] = [[] for _ in range(9)]
            for k, (room, window) in enumerate(windows):
                offset = 0
                for d, start, length in window:
                    name, ids, first, whole = held[d]
                    cells = (name, whole, first + start, length, ids[4 * start : 4 * (start + length)])
                    places = (base + sequences + k, offset, room, base + steps + groups[k])
                    for column, cell in zip(rows, (*cells, *places)):
                        column.append(cell)
                    offset += length
            sequences += len(windows)
            steps += max(groups, default=-1) + 1
            held = [
                (held[d][0], held[d][1][4 * s : 4 * (s + n)], held[d][2] + s, held[d][3]) for d, s, n in sorted(rest)
            ]
            size = sum(len(h[1]) // 4 for h in held)
            names = ["key", *(x.split()[0] for x in SCHEMA.split(", "))]
            kinds = [key_type, pa.int64(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 4]
            for i in range(0, len(rows[0]), 2000):
                yield pa.RecordBatch.from_arrays([pa.array(r[i : i + 2000], t) for r, t in zip(rows, kinds)], names)

        key_type = None
        try:
            for batch in slices(batches, "text"):
                key_type = batch.schema.field("key").type
                for name, value in zip(batch.column("key").to_pylist(), as_text(batch.column("text"))):
                    ids = packer.text(value) + end
                    held.append((name, ids, 0, len(ids) // 4))
                    size += len(ids) // 4
                if size >= round_ids:
                    yield from pack(False)
            if held:
                yield from pack(True)
        finally:
            packer.forget()

    picked = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = dict(picked.dtypes)["key"]
    return arrow_map(picked, run, f"key {kind}, {SCHEMA}").withColumnRenamed("key", key)


def with_digests(pieces: DataFrame) -> DataFrame:
    """The pieces with ``ids_crc32`` in place of the ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return with_digests(packed(table(spark, sf_dir, "documents")))
