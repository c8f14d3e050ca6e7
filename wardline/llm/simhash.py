"""SimHash near-duplicates: fingerprints, and all close pairs by a vantage-point tree.

A level of the tree measures the Hamming distance to a vantage point within one slice of the
bits. Slices are disjoint, so the distances of a pair differ, summed over the levels, by no more
than the pair's own distance: a branch is pruned as soon as the levels above have used up the
search radius. The first levels are shards that Spark deals out, each fingerprint being a member
of one shard and a query in the neighbouring ones that the bounds leave; the levels below run
inside a shard's task, down to small blocks that are compared bit by bit.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import arrow_map, as_bytes, slices, table, written
from wardline.llm.components import connected

SEED = 42
#: Pairs that are compared bit by bit at once.
BLOCK_PAIRS = 1 << 22
_MASK = (1 << 64) - 1


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of the word shingles, repeats included; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        digest = xxhash.xxh64_intdigest
        begins = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=begins[1:])
        ends = (begins[shingle:] - 1).tolist()
        hashes = [digest(joined[a:b], SEED) for a, b in zip(begins.tolist(), ends)]
    counts = np.zeros(64, np.int64)
    values = np.array(hashes, dtype="<u8")
    for i in range(0, len(values), 1 << 15):
        bits = np.unpackbits(values[i : i + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    top = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(top.view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """``(key, fp)`` for every row, ``fp`` a long with the fingerprint's bits; null text is 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = np.array([fingerprint(t, shingle) for t in as_bytes(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_pydict({"key": batch.column("key"), "fp": found.view(np.int64)})

    picked = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = dict(picked.dtypes)["key"]
    return arrow_map(picked, run, f"key {kind}, fp long").withColumnRenamed("key", key)


def slice_masks(n: int) -> list[int]:
    """The 64 bits in ``n`` disjoint slices of about the same width."""
    cuts = [64 * i // n for i in range(n + 1)]
    return [((1 << b) - (1 << a)) & _MASK for a, b in zip(cuts, cuts[1:])]


def levels_for(rows: int, shard_rows: int = 20_000) -> int:
    """Levels that are dealt out: distances in ``n`` slices make about (64 pi / n)^(n/2) shards."""
    n = 3
    while n < 12 and (64 * math.pi / n) ** (n / 2) * shard_rows < rows:
        n += 1
    return n


def offsets(levels: int, radius: int) -> list[tuple[int, ...]]:
    """How a query's shard may differ from a member's; of each two opposite ones the first."""
    found: list[tuple[int, ...]] = [()]
    for _ in range(levels):
        found = [(*o, d) for o in found for d in range(-radius, radius + 1) if sum(map(abs, o)) + abs(d) <= radius]
    return [o for o in found if o >= (0,) * levels]


def _distance(fp: Column, vantage: int, mask: int) -> Column:
    signed = lambda v: F.lit(v - (1 << 64) if v >> 63 else v)
    return F.bit_count(fp.bitwiseXOR(signed(vantage)).bitwiseAND(signed(mask))).cast("long")


def _within(
    members: np.ndarray, queries: np.ndarray, left: np.ndarray, levels: list[tuple[int, int]], found: Callable
) -> None:
    """Report blocks of (members, queries) that may be close; ``left``: what remains of each query's radius."""
    if not len(members) or not len(queries):
        return
    if len(members) * len(queries) <= BLOCK_PAIRS or not levels:
        step = max(1, BLOCK_PAIRS // max(1, len(members)))
        for i in range(0, len(queries), step):
            for j in range(0, len(members), BLOCK_PAIRS):
                found(members[j : j + BLOCK_PAIRS], queries[i : i + step])
        return
    vantage, mask = levels[0]
    own = np.bitwise_count((members ^ np.uint64(vantage)) & np.uint64(mask)).astype(np.int16)
    other = np.bitwise_count((queries ^ np.uint64(vantage)) & np.uint64(mask)).astype(np.int16)
    for d in np.unique(own):
        gap = np.abs(other - d)
        near = gap <= left
        _within(members[own == d], queries[near], (left - gap)[near], levels[1:], found)


def _shard_links(members: np.ndarray, queries: np.ndarray, radius: int, levels: list[tuple[int, int]]) -> np.ndarray:
    """Links of one shard as a forest: each node with the root of its group, not all pairs."""
    nodes = np.unique(np.concatenate([members, queries]))
    label = np.arange(len(nodes))

    def found(a: np.ndarray, b: np.ndarray) -> None:
        nonlocal label
        i, j = np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= radius)
        if not len(i):
            return
        x, y = np.searchsorted(nodes, a[i]), np.searchsorted(nodes, b[j])
        while True:
            low = np.minimum(label[x], label[y])
            if (label[x] == label[y]).all():
                break
            roots = np.concatenate([label[x], label[y]])
            np.minimum.at(label, roots, np.concatenate([low, low]))
            label = label[label]
            while (label != label[label]).any():
                label = label[label]

    everyone = np.concatenate([members, queries])
    _within(members, everyone, np.full(len(everyone), radius, np.int16), levels, found)
    moved = label != np.arange(len(nodes))
    return np.stack([nodes[moved], nodes[label[moved]]], axis=1)


def close_links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """``(fp)`` distinct longs -> links ``(a, b)`` that connect all pairs at ``radius`` or less.

    Within a shard the links are a forest, so a dense group gives as many links as members, not
    as many as pairs; across shards every close pair is met in the member's shard.
    """
    sample = [r[0] & _MASK for r in distinct.orderBy(F.xxhash64("fp")).limit(16).collect()]
    if not sample:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    depth = levels_for(distinct.count())
    outer = [(sample[i % len(sample)], m) for i, m in enumerate(slice_masks(depth))]
    inner = [(sample[(i + 5) % len(sample)], m) for i, m in enumerate(slice_masks(8))]
    fp = F.col("fp")
    at = [_distance(fp, v, m) + radius for v, m in outer]

    def shard(offset: tuple[int, ...]) -> Column:
        parts = zip(at, offset)
        return sum(((d + o) * F.lit(128**i) for i, (d, o) in enumerate(parts)), F.lit(0).cast("long"))

    visits = F.array(
        *(F.struct(shard(o).alias("shard"), F.lit(any(o)).alias("query")) for o in offsets(depth, radius))
    )
    dealt = (
        distinct.select("fp", F.explode(visits).alias("v"))
        .select("fp", "v.shard", "v.query")
        .repartition("shard")
        .sortWithinPartitions("shard")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        current = None

        def close() -> Iterator[pa.RecordBatch]:
            fps, query = (np.concatenate(x) for x in zip(*held))
            if not query.all():
                links = _shard_links(fps[~query], fps[query], radius, inner).view(np.int64)
                if len(links):
                    yield pa.RecordBatch.from_pydict({"a": links[:, 0], "b": links[:, 1]})

        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column("shard").to_numpy()
            fps = batch.column("fp").to_numpy().view(np.uint64)
            query = batch.column("query").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(key)) + 1), len(key)]
            for a, b in zip(cuts, cuts[1:]):
                if held and key[a] != current:
                    yield from close()
                    held = []
                current = key[a]
                held.append((fps[a:b], query[a:b]))
        if held:
            yield from close()

    return arrow_map(dealt, run, "a long, b long")


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """``(key, fp, group)`` for every row: the smallest key reachable over links of ``radius`` or less.

    Equal fingerprints meet before anything is compared, so a group of copies of any size costs
    one comparison partner. Null texts and texts without words have fingerprint 0. Null keys stay,
    but name no group unless it has no other key. An empty table gives no rows.
    """
    marked = written(fingerprints(docs, key, text, shingle), "fingerprints")
    least = written(marked.groupBy("fp").agg(F.min(key).alias("least")), "fingerprint-least")
    roots = connected(close_links(least.select("fp"), radius))
    rooted = least.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("group"))
    groups = rooted.join(named, "root").select("fp", "group")
    return marked.join(groups, "fp").select(key, "fp", "group")


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and the smallest doc_id reachable over near copies."""
    found = near_groups(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("group").alias("component_id"),
    )
