"""Exact substring deduplication by fixed-block anchors.

Of every document the non-overlapping blocks of half a window are the reference index; every
rolling run of a block's length probes it. A repeat of a whole window always holds a full block of
each of its two places, so a window can only be repeated if the block of its own document inside it
was met by another probe. Such hits are extended word by word to all windows around the block,
and those that were reached from two places are repeats; overlapping ones make maximal repeats.

Probes travel as sorted sets per chunk of documents and bucket of hash values, so a passage that
thousands of documents share is one entry per chunk. Probe hashes are shortened to what the number
of probes needs (a false hit costs a few more windows to extend and is dropped there); windows
are compared by 96 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.chunks import Words, bucket_cuts, chunked, pack, unpack
from wardline.llm.common import arrow_map, mixed, table, written

WINDOW = 35
#: Entries that one bucket's group holds in memory, about.
BUCKET_ENTRIES = 4_000_000
_SECOND = 0xD6E8FEB86659FD93
_SETS = "bucket long, chunk long, first decimal(20,0), n long, data binary"


def _bits(n: int) -> int:
    return -(-n // 8)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.decimal128(20, 0), pa.int64(), pa.binary()]
    columns = list(zip(*((b, c, Decimal(f), n, d) for b, c, f, n, d in rows)))
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds)], ["bucket", "chunk", "first", "n", "data"])


def _repeated(sets: DataFrame, extra: bool) -> DataFrame:
    """Of each bucket's sets the marked values that are in two sets, or twice in one; by chunk."""

    def group(t: pa.Table) -> pa.Table:
        rows = list(zip(*(t.column(c).to_pylist() for c in ("chunk", "first", "n", "data"))))
        values, seconds, twice, mine = [], [], [], []
        for _, first, n, data in rows:
            v, rest = unpack(int(first), n, data)
            values.append(v)
            k = _bits(n)
            twice.append(np.unpackbits(np.frombuffer(rest, np.uint8, k), count=n).astype(bool))
            mine.append(np.unpackbits(np.frombuffer(rest, np.uint8, k, k), count=n).astype(bool))
            if extra:
                seconds.append(np.frombuffer(rest, np.uint32, n, 2 * k))
        v, many, own = np.concatenate(values), np.concatenate(twice), np.concatenate(mine)
        owner = np.repeat(np.arange(len(rows)), [r[2] for r in rows])
        if extra:
            second = np.concatenate(seconds)
            order = np.lexsort((second, v))
            new = (np.diff(v[order]) != 0) | (np.diff(second[order]) != 0)
        else:
            order = np.argsort(v, kind="stable")
            new = np.diff(v[order]) != 0
        begins = np.concatenate([[0], np.flatnonzero(new) + 1])
        size = np.diff(np.concatenate([begins, [len(v)]]))
        again = (size > 1) | (np.add.reduceat(many[order].astype(np.int64), begins) > 0)
        hit = np.zeros(len(v), bool)
        hit[order] = np.repeat(again, size)
        hit &= own
        out = []
        at = np.flatnonzero(hit)  # by owner, values ascending
        cuts = np.searchsorted(owner[at], np.arange(len(rows) + 1))
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if b > a:
                first, data = pack(v[at[a:b]])
                out.append((0, rows[i][0], first, int(b - a), data))
        return pa.Table.from_batches([_batch(out)] if out else [], _EMPTY)

    return sets.groupBy("bucket").applyInArrow(group, _SETS)


_EMPTY = pa.schema(
    [("bucket", pa.int64()), ("chunk", pa.int64()), ("first", pa.decimal128(20, 0)), ("n", pa.int64()), ("data", pa.binary())]
)


def _with_hits(chunks: DataFrame, hits: DataFrame) -> DataFrame:
    found = hits.groupBy("chunk").agg(F.collect_list(F.struct("first", "n", "data")).alias("hits"))
    return chunks.join(found, "chunk", "left")


def _values(hits: list[dict] | None) -> np.ndarray:
    parts = [unpack(int(h["first"]), h["n"], h["data"])[0] for h in hits or []]
    return np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def _in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return known[at] == values


def _emit(chunk: int, values: np.ndarray, own: np.ndarray | None, second: np.ndarray | None, bits: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """A chunk's values as sets by bucket, each with what is twice in the chunk and what is marked as its own."""
    order = np.argsort(values, kind="stable")
    v = values[order]
    begins = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
    v, count = v[begins], np.diff(np.concatenate([begins, [len(v)]]))
    mine = np.ones(len(v), bool) if own is None else _in(v, own)
    bucket, cuts = bucket_cuts(v, bits, buckets)
    second = None if second is None else second[order][begins]
    rows = []
    for k, a, b in zip(bucket.tolist(), cuts.tolist(), cuts[1:].tolist()):
        planes = [np.packbits(count[a:b] > 1).tobytes(), np.packbits(mine[a:b]).tobytes()]
        if second is not None:
            planes.append(second[a:b].tobytes())
        first, data = pack(v[a:b], *planes)
        rows.append((k, chunk, first, b - a, data))
    yield _batch(rows)


def _extendable(words: Words, hits: np.ndarray, bits: int, block: int, window: int) -> np.ndarray:
    """Windows that hold a block of their own document which other probes met."""
    at = words.blocks(block)
    runs = words.runs(block) >> np.uint64(64 - bits)
    at = at[_in(runs[at], hits)]
    ok = words.starts(window)
    reach = np.zeros(len(words.words) + 2, np.int64)
    np.add.at(reach, np.maximum(at - (window - block), 0), 1)
    np.add.at(reach, at + 1, -1)
    return np.flatnonzero((np.cumsum(reach)[: len(ok)] > 0) & ok)


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``(key, n_words, n_removed, kept, removed)`` for every row of ``docs``.

    Words are runs of other bytes than ASCII white space. A word is removed if some window of
    ``window`` consecutive words of its document that covers it also starts anywhere else, in the same
    document too, judged on the input. ``kept`` has the other words joined by one blank, ``removed``
    the word ranges ``[begin, end)`` that went. Every row is a document, also with a null or repeated
    key; null texts have no words. Other columns are ignored.
    """
    spark, block = docs.sparkSession, (window + 1) // 2
    kind = dict(docs.select(F.col(key).alias("key")).dtypes)["key"]
    chunks = written(chunked(docs, key, text), "chunks", "uncompressed")
    # a word has at least two bytes with the blank after it
    most = chunks.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n))).first()[0] or 0
    bits = min(64, max(32, math.ceil(math.log2(most + 2)) + 10))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-most // (6 * BUCKET_ENTRIES)))

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Words]]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                cells = {c: row.column(c)[0].as_py() for c in row.schema.names if c != "keys"}
                cells["keys"] = row.column("keys").flatten() if "keys" in row.schema.names else None
                yield cells, Words(cells["blob"], cells["lengths"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, words in opened(batches):
            runs = words.runs(block) >> np.uint64(64 - bits)
            values = runs[words.starts(block)]
            if len(values):
                yield from _emit(row["chunk"], values, np.unique(runs[words.blocks(block)]), None, bits, buckets)

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, words in opened(batches):
            hits = _values(row["hits"])
            at = _extendable(words, hits, bits, block, window) if len(hits) else hits
            if len(at):
                second = words.runs(window, mixed(words.hashes ^ np.uint64(_SECOND)), _SECOND)
                second = (second[at] >> np.uint64(32)).astype(np.uint32)
                yield from _emit(row["chunk"], words.runs(window)[at], None, second, 64, buckets)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, words in opened(batches):
            gone = np.zeros(len(words.words) + 1, np.int64)
            hits = _values(row["hits"])
            if len(hits):
                runs, ok = words.runs(window), words.starts(window)
                at = np.flatnonzero(ok & _in(runs, hits))
                np.add.at(gone, at, 1)
                np.add.at(gone, at + window, -1)
            gone = np.cumsum(gone)[:-1] > 0
            kept, removed, sizes = [], [], []
            for a, b in zip(words.begins.tolist(), words.begins[1:].tolist()):
                here = gone[a:b]
                own = words.words[a:b]
                if here.any():
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], here.astype(np.int8), [0]])))
                    removed.append(edges.reshape(-1, 2).tolist())
                    own = [w for w, g in zip(own, here.tolist()) if not g]
                else:
                    removed.append([])
                kept.append(b" ".join(own))
                sizes.append(int(here.sum()))
            yield pa.RecordBatch.from_arrays(
                [
                    row["keys"],
                    pa.array(np.diff(words.begins).astype(np.int64)),
                    pa.array(sizes, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array(removed, pa.list_(pa.list_(pa.int64()))),
                ],
                ["key", "n_words", "n_removed", "kept", "removed"],
            )

    light = chunks.select("chunk", "lengths", "blob")
    met = _repeated(arrow_map(light, probe, _SETS), False)
    repeats = _repeated(arrow_map(_with_hits(light, met), extend, _SETS), True)
    schema = f"key {kind}, n_words long, n_removed long, kept string, removed array<array<bigint>>"
    return arrow_map(_with_hits(chunks, repeats), finish, schema).withColumnRenamed("key", key)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that are not in a repeated passage of 35 words."""
    found = without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP5_SQL = """
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i+34], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35)
), repeated AS (
  SELECT doc_id, list(i) AS starts FROM windows
  WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1) GROUP BY doc_id
), covered AS (
  SELECT doc_id, list_distinct(flatten(list_transform(starts, lambda i: range(i, i + 35)))) AS gone FROM repeated
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words
  ) u ANTI JOIN (SELECT doc_id, unnest(gone) AS i FROM covered) g USING (doc_id, i)
  GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(k.n, 0))::BIGINT AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM words LEFT JOIN kept k USING (doc_id)
"""
