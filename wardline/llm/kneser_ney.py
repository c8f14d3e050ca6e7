"""Interpolated modified Kneser-Ney scores from a bigram model.

Pairs of words are counted as packed sets by bucket of their hash; each bucket's task writes its
pairs as a sorted hash array with counts, and tells each chunk of documents which of its pairs it
answers for and in what count class. From that the chunks make every word's own count, the number
of words it follows, and of how many it is followed by, which are summed by bucket of the word and
written as sorted arrays too. Workers memory-map the arrays to score whole texts.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.chunks import BASE, Words, bucket_cuts, chunked, pack, unpack
from wardline.llm.common import arrow_map, mixed, table, unsigned_crc32_mod, written
from wardline.session import shared_dir

#: Neither can be a word: what follows the last word, and what precedes the first.
END = np.uint64(xxhash.xxh64_intdigest(b""))
BEGIN = np.uint64(xxhash.xxh64_intdigest(b" "))
BUCKET_ENTRIES = 4_000_000
_SETS = "bucket long, chunk long, first decimal(20,0), n long, data binary, sums array<bigint>"


@dataclass
class Model:
    """Where the arrays are, and what holds for all words."""

    folder: str
    bits: int
    buckets: int
    tokens: int
    types: int
    pairs: int
    discounts: tuple[float, float, float]
    low_discounts: tuple[float, float, float]
    low_left: float  # what the discounts of the lower order leave for unknown words and smoothing


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more; between 0 and the count."""
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.5
    ratios = [(1, n2, n1), (2, n3, n2), (3, n4, n3)]
    return tuple(min(max(k - (k + 1) * y * a / b, 0.1), k - 0.1) if b else k * 0.5 for k, a, b in ratios)


def plain_path(uri: str) -> str:
    """The shared folder as a path; arrays can only be mapped where it is mounted."""
    parts = urlparse(uri)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped arrays need a mounted shared folder, not {parts.scheme}:")
    return parts.path


def _save(folder: str, name: str, values: np.ndarray) -> None:
    """Write under another name, then rename: a task that runs again writes the same array."""
    os.makedirs(folder, exist_ok=True)
    draft = f"{folder}/.{name}-{TaskContext.get().taskAttemptId()}"
    with open(draft, "wb") as out:
        np.save(out, values)
    os.replace(draft, f"{folder}/{name}.npy")


def _planes(*columns: np.ndarray) -> bytes:
    """Numbers by byte planes, low bytes first, as many as the largest needs."""
    out = []
    for c in columns:
        width = max(1, -(-int(c.max(initial=0)).bit_length() // 8))
        out.append(bytes([width]) + c.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())
    return b"".join(out)


def _from_planes(data: bytes, n: int, columns: int) -> list[np.ndarray]:
    out, at = [], 0
    for _ in range(columns):
        width = data[at]
        raw = np.zeros((n, 8), np.uint8)
        raw[:, :width] = np.frombuffer(data, np.uint8, width * n, at + 1).reshape(width, n).T
        out.append(raw.view("<i8").ravel())
        at += 1 + width * n
    return out


_KINDS = [pa.int64(), pa.int64(), pa.decimal128(20, 0), pa.int64(), pa.binary(), pa.list_(pa.int64())]
_NAMES = ["bucket", "chunk", "first", "n", "data", "sums"]
_EMPTY = pa.schema(list(zip(_NAMES, _KINDS)))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*((b, c, Decimal(f), n, d, s) for b, c, f, n, d, s in rows)))
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, _KINDS)], _NAMES)


class Text:
    """A chunk's tokens: each document's words, then END; ``before`` is what precedes each token."""

    def __init__(self, row: dict):
        words = Words(row["blob"], row["lengths"], lower=True)
        sizes = np.diff(words.begins) + 1
        self.begins = np.concatenate([[0], np.cumsum(sizes)])
        self.tokens = np.full(self.begins[-1], END)
        inside = np.ones(len(self.tokens), bool)
        inside[self.begins[1:] - 1] = False
        self.tokens[inside] = words.hashes
        self.before = np.concatenate([[BEGIN], self.tokens[:-1]])
        self.before[self.begins[:-1]] = BEGIN
        self.train = np.repeat(np.array(row["train"], bool), sizes)

    def pairs(self, bits: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed(self.before * np.uint64(BASE) + mixed(self.tokens)) >> np.uint64(64 - bits)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, pa.Array | None]]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            cells = {c: row.column(c)[0].as_py() for c in row.schema.names if c != "keys"}
            yield cells, row.column("keys").flatten() if "keys" in row.schema.names else None


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values, a place of each, and how often each is there."""
    order = np.argsort(values, kind="stable")
    v = values[order]
    begins = np.flatnonzero(np.concatenate([np.ones(min(len(v), 1), bool), v[1:] != v[:-1]]))
    return v[begins], order[begins], np.diff(np.concatenate([begins, [len(v)]]))


def _merged(t: pa.Table, columns: int) -> tuple[list, np.ndarray, list[np.ndarray]]:
    """A bucket's sets: ``(chunk, n)`` of each, all values, and their columns of numbers."""
    sets = list(zip(*(t.column(c).to_pylist() for c in ("chunk", "first", "n", "data"))))
    values, numbers = [], []
    for _, first, n, data in sets:
        v, rest = unpack(int(first), n, data)
        values.append(v)
        numbers.append(_from_planes(rest, n, columns))
    return [(s[0], s[2]) for s in sets], np.concatenate(values), [np.concatenate(c) for c in zip(*numbers)]


def _histogram(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


def train(chunks: DataFrame, folder: str) -> Model:
    """Count and write the arrays; ``chunks`` has ``train`` flags by document beside what ``chunked`` gives.

    What reaches the driver is a few sums per bucket. Without training tokens every word is unknown.
    """
    spark = chunks.sparkSession
    path = plain_path(folder)
    most = chunks.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n))).first()[0] or 0
    bits = min(64, max(40, math.ceil(math.log2(most + 2)) + 24))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-most // (6 * BUCKET_ENTRIES)))
    light = chunks.select("chunk", "lengths", "train", "blob")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, _ in _rows(batches):
            text = Text(row)
            v, _, n = _distinct(text.pairs(bits)[text.train])
            if len(v):
                bucket, cuts = bucket_cuts(v, bits, buckets)
                out = []
                for k, a, b in zip(bucket.tolist(), cuts.tolist(), cuts[1:].tolist()):
                    first, data = pack(v[a:b], _planes(n[a:b]))
                    out.append((k, row["chunk"], first, b - a, data, None))
                yield _batch(out)

    def keep_pairs(t: pa.Table) -> pa.Table:
        sets, values, (n,) = _merged(t, 1)
        order = np.argsort(values, kind="stable")
        v = values[order]
        begins = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        total = np.add.reduceat(n[order], begins)
        bucket = t.column("bucket")[0].as_py()
        _save(path, f"pairs-{bucket}", v[begins])
        _save(path, f"counts-{bucket}", total.astype(np.min_scalar_type(int(total.max()))))
        # the first chunk that has a pair answers for it
        kind = np.zeros(len(values), np.uint8)
        kind[order[begins]] = np.minimum(total, 3)
        rows, at = [], 0
        for i, (chunk, size) in enumerate(sets):
            sums = [len(begins), *_histogram(total)] if i == 0 else None
            rows.append((bucket, chunk, 0, size, np.packbits(np.unpackbits(kind[at : at + size, None], axis=1)[:, 6:]).tobytes(), sums))
            at += size
        return pa.Table.from_batches([_batch(rows)], _EMPTY)

    answers = written(arrow_map(light, count, _SETS).groupBy("bucket").applyInArrow(keep_pairs, _SETS), "pair-classes")
    total = answers.where("sums is not null").agg(*(F.sum(F.col("sums")[i]) for i in range(5))).first()
    pairs, *seen = (x or 0 for x in total)
    high = discounts(*seen)
    by_chunk = answers.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("bucket", "n", "data"))).alias("answers"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, _ in _rows(batches):
            text = Text(row)
            if not text.train.any():
                continue
            places = np.flatnonzero(text.train)
            v, place, _ = _distinct(text.pairs(bits)[places])
            place = places[place]
            kinds = []
            for a in row["answers"]:
                two = np.unpackbits(np.frombuffer(a["data"], np.uint8))[: 2 * a["n"]].reshape(-1, 2)
                kinds.append(two[:, 0] * 2 + two[:, 1])
            kind = np.concatenate(kinds)
            mine = kind > 0
            before, after, kind = text.before[place][mine], text.tokens[place][mine], kind[mine]
            tokens = text.tokens[places]
            starts = int(np.isin(text.begins[:-1], places).sum())
            names = np.concatenate([tokens, after, before, [BEGIN]])
            words, back = np.unique(names, return_inverse=True)
            a, b, c = len(tokens), len(tokens) + len(after), len(tokens) + len(after) + len(before)
            m = len(words)
            columns = [
                np.bincount(back[:a], minlength=m),  # how often
                np.bincount(back[a:b], minlength=m),  # after how many words
                *(np.bincount(back[b:c][kind == k], minlength=m) for k in (1, 2, 3)),  # before how many, by count
                np.bincount(back[c:], minlength=m) * starts,  # documents begun
            ]
            bucket, cuts = bucket_cuts(words, 64, buckets)
            out = []
            for k, i, j in zip(bucket.tolist(), cuts.tolist(), cuts[1:].tolist()):
                first, data = pack(words[i:j], _planes(*(x[i:j] for x in columns)))
                out.append((k, row["chunk"], first, j - i, data, None))
            yield _batch(out)

    def keep_words(t: pa.Table) -> pa.Table:
        _, values, columns = _merged(t, 6)
        order = np.argsort(values, kind="stable")
        v = values[order]
        begins = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        often, follows, one, two, more, opened = (np.add.reduceat(c[order], begins) for c in columns)
        bucket = t.column("bucket")[0].as_py()
        context = np.maximum(often + opened, 1)
        left = (high[0] * one + high[1] * two + high[2] * more) / context
        _save(path, f"words-{bucket}", v[begins])
        _save(path, f"often-{bucket}", often.astype(np.uint64 if often.max() >> 32 else np.uint32))
        _save(path, f"follows-{bucket}", follows.astype(np.uint64 if follows.max() >> 32 else np.uint32))
        _save(path, f"context-{bucket}", context.astype(np.uint64 if context.max() >> 32 else np.uint32))
        _save(path, f"left-{bucket}", left.astype(np.float32))
        sums = [int(often.sum()), int((often > 0).sum()), *_histogram(follows), int((follows > 2).sum())]
        return pa.Table.from_batches([_batch([(bucket, 0, 0, 0, b"", sums)])], _EMPTY)

    described = arrow_map(light.join(by_chunk, "chunk"), describe, _SETS)
    sums = written(described.groupBy("bucket").applyInArrow(keep_words, _SETS), "word-sums")
    tokens, types, *low_seen, low_more = (x or 0 for x in sums.agg(*(F.sum(F.col("sums")[i]) for i in range(7))).first())
    low = discounts(*low_seen)
    left = (low[0] * low_seen[0] + low[1] * low_seen[1] + low[2] * low_more) / pairs if pairs else 1.0
    return Model(path, bits, buckets, tokens, types, pairs, high, low, left)


class Arrays:
    """The model's arrays, mapped when first asked for."""

    def __init__(self, model: Model):
        self.model, self.open = model, {}

    def _array(self, name: str, bucket: int) -> np.ndarray | None:
        key = (name, bucket)
        if key not in self.open:
            file = f"{self.model.folder}/{name}-{bucket}.npy"
            self.open[key] = np.load(file, mmap_mode="r") if os.path.exists(file) else None
        return self.open[key]

    def look_up(self, values: np.ndarray, bits: int, keys: str, *names: str) -> list[np.ndarray]:
        """For sorted distinct values the numbers kept under ``names``; 0 where there are none."""
        out = [np.zeros(len(values)) for _ in names]
        if not len(values):
            return out
        bucket, cuts = bucket_cuts(values, bits, self.model.buckets)
        for k, a, b in zip(bucket.tolist(), cuts.tolist(), cuts[1:].tolist()):
            known = self._array(keys, k)
            if known is None:
                continue
            at = np.minimum(np.searchsorted(known, values[a:b]), len(known) - 1)
            there = np.flatnonzero(known[at] == values[a:b])
            for column, name in zip(out, names):
                column[a + there] = self._array(name, k)[at[there]]
        return out


def probabilities(arrays: Arrays, text: Text) -> tuple[np.ndarray, np.ndarray]:
    """Of each token the model's probability and its count in training."""
    m = arrays.model
    words, back = np.unique(np.concatenate([text.tokens, text.before]), return_inverse=True)
    often, follows, context, left = arrays.look_up(words, 64, "words", "often", "follows", "context", "left")
    n = len(text.tokens)
    word, before = back[:n], back[n:]
    cut = np.concatenate([[0], m.low_discounts])[np.minimum(follows, 3).astype(np.int64)]
    low = (follows - cut) / max(m.pairs, 1) + m.low_left / (m.types + 1)
    pairs, back = np.unique(text.pairs(m.bits), return_inverse=True)
    (count,) = arrays.look_up(pairs, m.bits, "pairs", "counts")
    cut = np.concatenate([[0], m.discounts])[np.minimum(count, 3).astype(np.int64)]
    context, left = context[before], np.where(context[before] > 0, left[before], 1.0)
    return (count - cut)[back] / np.maximum(context, 1) + left * low[word], often[word]


def score(chunks: DataFrame, model: Model, kind: str) -> DataFrame:
    """``(key, n_tokens, n_known, base_score, score)`` for every document, log10 of whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = Arrays(model)
        for row, keys in _rows(batches):
            text = Text(row)
            likely, often = probabilities(arrays, text)
            base = np.log10((often + 1) / (model.tokens + (model.types + 1)))
            add = lambda x: np.add.reduceat(x, text.begins[:-1])  # noqa: E731  every document has a token
            yield pa.RecordBatch.from_pydict(
                {
                    "key": keys,
                    "n_tokens": np.diff(text.begins).astype(np.int64),
                    "n_known": add((often > 0).astype(np.int64)),
                    "base_score": add(base),
                    "score": add(np.log10(likely)),
                }
            )

    schema = f"key {kind}, n_tokens long, n_known long, base_score double, score double"
    return arrow_map(chunks, run, schema)


def score_documents(docs: DataFrame, training, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, Model]:
    """Learn from the rows where the column ``training`` is true, and score all rows.

    Words are A-Z lower-cased runs of other bytes than ASCII white space; every text ends in an end
    token. Null texts are empty: the end token alone. Every row is a document, also with a null or
    repeated key; a null in ``training`` counts as false. Other columns are ignored.
    """
    spark = docs.sparkSession
    kind = dict(docs.select(F.col(key).alias("key")).dtypes)["key"]
    marked = docs.select(
        F.struct(F.col(key).alias("key"), F.coalesce(training, F.lit(False)).alias("train")).alias("key"),
        F.col(text).alias("text"),
    )
    chunks = chunked(marked, "key", "text").select(
        "chunk", F.col("keys.key").alias("keys"), F.col("keys.train").alias("train"), "lengths", "blob"
    )
    chunks = written(chunks, "chunks", "uncompressed")
    model = train(chunks, shared_dir(spark, "kneser-ney"))
    return score(chunks, model, kind).withColumnRenamed("key", key), model


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; learned from those whose crc32(doc_id) mod 7 is not 2."""
    docs = table(spark, sf_dir, "documents")
    held = unsigned_crc32_mod(F.col("doc_id"), 7) == 2
    found, model = score_documents(docs, ~held)
    perplexity = F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity")
    train_tokens = F.lit(model.tokens).cast("long").alias("train_tokens")
    return found.select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", train_tokens, "base_score", "score", perplexity
    )
