"""Token ids in files of canonical, length-limited Huffman codes.

Codes come from the counts of all ids. A file holds documents that follow each other in order of
their ids: a header, the code lengths, an Arrow table of documents and their numbers of ids, the bit
offset of every block of ids, then the bits. Blocks are independent, so a file is decoded with one
table look-up per id, many blocks side by side.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import arrow_map, as_text, slices, table, written
from wardline.llm.tokens import ids_of
from wardline.session import shared_dir

MAGIC = b"WHUF1\n"
#: magic, longest code, ids per block, symbols, ids, ids of all documents before, bytes of the document table
HEADER = struct.Struct("<6sBxIIQQQ")
BLOCK = 1024
FILE_IDS = 1 << 22
LONGEST = 18
END = 0


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Optimal code lengths of at most ``longest`` bits by package-merge; 0 for ids that never occur."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    m = len(used)
    if m <= 1:
        out[used] = 1
        return out
    if m > 1 << longest:
        raise ValueError(f"{m} symbols do not fit codes of {longest} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    leaf = [np.ones(m, bool)]
    merged = weights
    for _ in range(longest - 1):
        even = len(merged) // 2 * 2
        packages = merged[0:even:2] + merged[1:even:2]
        both = np.concatenate([weights, packages])
        rank = np.argsort(both, kind="stable")
        merged = both[rank]
        leaf.append(rank < m)
    taken, lengths = 2 * m - 2, np.zeros(m, np.uint8)
    for is_leaf in reversed(leaf):
        leaves = int(is_leaf[:taken].sum())
        lengths[:leaves] += 1
        taken = 2 * (taken - leaves)
    out[order] = lengths
    return out


def canonical(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes by id, and the ids in order of their codes (shorter first, then by id)."""
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    codes = np.zeros(len(lengths), np.uint64)
    code, before = 0, 0
    for n in range(1, int(lengths.max(initial=0)) + 1):
        own = order[lengths[order] == n]
        code <<= n - before
        codes[own] = code + np.arange(len(own), dtype=np.uint64)
        code, before = code + len(own), n
    return codes, order


def decode_table(lengths: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Id and code length for every value of the next ``longest`` bits."""
    _, order = canonical(lengths)
    spread = np.left_shift(1, longest - lengths[order].astype(np.int64))
    ids, bits = np.repeat(order, spread), np.repeat(lengths[order], spread)
    short = (1 << longest) - len(ids)  # only a single symbol leaves codes unused
    return np.pad(ids, (0, short), mode="edge").astype(np.uint32), np.pad(bits, (0, short), mode="edge").astype(np.uint64)


def encode(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Bit offset of every block, and the bits, first bit highest."""
    bits = lengths[ids].astype(np.uint64)
    ends = np.cumsum(bits)
    at = ends - bits
    code, word, room = codes[ids], at >> np.uint64(6), np.uint64(64) - (at & np.uint64(63))
    fits = bits <= room
    over = np.where(fits, 0, bits - room).astype(np.uint64)
    main = np.where(fits, code << (room - np.minimum(bits, room)), code >> over)
    out = np.zeros(int(ends[-1] >> np.uint64(6)) + 2, np.uint64)
    begins = np.flatnonzero(np.diff(word, prepend=np.uint64(1 << 63)))
    out[word[begins]] = np.add.reduceat(main, begins)
    split = np.flatnonzero(~fits)
    out[word[split] + np.uint64(1)] += code[split] << (np.uint64(64) - over[split])
    return at[::BLOCK], out.astype(">u8").tobytes()


def decode(offsets: np.ndarray, bits: bytes, n: int, lengths: np.ndarray, longest: int, block: int) -> np.ndarray:
    """The ids of a file, all blocks advancing one id at a time."""
    words = np.frombuffer(bits, ">u8").astype(np.uint64)
    symbol, width = decode_table(lengths, longest)
    out = np.zeros((len(offsets), block), np.uint32)
    at, rest = offsets.astype(np.uint64), n - (len(offsets) - 1) * block
    one, six, low = np.uint64(1), np.uint64(6), np.uint64(63)
    shift = np.uint64(64 - longest)
    for k in range(block if len(offsets) > 1 else rest):
        if k == rest:
            at = at[:-1]
        word, off = at >> six, at & low
        ahead = (words[word] << off) | ((words[word + one] >> one) >> (low - off))
        key = ahead >> shift
        out[: len(at), k] = symbol[key]
        at = at + width[key]
    return out.ravel()[:n]


def file_bytes(keys: pa.Array, sizes: np.ndarray, start: int, ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray, longest: int) -> bytes:
    offsets, bits = encode(ids, lengths, codes)
    sink = pa.BufferOutputStream()
    index = pa.RecordBatch.from_arrays([keys, pa.array(sizes, pa.int64())], ["key", "n"])
    with pa.ipc.new_stream(sink, index.schema) as out:
        out.write_batch(index)
    documents = sink.getvalue().to_pybytes()
    head = HEADER.pack(MAGIC, longest, BLOCK, len(lengths), len(ids), start, len(documents))
    return head + lengths.tobytes() + documents + offsets.astype("<u8").tobytes() + bits


def read_file(data: bytes) -> tuple[pa.Array, np.ndarray, int, np.ndarray]:
    """Keys, numbers of ids, ids before, ids."""
    magic, longest, block, symbols, n, start, size = HEADER.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a file of this format")
    at = HEADER.size
    lengths = np.frombuffer(data, np.uint8, symbols, at)
    at += symbols
    index = pa.ipc.open_stream(data[at : at + size]).read_all().combine_chunks()
    at += size
    blocks = -(-n // block)
    offsets = np.frombuffer(data, "<u8", blocks, at)
    at += 8 * blocks
    ids = decode(offsets, data[at:], n, lengths, longest, block)
    return index.column("key").combine_chunks(), index.column("n").to_numpy(), start, ids


def _tokenised(docs: DataFrame, key: str, text: str, path: str, kind: str) -> DataFrame:
    """``(part, start, key, ids)`` in order of the key: range partitions, sorted, ids counted from the part's begin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        packer, end = ids_of(path, False, kind), np.array([END], kind).tobytes()
        for batch in slices(batches, "text"):
            ids = [packer.text(t) + end for t in as_text(batch.column("text"))]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // np.dtype(kind).itemsize
            starts = start + np.cumsum(sizes) - sizes
            start += int(sizes.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(ids), pa.int64()), pa.array(starts), batch.column("key"), pa.array(ids, pa.binary())],
                ["part", "start", "key", "ids"],
            )

    picked = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    tie = F.xxhash64("text")
    placed = picked.repartitionByRange("key", tie).sortWithinPartitions("key", tie)
    return arrow_map(placed, run, f"part long, start long, key {dict(picked.dtypes)['key']}, ids binary")


def _counts(tokenised: DataFrame, symbols: int, kind: str) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(symbols, np.int64)
        for batch in batches:
            for ids in batch.column("ids"):
                sums += np.bincount(np.frombuffer(ids.as_buffer(), kind), minlength=symbols)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"id": used, "n": sums[used]})

    counts = np.zeros(symbols, np.int64)
    for r in arrow_map(tokenised.select("ids"), run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[r["id"]] = r["n"]
    return counts


def _local(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_files(
    docs: DataFrame,
    folder: str,
    key: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    longest: int = LONGEST,
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Tokenise whole texts, append the end id, write files in order of the key; ``(file, documents, ids, bytes)``.

    ``folder`` must be one that all executors share. A file is written under another name and then
    renamed; its bytes depend on its documents alone, so a task that runs again writes it again. Null
    and empty texts are their end id; null keys come first, equal keys in order of their texts' hashes.
    What reaches the driver is one count per symbol and one sum per partition.
    """
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    symbols = max(ids_of(path, False, "<u2").tokenizer.get_vocab_size(), END + 1)
    kind = "<u2" if symbols <= 1 << 16 else "<u4"
    tokens = written(_tokenised(docs, key, text, path, kind), "tokens")
    lengths = code_lengths(_counts(tokens, symbols, kind), longest)
    codes, _ = canonical(lengths)
    sums = tokens.groupBy("part").agg(F.max(F.col("start") + F.octet_length("ids") / np.dtype(kind).itemsize).cast("long").alias("n"))
    before, total = {}, 0
    for r in sums.orderBy("part").collect():
        before[r["part"]] = total
        total += r["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = _local(folder)
        fs.create_dir(top, recursive=True)
        held: list[tuple[pa.Array, list[bytes]]] = []
        place = size = 0

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(x for _, part in held for x in part), kind)
            sizes = np.array([len(x) for _, part in held for x in part]) // np.dtype(kind).itemsize
            data = file_bytes(pa.concat_arrays([k for k, _ in held]), sizes, place, ids, lengths, codes, longest)
            name = f"{place:015d}.huf"
            draft = f"{top}/_{name}-{TaskContext.get().taskAttemptId()}"
            with fs.open_output_stream(draft) as out:
                out.write(data)
            fs.move(draft, f"{top}/{name}")
            row = {"file": [name], "documents": [len(sizes)], "ids": [len(ids)], "bytes": [len(data)]}
            return pa.RecordBatch.from_pydict(row)

        for batch in slices(batches, "ids"):
            starts = [before[p] + s for p, s in zip(batch.column("part").to_pylist(), batch.column("start").to_pylist())]
            values = batch.column("ids").to_pylist()
            # runs of documents that follow each other
            cut = 0
            for i in range(len(values)):
                follows = held or i > cut
                if follows and starts[i] != place + size:
                    if i > cut:
                        held.append((batch.column("key").slice(cut, i - cut), values[cut:i]))
                    yield close()
                    held, size, cut = [], 0, i
                if not held and i == cut:
                    place = starts[i]
                size += len(values[i]) // np.dtype(kind).itemsize
            held.append((batch.column("key").slice(cut), values[cut:]))
            if size >= file_ids:
                yield close()
                held, size = [], 0
        if held:
            yield close()

    return written(arrow_map(tokens, run, "file string, documents long, ids long, bytes long"), "files")


def read_files(spark: SparkSession, folder: str, key: str = "doc_id", kind: str = "bigint") -> DataFrame:
    """``(key, start, ids)`` of every document in a folder's files; ``ids`` are packed uint32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                keys, sizes, start, ids = read_file(content.as_py())
                ends = np.cumsum(sizes)
                raw, starts = ids.astype("<u4").tobytes(), start + ends - sizes
                for i in range(0, len(sizes), 2000):
                    spans = zip((ends - sizes)[i : i + 2000].tolist(), ends[i : i + 2000].tolist())
                    yield pa.RecordBatch.from_arrays(
                        [keys.slice(i, 2000), pa.array(starts[i : i + 2000]), pa.array([raw[4 * a : 4 * b] for a, b in spans], pa.binary())],
                        ["key", "start", "ids"],
                    )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.huf").load(folder).select("content")
    return arrow_map(files, run, f"key {kind}, start long, ids binary").withColumnRenamed("key", key)


def op10_huffman_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, read back from the files that were written."""
    docs = table(spark, sf_dir, "documents")
    folder = shared_dir(spark, "huffman")
    if not write_files(docs, folder).limit(1).count():
        return docs.select("doc_id", *(F.lit(0).cast("long").alias(c) for c in ("start", "n_tokens", "ids_crc32"))).limit(0)
    found = read_files(spark, folder, kind=dict(docs.dtypes)["doc_id"])
    n = (F.octet_length("ids") / 4).cast("long")
    return found.select("doc_id", "start", n.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
