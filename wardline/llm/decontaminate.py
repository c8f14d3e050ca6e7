"""Benchmark decontamination by a prefix-filtered set join.

Every benchmark window must be contained whole, so of its shingles, ordered by rarity in the
documents, the first alone is a necessary prefix: a document is a candidate where it has the
window's rarest shingle. The shingle's place in the window gives the only place the window can
stand (positional bound), which must lie within the document (length bound); then the words are
compared one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import arrow_map, as_bytes, slices, table, written

#: A-Z become a-z; other ASCII characters than letters and digits separate words.
_FOLD = bytes(
    i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 32 for i in range(256)
)
#: Text of benchmark items that is broadcast at once; a larger benchmark takes several passes.
BLOCK_BYTES = 16 << 20


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


@dataclass
class Block:
    """Windows of some items over a vocabulary of their own; a shingle is two words, or the only one."""

    vocabulary: dict[bytes, int]
    windows: dict[int, np.ndarray]  # length -> windows x length of word numbers
    owners: dict[int, list[np.ndarray]]  # length -> items of each window
    shingles: np.ndarray  # sorted codes of all shingles in the windows
    names: list  # item numbers -> item ids
    prefix: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] | None = None

    @property
    def width(self) -> np.int64:
        return np.int64(len(self.vocabulary) + 1)


def codes_of(block: Block, ids: np.ndarray) -> np.ndarray:
    """Shingle that starts at each word; -1 if a word of it is in no window."""
    out = np.full(len(ids), -1, np.int64)
    good = (ids[:-1] >= 0) & (ids[1:] >= 0)
    out[:-1][good] = ids[:-1][good] * block.width + ids[1:][good]
    return out


def make_block(items: list[tuple], window: int) -> Block:
    vocabulary: dict[bytes, int] = {}
    seen: dict[int, dict[tuple, set[int]]] = {}
    names: list = []
    number: dict = {}
    for item_id, text in items:
        ids = [vocabulary.setdefault(w, len(vocabulary)) for w in words_of((text or "").encode())]
        if item_id not in number:
            number[item_id] = len(names)
            names.append(item_id)
        size = min(window, len(ids))
        for i in range(len(ids) - size + 1) if size else ():
            seen.setdefault(size, {}).setdefault(tuple(ids[i : i + size]), set()).add(number[item_id])
    windows = {n: np.array(list(w), dtype=np.int64) for n, w in seen.items()}
    owners = {n: [np.array(sorted(o)) for o in w.values()] for n, w in seen.items()}
    block = Block(vocabulary, windows, owners, np.zeros(0, np.int64), names)
    parts = [_shingles(block, w).ravel() for w in windows.values()]
    if parts:
        block.shingles = np.unique(np.concatenate(parts))
    return block


def _shingles(block: Block, windows: np.ndarray) -> np.ndarray:
    """Shingles of each window; a window of one word has the word itself, with nothing after it."""
    if windows.shape[1] == 1:
        return windows * block.width + (block.width - 1)
    return windows[:, :-1] * block.width + windows[:, 1:]


def _lookup(block: Block, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts, each followed by -1, and where each text begins (one more at the end)."""
    get = block.vocabulary.get
    found, begins = [], [0]
    for text in as_bytes(batch.column("text")):
        words = words_of(text)
        ids = np.full(len(words) + 1, -1, np.int64)
        ids[:-1] = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        found.append(ids)
        begins.append(begins[-1] + len(ids))
    return np.concatenate(found), np.array(begins)


def _positions(sorted_codes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``codes`` has one of ``sorted_codes``, and which."""
    at = np.flatnonzero(codes >= 0)
    if not len(sorted_codes) or not len(at):
        return at[:0], at[:0]
    rank = np.searchsorted(sorted_codes, codes[at])
    rank[rank == len(sorted_codes)] = 0
    same = sorted_codes[rank] == codes[at]
    return at[same], rank[same]


def rarity(docs: DataFrame, block: Block) -> np.ndarray:
    """How often each shingle of the block is in all documents: one pass, one number a shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(block.shingles), np.int64)
        for batch in slices(batches, "text"):
            ids, _ = _lookup(block, batch)
            sums += np.bincount(_positions(block.shingles, codes_of(block, ids))[1], minlength=len(sums))
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"shingle": at, "n": sums[at]})

    counts = np.zeros(len(block.shingles), np.int64)
    rows = arrow_map(docs.select("text"), run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    for r in rows.collect():
        counts[r["shingle"]] = r["n"]
    return counts


def choose_prefixes(block: Block, counts: np.ndarray) -> None:
    """For each window its rarest shingle: (sorted shingles, their windows, places in the windows)."""
    block.prefix = {}
    for n, windows in block.windows.items():
        codes = _shingles(block, windows)
        place = counts[np.searchsorted(block.shingles, codes)].argmin(axis=1)
        code = codes[np.arange(len(codes)), place]
        order = np.argsort(code, kind="stable")
        block.prefix[n] = (code[order], order, place[order])


def find_windows(block: Block, ids: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """``(length, starts, windows)`` of all windows that stand in a run of word numbers."""
    codes = codes_of(block, ids)
    found = []
    for n, (prefix, which, place) in block.prefix.items():
        if n == 1:
            at = np.flatnonzero(ids >= 0)
            lone = ids[at] * block.width + (block.width - 1)
        else:
            at = np.flatnonzero(codes >= 0)
            lone = codes[at]
        low, high = np.searchsorted(prefix, lone), np.searchsorted(prefix, lone, side="right")
        some = high > low
        at, low, many = at[some], low[some], (high - low)[some]
        if not len(at):
            continue
        # candidates in portions, so that a frequent prefix needs no more room than a rare one
        step = max(1, (1 << 18) // int(many.max()))
        for i in range(0, len(at), step):
            reps = many[i : i + step]
            entry = np.repeat(low[i : i + step], reps) + _within_runs(reps)
            start = np.repeat(at[i : i + step], reps) - place[entry]
            ok = (start >= 0) & (start + n <= len(ids))
            start, window = start[ok], which[entry][ok]
            for k in range(n):  # verify word by word
                same = ids[start + k] == block.windows[n][window, k]
                start, window = start[same], window[same]
            if len(start):
                found.append((n, start, window))
    return found


def _within_runs(lengths: np.ndarray) -> np.ndarray:
    ends = np.cumsum(lengths)
    return np.arange(ends[-1]) - np.repeat(ends - lengths, lengths)


def _mark(docs: DataFrame, block: Block) -> DataFrame:
    """Add the block's finds to ``n_words``, ``spans`` and ``items`` of the rows that go through."""
    broadcast = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = broadcast.value
        for batch in slices(batches, "text"):
            ids, begins = _lookup(own, batch)
            hit = np.zeros(len(ids) + 1, np.int64)
            items: list[set] = [set() for _ in range(batch.num_rows)]
            for n, start, window in find_windows(own, ids):
                np.add.at(hit, start, 1)
                np.add.at(hit, start + n, -1)
                doc = np.searchsorted(begins, start, side="right") - 1
                pairs = np.unique(np.stack([doc, window]), axis=1)
                for d, w in pairs.T.tolist():
                    items[d].update(own.names[i] for i in own.owners[n][w])
            covered = np.concatenate([[0], np.cumsum(hit[:-1]) > 0, [0]]).astype(np.int8)
            edge = np.diff(covered)
            first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            doc = np.searchsorted(begins, first, side="right") - 1
            spans: list[list] = [[] for _ in range(batch.num_rows)]
            for d, a, b in zip(doc.tolist(), first.tolist(), last.tolist()):
                spans[d].append([a - int(begins[d]), b - int(begins[d])])
            old_spans, old_items = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
            columns = {name: batch.column(name) for name in batch.schema.names}
            columns["n_words"] = pa.array((np.diff(begins) - 1).astype(np.int64))
            columns["spans"] = pa.array([_joined(a or [], b) for a, b in zip(old_spans, spans)], batch.schema.field("spans").type)
            kind = batch.schema.field("items").type
            columns["items"] = pa.array([[*(a or []), *sorted(b, key=str)] for a, b in zip(old_items, items)], kind)
            yield pa.RecordBatch.from_pydict(columns)

    return arrow_map(docs, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))


def _joined(old: list, new: list) -> list:
    out: list = []
    for a, b in sorted([*map(list, old), *new]):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return out


def blocks_of(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> Iterator[list[tuple]]:
    """The items in portions whose text is of a bounded size (a single longer item makes one alone)."""
    items = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text")).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-int(total) * 2 // block_bytes))
    if parts == 1:
        yield [tuple(r) for r in items.collect()]
        return
    dealt = written(items.withColumn("part", F.pmod(F.xxhash64("item", "text"), F.lit(parts))), "benchmark")
    for i in range(parts):
        yield [tuple(r) for r in dealt.where(F.col("part") == i).select("item", "text").collect()]


def contaminated_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = 13,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """All rows and columns of ``docs`` with ``n_words``, ``spans`` and ``items``.

    ``spans`` are word ranges ``[begin, end)`` covered by occurrences of windows of ``window``
    consecutive item words (of a shorter item: all its words), merged; ``items`` the ids of the items
    with such a window. The benchmark is broadcast in portions of ``block_bytes``, each of which goes
    over the documents twice (rarity, join) without a shuffle. Null texts have no words; items that
    are null or without words hit nothing; repeated items count once; item ids may be null.
    Columns of these names in ``docs`` are replaced.
    """
    item_kind = dict(benchmark.select(F.col(item).alias("item")).dtypes)["item"]
    own = [c for c in docs.columns if c not in ("n_words", "spans", "items")]
    plain = docs.select(*(F.col(f"`{c}`") for c in own), F.col(text).alias("text")) if text != "text" else docs.select(*own)
    out = plain.withColumns(
        {
            "n_words": F.lit(0).cast("long"),
            "spans": F.lit(None).cast("array<array<bigint>>"),
            "items": F.lit(None).cast(f"array<{item_kind}>"),
        }
    )
    for items in blocks_of(benchmark, item, item_text, block_bytes):
        block = make_block(items, window)
        choose_prefixes(block, rarity(docs.select(F.col(text).alias("text")), block))
        out = _mark(out, block)
    return out.withColumn("items", F.array_distinct("items"))


def n_hit(spans):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])


def is_contaminated(n_words, hits):
    """At least a twentieth of the words."""
    return (hits > 0) & (hits * 20 >= n_words)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in a 13-word window of the benchmark."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contaminated_spans(docs, table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("items", lambda i: F.coalesce(i.cast("string"), F.lit(""))))
    return found.select(
        "doc_id",
        "n_words",
        n_hit("spans").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"),
    ).withColumn("contaminated", is_contaminated(F.col("n_words"), F.col("n_hit")))


OP4_SQL = r"""
WITH worded AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[p:p + least(len(w), 13) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p FROM items WHERE len(w) > 0)),
places AS (
  SELECT row_id, p, size, array_to_string(w[p:p + size - 1], ' ') AS words
  FROM (SELECT row_id, w, size, unnest(range(1, len(w) - size + 2)) AS p
    FROM worded, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)),
found AS (SELECT row_id, p, size, item_id FROM places JOIN windows USING (size, words)),
hits AS (
  SELECT row_id, count(DISTINCT place) AS n_hit
  FROM (SELECT row_id, unnest(range(p, p + size)) AS place FROM found) GROUP BY row_id),
named AS (
  SELECT row_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT row_id, item_id::VARCHAR AS name FROM found) GROUP BY row_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM worded LEFT JOIN hits USING (row_id) LEFT JOIN named USING (row_id)"""
