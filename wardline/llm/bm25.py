"""Exact BM25 top-k search: an inverted index per shard, block-max WAND, exact merge.

The index is built once and kept in the shared folder, a shard a row: sorted terms, and for each
its documents with their counts. Idf and mean length are global, so scores of different shards
compare. Queries come in blocks of bounded size that are broadcast, those alike in a group. In a shard the documents
stand in blocks. Of a block and a group, the terms that many of both have are scored by one product of dense matrices
in single precision, what the others add is worked out entry by entry, once. Single precision only tells which
documents may reach a query's k-th best score so far; these are scored again in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.llm.common import arrow_map, as_bytes, slices, table, word_hashes, written
from wardline.llm.decontaminate import words_of

K1, B = 1.2, 0.75
SHARD_BYTES, SHARD_ROWS = 8 << 20, 1 << 12
BLOCK_ROWS = 128
#: Terms in more than this share of a group's queries may be dense, and are in the blocks where the share of the
#: pairs (document, query) that both have the term is beyond the second figure.
DENSE, DENSE_PAIRS = 1 / 32, 1 / 400
#: Cells of the dense matrices of all groups, at most.
DENSE_CELLS = 32_000_000
#: Entries scored at once, about.
ENTRIES = 1 << 18
#: Groups of alike queries at most, told apart by so many common terms; fewer queries stay one group.
GROUPS, GROUP_TERMS, GROUP_FROM = 8, 256, 1024
#: (query, term) entries of one broadcast block of queries, about.
QUERY_ENTRIES = 3_000_000
_LAST = np.iinfo(np.int64).max
_DIGITS = 9


def _bag(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(word_hashes(words_of(text)), return_counts=True)


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(keys, lengths, terms, ends, rows, counts)`` by shard; documents alike stand side by side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SHARD_BYTES, SHARD_ROWS):
            bags = [_bag(t) for t in as_bytes(batch.column("text"))]
            lengths = np.array([int(c.sum()) for _, c in bags])
            # documents that share their most frequent word, and are as long, have many terms in common
            leading = [int(t[c.argmax()]) if len(t) else 0 for t, c in bags]
            order = sorted(range(len(bags)), key=lambda i: (leading[i], len(bags[i][0]), i))
            keys = batch.column("key").take(pa.array(order))
            term = np.concatenate([bags[i][0] for i in order])
            row = np.repeat(np.arange(len(order)), [len(bags[i][0]) for i in order])
            count = np.concatenate([bags[i][1] for i in order])
            by = np.argsort(term, kind="stable")
            terms, begins = np.unique(term[by], return_index=True)
            ends = np.append(begins[1:], len(by))
            binary = lambda x, t: pa.array([np.ascontiguousarray(x).astype(t).tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                    binary(lengths[order], "<i8"),
                    binary(terms, "<u8"),
                    binary(ends, "<u4"),
                    binary(row[by], "<u2"),
                    binary(count[by], "<u4"),
                    pa.array([len(order)]),
                    pa.array([int(lengths.sum())]),
                ],
                ["keys", "lengths", "terms", "ends", "rows", "counts", "n", "words"],
            )

    picked = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    schema = "keys array<bigint>, lengths binary, terms binary, ends binary, rows binary, counts binary, n long, words long"
    return written(arrow_map(picked, run, schema), "index", "lz4")


@dataclass
class Queries:
    """A block of queries: for each of its sorted terms the queries that have it, with their weights."""

    ids: np.ndarray
    terms: np.ndarray
    ends: np.ndarray
    query: np.ndarray
    weight: np.ndarray  # times the term is in the query
    idf: np.ndarray | None = None  # by term; 1 if not given
    first: int = 0  # number of the first query, of those of all groups
    cells: int = DENSE_CELLS

    @cached_property
    def many(self) -> np.ndarray:
        """How many queries have each term."""
        return np.diff(self.ends, prepend=0)

    @cached_property
    def again(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The entries of queries that have their term more than once, and how often besides."""
        more = self.weight != 1
        return np.append(0, np.cumsum(more))[self.ends], self.query[more], self.weight[more] - 1

    @cached_property
    def common(self) -> np.ndarray:
        """The terms that may be dense."""
        found = np.flatnonzero(self.many > max(DENSE * len(self.ids), 8))
        room = self.cells // max(1, len(self.ids))
        return np.sort(found[np.argsort(-self.many[found], kind="stable")[:room]])

    @cached_property
    def slot(self) -> np.ndarray:
        slot = np.full(len(self.terms), -1)
        slot[self.common] = np.arange(len(self.common))
        return slot

    @cached_property
    def dense(self) -> np.ndarray:
        """(common terms x queries): whole numbers, so exact."""
        matrix = np.zeros((len(self.common), len(self.ids)), np.float32)
        entry, many = _expanded(self.ends, self.common)
        matrix[np.repeat(np.arange(len(self.common)), many), self.query[entry]] = self.weight[entry]
        return matrix


def _query_bags(queries: DataFrame, key: str, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            bags = [_bag(t) for t in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array([len(t) for t, _ in bags], pa.int64()),
                    pa.array([t.astype("<u8").tobytes() for t, _ in bags], pa.binary()),
                    pa.array([c.astype("<u4").tobytes() for _, c in bags], pa.binary()),
                ],
                ["key", "n", "terms", "counts"],
            )

    picked = queries.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).where("key is not null")
    picked = picked.distinct()
    return written(arrow_map(picked, run, "key long, n long, terms binary, counts binary"), "queries")


def _query_block(rows: list) -> Queries:
    rows = sorted(rows, key=lambda r: (r["key"], r["terms"], r["counts"]))
    term = np.concatenate([np.frombuffer(r["terms"], "<u8") for r in rows])
    times = np.concatenate([np.frombuffer(r["counts"], "<u4") for r in rows])
    query = np.repeat(np.arange(len(rows)), [r["n"] for r in rows])
    by = np.argsort(term, kind="stable")
    terms, begins = np.unique(term[by], return_index=True)
    ends = np.append(begins[1:], len(by))
    return Queries(np.array([r["key"] for r in rows]), terms, ends, query[by], times[by].astype(float))


def _grouped(block: Queries) -> list[Queries]:
    """The queries in groups that share many of their common terms, as those of a language do."""
    n = len(block.ids)
    if n < GROUP_FROM:
        return [block]
    term = np.repeat(np.arange(len(block.terms)), block.many)
    common = np.argsort(-block.many, kind="stable")[:GROUP_TERMS]
    slot = np.full(len(block.terms), -1)
    slot[common] = np.arange(len(common))
    used = slot[term] >= 0
    has = np.zeros((n, len(common)), np.float32)
    has[block.query[used], slot[term[used]]] = 1
    has /= np.maximum(np.sqrt(has.sum(axis=1, keepdims=True)), 1)
    # the groups begin as the queries that share their most frequent word
    times = np.zeros((n, len(common)), np.float32)
    times[block.query[used], slot[term[used]]] = block.weight[used]
    of = times.argmax(axis=1)
    names = np.argsort(-np.bincount(of, minlength=len(common)), kind="stable")[:GROUPS]
    centres = np.array([has[of == name].mean(axis=0) if (of == name).any() else np.zeros(len(common)) for name in names])
    for _ in range(4):
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
        of = (has @ centres.T.astype(np.float32)).argmax(axis=1)
        centres = np.array([has[of == g].mean(axis=0) if (of == g).any() else np.zeros(len(common)) for g in range(len(names))])
    out, first, group = [], 0, of[block.query]
    for g in np.unique(of):
        members, mine = np.flatnonzero(of == g), group == g
        number = np.zeros(n, np.int64)
        number[members] = np.arange(len(members))
        terms, begins = np.unique(term[mine], return_index=True)
        ends = np.append(begins[1:], mine.sum())
        idf = None if block.idf is None else block.idf[terms]
        cells = DENSE_CELLS * int(mine.sum()) // len(mine)
        out.append(
            Queries(block.ids[members], block.terms[terms], ends, number[block.query[mine]], block.weight[mine], idf, first, cells)
        )
        first += len(members)
    return out


def _shared(ours: np.ndarray, theirs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the terms that both have."""
    if not len(ours) or not len(theirs):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(theirs, ours), len(theirs) - 1)
    same = theirs[at] == ours
    return np.flatnonzero(same), at[same]


def _frequencies(index: DataFrame, queries: Queries) -> np.ndarray:
    """In how many documents each term of the block is."""
    sent = index.sparkSession.sparkContext.broadcast(queries.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(sent.value), np.int64)
        for batch in batches:
            for t, e in zip(batch.column("terms"), batch.column("ends")):
                ends = np.frombuffer(e.as_buffer(), "<u4").astype(np.int64)
                mine, theirs = _shared(sent.value, np.frombuffer(t.as_buffer(), "<u8"))
                sums[mine] += np.diff(ends, prepend=0)[theirs]
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"term": used, "n": sums[used]})

    found = arrow_map(_by_core(index.select("terms", "ends")), run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    rows, out = found.toArrow(), np.zeros(len(queries.terms), np.int64)
    out[rows.column("term").to_numpy()] = rows.column("n").to_numpy()
    return out


def _expanded(ends: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All entries of the lists ``which``: where they stand, and how long each list is."""
    begin = np.where(which > 0, ends[which - 1], 0)
    size = ends[which] - begin
    total = np.cumsum(size)
    at = np.arange(total[-1] if len(total) else 0) + np.repeat(begin - total + size, size)
    return at, size


def _postings(row: dict, mean: float) -> tuple[np.ndarray, ...]:
    """Of a shard: its keys and terms; and document by document the terms of each, by number, and their impacts."""
    terms, length = np.frombuffer(row["terms"], "<u8"), np.frombuffer(row["lengths"], "<i8")
    rows, tf = np.frombuffer(row["rows"], "<u2"), np.frombuffer(row["counts"], "<u4")
    size = np.diff(np.frombuffer(row["ends"], "<u4").astype(np.int64), prepend=0)
    order = np.argsort(rows, kind="stable")
    doc, tf = rows[order].astype(np.int64), tf[order].astype(float)
    impact = tf * (K1 + 1) / (tf + (K1 * (1 - B + B * length / mean))[doc])
    ids = np.array([_LAST if k is None else k for k in row["keys"]], np.int64)
    return ids, terms, doc, np.repeat(np.arange(len(terms), dtype=np.int32), size)[order], impact


def _cells(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Cells (i, j) of a product, in double precision."""
    columns, place = np.unique(j, return_inverse=True)
    out = np.empty(len(i))
    if len(i) > 2 * len(columns):
        for part in range(0, len(columns), 1 << 10):
            some = (place >= part) & (place < part + (1 << 10))
            product = left @ right.take(columns[part : part + (1 << 10)], axis=1).astype(float)
            out[some] = product[i[some], place[some] - part]
        return out
    upright = np.ascontiguousarray(left.T)
    for part in range(0, len(i), 1 << 10):
        some = slice(part, part + (1 << 10))
        out[some] = (upright.take(i[some], axis=1) * right.take(j[some], axis=1)).sum(axis=0)
    return out


def _arranged(row: dict, mean: float, groups: list[Queries]) -> None:
    """Put documents side by side that have the common terms of the same group of queries, by length."""
    ids, terms, doc, term, impact = _postings(row, mean)
    near = np.zeros((len(groups), row["n"]))
    for g, queries in enumerate(groups):
        mine, theirs = _shared(queries.terms[queries.common], terms)
        share = np.zeros(len(terms))
        share[theirs] = queries.many[queries.common][mine] / len(queries.ids)
        near[g] = np.bincount(doc, share[term], row["n"]) / max(np.sqrt((share**2).sum()), 1e-9)
    order = np.lexsort((np.bincount(doc, minlength=row["n"]), near.argmax(axis=0)))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    by = np.argsort(place[doc].astype(np.uint16), kind="stable")
    row["_postings"] = ids[order], terms, place[doc][by], term[by], impact[by]


class Shard:
    """One shard as far as a group of queries concerns it."""

    def __init__(self, row: dict, queries: Queries, mean: float):
        self.q, self.n = queries, row["n"]
        if "_postings" not in row:
            row["_postings"] = _postings(row, mean)
        self.ids, terms, doc, term, impact = row["_postings"]
        mine, theirs = _shared(queries.terms, terms)
        ours = np.full(len(terms), -1, np.int32)
        ours[theirs] = mine
        term = ours[term]
        at = np.flatnonzero(term >= 0)
        self.doc, self.term, self.impact = doc[at], term[at], impact[at]
        if queries.idf is not None:
            self.impact *= queries.idf[self.term]
        self.blocks = -(-self.n // BLOCK_ROWS)
        self.cuts = np.searchsorted(self.doc, np.arange(self.blocks + 1) * BLOCK_ROWS)

    def _split(self, block: int, wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of a block: its dense terms, a dense matrix (documents x these terms), and which postings it leaves."""
        a, b = self.cuts[block], self.cuts[block + 1]
        slot = self.q.slot[self.term[a:b]]
        may = np.flatnonzero(slot >= 0)
        in_block = np.bincount(slot[may], minlength=len(self.q.common))
        dense = np.flatnonzero(in_block * self.q.many[self.q.common] > DENSE_PAIRS * wide * len(self.q.ids))
        column = np.full(len(self.q.common), -1)
        column[dense] = np.arange(len(dense))
        at = column[slot[may]]
        may, at = may[at >= 0], at[at >= 0]
        matrix = np.zeros((wide, len(dense)))
        matrix[self.doc[a:b][may] - block * BLOCK_ROWS, at] = self.impact[a:b][may]
        left = np.ones(b - a, bool)
        left[may] = False
        return dense, matrix, a + np.flatnonzero(left)

    def _rare(self, block: int, wide: int, left: np.ndarray) -> np.ndarray:
        """Scores (documents x queries) from the postings ``left`` of a block."""
        term, impact = self.term[left], self.impact[left]
        # document by document, so that the sums of one stand close together
        begin = (self.doc[left] - block * BLOCK_ROWS) * len(self.q.ids)
        out = np.zeros(wide * len(self.q.ids))
        # a few documents at once, so that their entries take little memory
        entries = np.cumsum(self.q.many[term])
        cuts = np.searchsorted(entries, np.arange(ENTRIES, entries[-1] if len(entries) else 0, ENTRIES))
        cuts = np.unique(np.searchsorted(begin, [0, *begin[cuts], len(out)]))
        for a, b in zip(cuts[:-1], cuts[1:]):
            entry, many = _expanded(self.q.ends, term[a:b])
            cell = np.repeat(begin[a:b] - begin[a], many)
            cell += self.q.query.take(entry)
            last = begin[b - 1] + len(self.q.ids)
            out[begin[a] : last] = np.bincount(cell, np.repeat(impact[a:b], many), last - begin[a])
        # most queries have a rare term once, so weights are looked up for the others only
        ends, query, weight = self.q.again
        entry, many = _expanded(ends, term)
        np.add.at(out, np.repeat(begin, many) + query[entry], np.repeat(impact, many) * weight[entry])
        return out.reshape(wide, len(self.q.ids))

    def search(self, k: int, best: np.ndarray, names: np.ndarray) -> None:
        """Bring ``best`` (scores, falling) and ``names`` (keys) of all queries up to date with this shard."""
        if not len(self.term):
            return
        wide = [min(BLOCK_ROWS, self.n - b * BLOCK_ROWS) for b in range(self.blocks)]
        split = [self._split(b, wide[b]) for b in range(self.blocks)]
        peaks = np.zeros((self.blocks, len(self.q.common)), np.float32)
        for b, (dense, matrix, _) in enumerate(split):
            peaks[b, dense] = matrix.max(axis=0)
        bounds = peaks @ self.q.dense * (1 + (len(self.q.common) + 8) * 2.0**-22)
        for b in np.argsort(-bounds.sum(axis=1), kind="stable"):
            ids = self.ids[b * BLOCK_ROWS : (b + 1) * BLOCK_ROWS]
            dense, matrix, left = split[b]
            rare = self._rare(b, len(ids), left)
            bound = bounds[b] + rare.max(axis=0)
            alive = np.flatnonzero((bound * (1 + 1e-6) + 1e-8 >= best[:, -1]) & (bound > 0))
            if not len(alive):
                continue
            if few := 2 * len(alive) < len(best):
                rare = rare.take(alive, axis=1)
            else:
                alive = np.arange(len(best))
            about, weights = rare.astype(np.float32), None
            if len(dense):
                weights = self.q.dense.take(dense, axis=0)
                if few:
                    weights = weights.take(alive, axis=1)
                about += matrix.astype(np.float32) @ weights
            # all terms are positive, so this is how far the sums may be off, as a share
            off = (len(dense) + 8) * 2.0**-22
            least = np.maximum(best[alive, -1] * (1 - off) - 1e-8, 1e-10).astype(np.float32)
            doc, query = np.divmod(np.flatnonzero(about >= least), len(alive))
            if not len(doc):
                continue
            crowded = np.flatnonzero(np.bincount(query, minlength=len(alive)) > k)
            if len(crowded):
                # k documents of this block are sure to reach that much
                least[crowded] = np.maximum(
                    least[crowded], np.partition(about[:, crowded], len(ids) - k, axis=0)[len(ids) - k] * (1 - 2 * off)
                )
                stays = about[doc, query] >= least[query]
                doc, query = doc[stays], query[stays]
            score = rare[doc, query]
            if weights is not None:
                score += _cells(matrix, weights, doc, query)
            self._insert(k, best, names, np.round(score, _DIGITS), ids[doc], alive[query])

    @staticmethod
    def _insert(k: int, best: np.ndarray, names: np.ndarray, score: np.ndarray, name: np.ndarray, query: np.ndarray) -> None:
        """Take scores of documents into the ``k`` best of their queries; the smaller key of equal scores."""
        better = np.flatnonzero((score >= best[query, -1]) & (score > 0))
        better = better[np.argsort(query[better], kind="stable")]
        q, begins, many = np.unique(query[better], return_index=True, return_counts=True)
        if not len(q):
            return
        row = np.repeat(np.arange(len(q)), many)
        place = k + np.arange(len(better)) - np.repeat(begins, many)
        value = np.full((len(q), k + many.max()), -1.0)
        value[:, :k] = np.where(best[q] > 0, best[q], -1)
        value[row, place] = score[better]
        all_names = np.full(value.shape, _LAST)
        all_names[:, :k] = names[q]
        all_names[row, place] = name[better]
        first = np.argsort(all_names, axis=1, kind="stable")
        second = np.argsort(-np.take_along_axis(value, first, 1), axis=1, kind="stable")
        order = np.take_along_axis(first, second, 1)[:, :k]
        best[q], names[q] = np.maximum(np.take_along_axis(value, order, 1), 0), np.take_along_axis(all_names, order, 1)


def search(index: DataFrame, queries: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(query_id, rank, doc_id, score)``: the ``k`` best documents of each query, by whole texts.

    Words are runs of ASCII letters, folded, digits and all other characters beyond ASCII; a word
    counts as often as the query has it. Scores are rounded to 9 digits, ties go to the smaller
    document id, null ids last. Documents that share no word with the query are no hits; queries with
    null ids are left out, and those without words have no hits.

    Repeated rows: a query row that repeats, id and text, is one query. Queries that share an id but
    not a text each have ranks from 1 below that id. A document row that repeats counts, and is a
    hit, as often as it stands in the index.
    """
    bags = _query_bags(queries, key, text)
    total = index.agg(F.sum("n"), F.sum("words")).first()
    entries = bags.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-entries // QUERY_ENTRIES))
    found = None
    for part in range(parts):
        own = bags.where(F.pmod(F.xxhash64("key"), F.lit(parts)) == part) if parts > 1 else bags
        rows = [r for r in own.collect() if r["n"]]
        if not rows or not total[0]:
            continue
        block = _query_block(rows)
        n, df = total[0], _frequencies(index, block)
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        block.idf = idf
        hits = _search_block(index, _grouped(block), k, total[1] / n)
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return index.sparkSession.createDataFrame([], "query_id long, rank int, doc_id long, score double")
    window = Window.partitionBy("query_id", "query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "doc_id", "score")


def _search_block(index: DataFrame, groups: list[Queries], k: int, mean: float) -> DataFrame:
    sent = index.sparkSession.sparkContext.broadcast(groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = sent.value
        best = [np.zeros((len(queries.ids), k)) for queries in groups]
        names = [np.full((len(queries.ids), k), _LAST) for queries in groups]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                _arranged(row, mean or 1.0, groups)
                for g, queries in enumerate(groups):
                    Shard(row, queries, mean or 1.0).search(k, best[g], names[g])
        for g, queries in enumerate(groups):
            q, rank = np.nonzero(best[g])
            name = names[g][q, rank]
            yield pa.RecordBatch.from_arrays(
                [pa.array(queries.ids[q]), pa.array(queries.first + q), pa.array(name, mask=name == _LAST), pa.array(best[g][q, rank])],
                ["query_id", "query", "doc_id", "score"],
            )

    return arrow_map(_by_core(index), run, "query_id long, query long, doc_id long, score double")


def _by_core(index: DataFrame) -> DataFrame:
    """The index in two tasks a core.

    Thresholds carry over from shard to shard, and the k hits, or the frequencies, that each task gives for all queries
    are as many as there are cores, not as the data has shards.
    """
    return index.coalesce(2 * index.sparkSession.sparkContext.defaultParallelism)


def op3_bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every document whose id is divisible by 50."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return search(build_index(docs), docs.where("doc_id % 50 = 0"))
