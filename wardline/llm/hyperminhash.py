"""Near-duplicates by HyperMinHash: compressed minima, banded, estimated, then verified on whole sets.

A text's set of word shingles is hashed once. The hash's first bits choose one of REGISTERS buckets; a
bucket's register holds the minimum of the rest as its number of leading zeros and MANTISSA further bits, 16
bits in all. Bands of ROWS registers find candidates; there an empty register stands for the full one that
comes first in an order of its own, so that sets of any size agree in a register with a chance of their
similarity. Candidates whose estimated similarity, corrected for registers that agree by accident, is
five standard errors below the limit go; all others are decided by their two sets.

Equal sets are one node. Plausible pairs are looked for first, by registers: in a band every node meets the smallest one,
and where that leaves a band in several clusters, all nodes of different clusters meet. Then the sets of a cluster
meet, once each. No pairs leave a task but those that connect what was not connected, so what travels grows with the nodes.
At a similarity s a band of r registers joins with a chance of s^r. As many bands are used as leave out MISSED of
the pairs at the limit: 47 of 5 registers at 0.8.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import arrow_map, as_bytes, mixed, rolling, slices, table, word_hashes, written
from wardline.llm.components import connected

REGISTERS, MANTISSA = 256, 10
#: The share of pairs at the limit that no band joins.
MISSED = 1e-8
#: Nodes, and shingles, of a band or cluster that a task compares with as many others at once.
BLOCK, SHINGLES = 2048, 1 << 20
#: Standard errors that an estimate may lie below the limit.
ERRORS = 5.0
_RNG = np.random.default_rng(13)
#: For each register the order in which full ones stand in for it.
_TURN = np.argsort(_RNG.random((REGISTERS, REGISTERS)), axis=1).astype(np.int16)
_WEIGHTS = _RNG.integers(0, 1 << 63, REGISTERS, np.uint64) | np.uint64(1)
_BAND = mixed(np.arange(1, REGISTERS + 1, dtype=np.uint64))


def band_shape(percent: int) -> tuple[int, int]:
    """The longest bands, and their number, that miss no more than MISSED; raises if there are too few registers."""
    for rows in range(8, 0, -1):
        number = math.ceil(math.log(MISSED) / math.log1p(-((percent / 100) ** rows)))
        if rows * number <= REGISTERS:
            return number, rows
    raise ValueError(f"{REGISTERS} registers cannot tell a similarity of {percent} %")


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; of all words if they are fewer; none without words."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    width = min(width, len(words))
    return np.unique(rolling(word_hashes(words), width, 0x9E3779B97F4A7C15) ^ np.uint64(width))


def registers(hashes: np.ndarray) -> np.ndarray:
    """Registers of sorted distinct hashes: leading zeros plus one, then the mantissa; 0 where nothing fell."""
    found = np.zeros(REGISTERS, np.uint16)
    if not len(hashes):
        return found
    bucket = (hashes >> np.uint64(56)).astype(np.int64)
    least = np.flatnonzero(np.diff(bucket, prepend=-1))
    rest = hashes[least] << np.uint64(8)
    filled = rest.copy()
    for step in (1, 2, 4, 8, 16, 32):
        filled |= filled >> np.uint64(step)
    zeros = np.minimum(64 - np.bitwise_count(filled).astype(np.uint64), np.uint64(56))
    after = (rest << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    found[bucket[least]] = ((zeros + np.uint64(1)) << np.uint64(MANTISSA)) | after
    return found


def bands(found: np.ndarray, number: int, rows: int) -> np.ndarray:
    """A hash of each band, empty registers filled."""
    full = np.flatnonzero(found)
    if len(full) < REGISTERS:
        stand_in = full[_TURN[:, full].argmin(axis=1)]
        found = np.where(found > 0, found, found[stand_in])
    values = found[: number * rows].reshape(number, rows).astype(np.uint64)
    with np.errstate(over="ignore"):
        return mixed((values * _WEIGHTS[:rows]).sum(axis=1, dtype=np.uint64) + _BAND[:number])


def accidents(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The chance that registers of two sets of these sizes agree though their minima differ."""
    zeros = np.arange(57)

    def share(n: np.ndarray) -> np.ndarray:
        load = (n / REGISTERS)[:, None]
        return np.exp(-load * 0.5 ** (zeros + 1)) - np.exp(-load * 0.5**zeros)

    either = (1 - np.exp(-a / REGISTERS)) * (1 - np.exp(-b / REGISTERS))
    return (share(a) * share(b)).sum(axis=1) / np.maximum(either, 1e-9) * 0.5**MANTISSA


def estimated(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated similarity of register rows, and the number of registers it rests on."""
    used = ((x > 0) | (y > 0)).sum(axis=1)
    same = ((x == y) & (x > 0)).sum(axis=1) / np.maximum(used, 1)
    chance = accidents(a, b)
    return (same - chance) / (1 - chance), used


def _plausible(estimate: np.ndarray, used: np.ndarray, limit: float) -> np.ndarray:
    return estimate >= limit - ERRORS * np.sqrt(limit * (1 - limit) / np.maximum(used, 1))


def _rows_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def sketches(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``(key, text_hash, n, same, registers)`` for every row; ``same`` is a hash of the whole set, ``n`` its size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = [shingle_set(t, width) for t in as_bytes(batch.column("text"))]
            same = [int(mixed(s).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0 for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("text_hash"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(same, pa.int64()),
                    pa.array([registers(s).tobytes() for s in sets], pa.binary()),
                ],
                ["key", "text_hash", "n", "same", "registers"],
            )

    picked = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    kind = dict(picked.dtypes)["key"]
    return arrow_map(picked, run, f"key {kind}, text_hash long, n long, same long, registers binary")


def _banded(nodes: DataFrame, number: int, rows: int) -> DataFrame:
    """``(same, band)``, a row for each band of a node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = np.concatenate([bands(r, number, rows) for r in _rows_of(batch.column("registers"))])
                same = np.repeat(batch.column("same").to_numpy(), number)
                yield pa.RecordBatch.from_pydict({"same": same, "band": found.view(np.int64)})

    return arrow_map(nodes.select("same", "registers"), run, "same long, band long")


def _estimated_pairs(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The ``(a, b)`` whose sizes and registers allow the similarity."""
    of = lambda x: nodes.select(F.col("same").alias(x), F.col("n").alias(f"n{x}"), F.col("registers").alias(f"r{x}"))
    met = pairs.join(of("a"), "a").join(of("b"), "b").where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = _rows_of(batch.column("ra")), _rows_of(batch.column("rb"))
                found, used = estimated(x, y, batch.column("na").to_numpy(), batch.column("nb").to_numpy())
                near = pa.array(_plausible(found, used, percent / 100))
                yield batch.select(["a", "b"]).filter(near)

    return arrow_map(met.select("a", "b", "na", "nb", "ra", "rb"), run, "a long, b long")


def _sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``(same, grams)`` of the nodes whose representing row is in ``wanted``: ``(__key, __hash)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = [shingle_set(t, width) for t in as_bytes(batch.column("text"))]
            same = [int(mixed(s).sum(dtype=np.uint64).view(np.int64)) for s in sets]
            grams = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(same, pa.int64()), grams], ["same", "grams"])

    rows = docs.select(F.col(key).alias("__own"), F.col(text).alias("text"), F.xxhash64(text).alias("__text"))
    rows = rows.join(wanted, F.col("__own").eqNullSafe(F.col("__key")) & (F.col("__text") == F.col("__hash")), "left_semi")
    return arrow_map(rows.select("text"), run, "same long, grams array<long>").dropDuplicates(["same"])


class _Forest:
    """Which of a cell's nodes are connected, and the links that connect them: a forest, not all pairs.

    ``near(x)`` compares a node with all others. Nodes that are connected with what is the largest tree
    after some first comparisons need none of their own: any other node is compared with them.
    """

    def __init__(self, same: np.ndarray, label: np.ndarray):
        self.same, self.label = same, label.copy()
        self.links: list[tuple[int, int]] = []

    def _join(self, x: int, others: np.ndarray) -> None:
        mine = self.label[x]
        names, first = np.unique(self.label[others], return_index=True)
        for y in others[first[names != mine]]:
            self.links.append((int(self.same[x]), int(self.same[y])))
        self.label[np.isin(self.label, names)] = mine

    def grow(self, near: Callable[[int], np.ndarray], first: int = 8) -> None:
        n = len(self.same)
        for x in range(min(first, n)):
            self._join(x, near(x))
        names, counts = np.unique(self.label, return_counts=True)
        trunk = int(np.flatnonzero(self.label == names[counts.argmax()])[0])
        for x in range(first, n):
            if self.label[x] != self.label[trunk]:
                self._join(x, near(x))

    def batch(self) -> Iterator[pa.RecordBatch]:
        if self.links:
            pairs = np.array(self.links, np.int64)
            yield pa.RecordBatch.from_pydict({"a": pairs[:, 0], "b": pairs[:, 1]})


def _by_cell(dealt: DataFrame, marks: list[str], cell: Callable[[pa.Table], Iterator[pa.RecordBatch]]) -> DataFrame:
    """Run ``cell`` on the rows of each combination of ``marks``, which go to one task; gives links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.stack([batch.column(c).to_numpy() for c in marks])
            cuts = [0, *(np.flatnonzero((np.diff(values) != 0).any(axis=0)) + 1), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                mark = values[:, a].tolist()
                if held and mark != current:
                    yield from cell(pa.Table.from_batches(held).combine_chunks())
                    held = []
                current = mark
                held.append(batch.slice(a, b - a))
        if held:
            yield from cell(pa.Table.from_batches(held).combine_chunks())

    return arrow_map(dealt.repartition(*marks).sortWithinPartitions(*marks), run, "a long, b long")


def _celled(rows: DataFrame, group: str) -> DataFrame:
    """Deal a group's rows out to ``blocks`` blocks, and every pair of blocks to a cell ``(group, i, j)``."""
    mine = F.pmod(F.xxhash64("same"), F.col("blocks"))
    others = F.expr("IF(blocks = 1, array(0L), filter(sequence(0L, blocks - 1), x -> x != mine))")
    return (
        rows.withColumn("mine", mine)
        .withColumn("other", F.explode(others))
        .withColumn("i", F.least("mine", "other"))
        .withColumn("j", F.greatest("mine", "other"))
        .drop("mine", "other", "blocks")
    )


def _open_bands(members: DataFrame, clusters: DataFrame) -> DataFrame:
    """``(band, same, root, blocks)`` of the bands that hold several clusters."""
    label = F.coalesce("root", "same").alias("root")
    placed = members.join(clusters, F.col("same") == F.col("node"), "left").select("band", "same", label)
    several = placed.groupBy("band").agg(F.min("root").alias("r"), F.max("root").alias("s"), F.count("*").alias("n"))
    several = several.where("r != s").select("band", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    return written(placed.join(several, "band"), "hmh-open")


def _plausible_links(placed: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Links that connect all plausible pairs of a band, by registers alone."""
    limit = percent / 100

    def cell(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        size, found = rows.column("size").to_numpy(), _rows_of(rows.column("registers"))
        forest = _Forest(rows.column("same").to_numpy(), rows.column("root").to_numpy())

        def near(x: int) -> np.ndarray:
            at = np.flatnonzero(100 * np.minimum(size, size[x]) >= percent * np.maximum(size, size[x]))
            estimate, used = estimated(found[at], found[x][None, :], size[at], np.full(len(at), size[x]))
            return at[_plausible(estimate, used, limit)]

        forest.grow(near)
        yield from forest.batch()

    dealt = _celled(placed, "band").join(nodes.select("same", F.col("n").alias("size"), "registers"), "same")
    return _by_cell(dealt, ["band", "i", "j"], cell).distinct()


def _verified_links(sets: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    """Links that connect all pairs of a cluster whose sets are similar enough."""
    sized = written(clusters.join(sets, F.col("node") == F.col("same")).select("root", "same", "grams"), "hmh-sets")
    loads = sized.groupBy("root").agg(F.count("*").alias("n"), F.sum(F.size("grams").cast("long")).alias("load"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("load") / SHINGLES)).alias("blocks")

    def cell(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        grams = rows.column("grams").combine_chunks()
        ends = np.cumsum(pc.list_value_length(grams).to_numpy(zero_copy_only=False).astype(np.int64))
        begins = np.concatenate([[0], ends[:-1]])
        size = ends - begins
        _, ids = np.unique(grams.flatten().to_numpy(), return_inverse=True)
        held = np.zeros(int(ids.max()) + 1, bool)
        forest = _Forest(rows.column("same").to_numpy(), np.arange(len(size)))

        def near(x: int) -> np.ndarray:
            mine = ids[begins[x] : ends[x]]
            held[mine] = True
            both = np.add.reduceat(held[ids], begins, dtype=np.int64)
            held[mine] = False
            return np.flatnonzero(100 * both >= percent * (size + size[x] - both))

        forest.grow(near)
        yield from forest.batch()

    dealt = _celled(sized.join(loads.select("root", blocks), "root"), "root")
    return _by_cell(dealt, ["root", "i", "j"], cell).distinct()


def similar_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 80,
    also: DataFrame | None = None,
) -> DataFrame:
    """``(key, n, group)`` for every row: set size, and the smallest key reachable over links.

    Two rows are linked if the sets of their word shingles have ``percent`` hundredths of their union in
    common. A text with fewer words than ``width`` has one shingle, all its words. A text without words,
    or null, has none and is linked with nothing: its group is its own key. Repeated rows are one node. Null keys
    stay, but name no group unless it has no other key. An empty table gives no rows. Shingles and sets
    are compared by 64-bit hashes. Columns but key and text are ignored.

    ``also`` are candidates of another search, ``(one, two)`` keys whose sets are to meet as well.
    """
    marked = written(sketches(docs, key, text, width), "hmh-sketches")
    nodes = marked.where("n > 0").groupBy("same").agg(
        F.min("key").alias("least"),
        F.first("n").alias("n"),
        F.first("registers").alias("registers"),
        F.min(F.struct("key", "text_hash")).alias("row"),
    )
    nodes = written(nodes, "hmh-nodes")
    # below this size only equal sets are similar enough
    able = nodes.where(F.col("n") * 100 >= percent * (F.col("n") + 1))
    banded = written(_banded(able, *band_shape(percent)), "hmh-bands")
    shared = banded.groupBy("band").agg(F.min("same").alias("low"), F.count("*").alias("__n")).where("__n > 1")
    members = written(banded.join(shared.select("band", "low"), "band"), "hmh-members")
    star = members.where("low != same").select(F.col("low").alias("a"), F.col("same").alias("b")).distinct()
    plausible = written(_estimated_pairs(star, nodes, percent), "hmh-plausible")
    if also is not None:
        node = marked.where("n > 0").select("key", "same").distinct()
        found = also.join(node.withColumnRenamed("same", "a"), F.col("one") == F.col("key")).drop("key")
        found = found.join(node.withColumnRenamed("same", "b"), F.col("two") == F.col("key"))
        plausible = written(plausible.union(found.where("a != b").select("a", "b").distinct()), "hmh-plausible")
    clusters = connected(plausible)
    placed = _open_bands(members, clusters)
    if not placed.isEmpty():
        plausible = written(plausible.union(_plausible_links(placed, nodes, percent)), "hmh-plausible")
        clusters = connected(plausible)
    # the smallest node of a cluster has no row of its own
    roots = clusters.select("root").distinct()
    clusters = written(clusters.union(roots.select(F.col("root").alias("node"), "root")).distinct(), "hmh-clusters")
    wanted = clusters.join(nodes, F.col("node") == F.col("same")).select(
        F.col("row.key").alias("__key"), F.col("row.text_hash").alias("__hash")
    )
    links = _verified_links(_sets(docs, wanted, key, text, width), clusters, percent)
    roots = connected(links)
    label: Column = F.coalesce("root", "same").alias("root")
    rooted = nodes.select("same", "least").join(roots, F.col("same") == F.col("node"), "left").select("same", "least", label)
    named = rooted.groupBy("root").agg(F.min("least").alias("__group"))
    groups = rooted.join(named, "root").select(F.col("same").alias("__same"), "__group")
    placed = marked.select("key", "n", F.when(F.col("n") > 0, F.col("same")).alias("same"))
    found = placed.join(groups, F.col("same") == F.col("__same"), "left")
    group = F.when(F.col("n") > 0, F.col("__group")).otherwise(F.col("key")).alias("group")
    return found.select(F.col("key").alias(key), "n", group)


def op13_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document's set of two-word shingles, and its group at a similarity of 0.8."""
    found = similar_groups(table(spark, sf_dir, "documents"), width=2, percent=80)
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.col("group").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.col("group")).alias("kept"),
    )


OP13_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingled AS (
  SELECT row_id, doc_id, CASE WHEN len(w) < 2 THEN w ELSE
    list_sort(list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) END AS s FROM worded),
sets AS (SELECT s, row_number() OVER () AS sid, len(s) AS n FROM (SELECT DISTINCT s FROM shingled WHERE len(s) > 0)),
flat AS (SELECT sid, n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.sid AS a, b.sid AS b FROM flat a JOIN flat b ON a.g = b.g AND a.sid <> b.sid
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.sid, b.sid, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
  SELECT sid AS a, sid AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
labelled AS (
  SELECT r.a AS sid, min(d.doc_id) AS component_id
  FROM reach r JOIN sets t ON t.sid = r.b JOIN shingled d ON d.s = t.s GROUP BY r.a)
SELECT d.doc_id, len(d.s) AS n_shingles,
  CASE WHEN len(d.s) = 0 THEN d.doc_id ELSE l.component_id END AS component_id,
  d.doc_id IS NOT DISTINCT FROM CASE WHEN len(d.s) = 0 THEN d.doc_id ELSE l.component_id END AS kept
FROM shingled d LEFT JOIN sets t ON t.s = d.s LEFT JOIN labelled l ON l.sid = t.sid"""
