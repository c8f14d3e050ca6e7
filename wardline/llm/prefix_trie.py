"""The prefix trie of conversations, with totals over subtrees by centroid decomposition.

A node is a distinct sequence of first turns, known by a 128-bit digest of the sequence. Each node belongs
to its smallest member; what a conversation owns is the lower end of its path, so the trie is stored as one
row per conversation that owns something: its path of digests, and a stretch of depths. A component of the
trie is named by its top node.

Totals come from centroid decomposition. In each component the centroid is the deepest node that has more
than half of the component below it (itself included). What lies there is added up, the total goes to every
node on the way from the centroid to the top, and the component falls into the part above and one part for
each child of the centroid, none larger than half. Components of over LOCAL nodes are split by Spark, all of
them in one round, so that rounds grow with the logarithm of the trie; smaller ones are split to the end
within a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import arrow_map, table, unsigned_crc32_mod, written

ROOT = bytes(16)
#: Components of up to so many nodes are split within one task.
LOCAL = 20_000
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_lists(turns: DataFrame) -> DataFrame:
    """``(conv_id, turns)``: the turns of a conversation in order, each as its digest and number of words.

    Turns go by ``turn``, null first, those of one number by role and digest of the text. Null role or text
    is empty. Rows without ``conv_id`` belong to no conversation. A conversation is one row of digests.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    words = F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")
    step = F.struct("turn", role.alias("role"), F.md5(text.cast("binary")).alias("tie"), digest.alias("digest"), words.alias("words"))
    lists = turns.where("conv_id is not null").groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(
        F.sort_array(F.collect_list(step)).alias("steps")
    )
    return lists.select("conv_id", F.expr("transform(steps, s -> struct(s.digest, s.words))").alias("turns"))


def branched(lists: DataFrame, every: int = 20, at_most: int = 4) -> DataFrame:
    """Each conversation goes on from the first turns of the one whose number is the multiple of ``every`` below.

    How many of its first turns are replaced, ``h``, is the crc32 of its number modulo ``at_most``.
    """
    with_h = lists.withColumn("h", unsigned_crc32_mod(F.col("conv_id"), at_most).cast("int"))
    base = lists.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("__base"), F.slice("turns", 1, at_most - 1).alias("__first")
    )
    joined = with_h.join(base, F.col("conv_id") - F.col("conv_id") % every == F.col("__base"), "left")
    first = F.coalesce(F.slice("__first", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return joined.select("conv_id", F.concat(first, rest).alias("turns"))


def _paths(lists: DataFrame) -> DataFrame:
    """``(conv_id, path, words)``: the digests of all prefixes, the root's first, and the words of each turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = []
            for digests in batch.column("digests").to_pylist():
                path = [ROOT]
                for digest in digests:
                    path.append(hashlib.md5(path[-1] + digest).digest())
                paths.append(path)
            columns = [batch.column("conv_id"), pa.array(paths, pa.list_(pa.binary())), batch.column("words")]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "path", "words"])

    flat = lists.selectExpr("conv_id", "turns.digest AS digests", "turns.words AS words")
    return arrow_map(flat, run, "conv_id long, path array<binary>, words array<long>")


def ends_digests(paths: DataFrame) -> DataFrame:
    """``(node, ends_sha256)``: the digest of the ids that end at a node, folded row by row in their order."""
    ends = paths.select(F.element_at("path", -1).alias("node"), "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, fold = None, None

        def row() -> pa.RecordBatch:
            columns = [pa.array([node], pa.binary()), pa.array([fold.hexdigest()])]
            return pa.RecordBatch.from_arrays(columns, ["node", "ends_sha256"])

        for batch in batches:
            for key, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
                if key != node:
                    if fold:
                        yield row()
                    node, fold = key, hashlib.sha256(str(conv).encode())
                else:
                    fold.update(b",%d" % conv)
        if fold:
            yield row()

    dealt = ends.repartition("node").sortWithinPartitions("node", "conv_id")
    return arrow_map(dealt, run, "node binary, ends_sha256 string")


def split_totals(parents: list[int], values: list[tuple[int, ...]]) -> list[list[int]]:
    """Totals over subtrees of one tree: ``parents`` of nodes (-1: none), each before its children."""
    width = len(values[0])
    totals = [[0] * width for _ in parents]
    waiting = [list(range(len(parents)))]
    while waiting:
        nodes = waiting.pop()
        if len(nodes) == 1:
            own = totals[nodes[0]]
            for k, x in enumerate(values[nodes[0]]):
                own[k] += x
            continue
        inside = dict.fromkeys(nodes, 1)
        for v in reversed(nodes):
            if parents[v] in inside:
                inside[parents[v]] += inside[v]
        centroid = max(v for v in nodes if 2 * inside[v] > len(nodes))  # the deepest: such nodes lie on one way down
        below, parts, above = {centroid: None}, {}, []
        found = list(values[centroid])
        for v in nodes:
            if v == centroid:
                continue
            if parents[v] in below:
                child = v if parents[v] == centroid else below[parents[v]]
                below[v] = child
                parts.setdefault(child, []).append(v)
                for k, x in enumerate(values[v]):
                    found[k] += x
            else:
                above.append(v)
        v, top = centroid, nodes[0]
        while True:
            for k, x in enumerate(found):
                totals[v][k] += x
            if v == top:
                break
            v = parents[v]
        waiting += [part for part in (above, *parts.values()) if part]
    return totals


def _local_totals(stretches: DataFrame) -> DataFrame:
    """``(node, leaves, saved)`` of components that fit a task, by ``split_totals``."""
    rows = stretches.select(
        "top",
        "conv",
        F.expr("slice(path, lo + 1, hi - lo + 1)").alias("nodes"),
        F.when(F.expr("path[lo] != top"), F.expr("path[greatest(lo - 1, 0)]")).alias("parent"),
        F.expr("slice(saved, lo - first + 1, hi - lo + 1)").alias("saved"),
        F.expr("leaf AND hi = size(path) - 1").alias("leaf"),
    )

    def component(held: list[dict]) -> list[tuple]:
        place: dict[bytes, int] = {}
        parents, values = [], []
        for stretch in held:
            before = -1 if stretch["parent"] is None else place[stretch["parent"]]
            for node, saved in zip(stretch["nodes"], stretch["saved"]):
                parents.append(before)
                before = place[node] = len(values)
                values.append((0, saved))
            if stretch["leaf"]:
                values[before] = (1, values[before][1])
        return [(node, *found) for node, found in zip(place, split_totals(parents, values))]

    def out(found: list[tuple]) -> pa.RecordBatch:
        node, leaves, saved = zip(*found)
        columns = [pa.array(node, pa.binary()), pa.array(leaves, pa.int64()), pa.array(saved, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["node", "leaves", "saved"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, held, found = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                if row["top"] != top and held:
                    found += component(held)
                    held = []
                    if len(found) >= LOCAL:
                        yield out(found)
                        found = []
                top = row["top"]
                held.append(row)
        if held:
            found += component(held)
        if found:
            yield out(found)

    # the stretch that a stretch hangs from has a smaller owner, so it comes first
    dealt = rows.repartition("top").sortWithinPartitions("top", "conv")
    return arrow_map(dealt, run, "node binary, leaves long, saved long")


def _split_round(stretches: DataFrame, sizes: DataFrame, local: int) -> tuple[DataFrame, ...] | None:
    """One round: ``(components that fit a task, parts of the others, added totals, sizes)``; None if all fit."""
    inside = stretches.selectExpr("top", "inline(transform(sequence(lo, hi), d -> struct(path[d] AS node, d AS depth)))")
    inside = written(inside.join(sizes, "node"), "trie-inside")
    tops = inside.groupBy("top").agg(F.max("size").alias("all"), F.min("depth").alias("top_depth"))
    large = written(tops.where(F.col("all") > local), "trie-large")
    if large.isEmpty():
        return None
    centroids = written(
        inside.join(large, "top")
        .where("2 * size > all")
        .groupBy("top", "top_depth")
        .agg(F.min_by(F.struct("node", "depth", "size"), "size").alias("c"))
        .selectExpr("top", "top_depth", "c.node AS centroid", "c.depth AS at", "c.size AS cut"),
        "trie-centroids",
    )
    done = stretches.join(large.select("top"), "top", "left_anti")
    met = stretches.join(centroids, "top").withColumn("hit", F.expr("at < size(path) AND path[least(at, size(path) - 1)] = centroid"))
    met = written(met, "trie-met")
    from_here = "slice(saved, greatest(lo, at) - first + 1, hi - greatest(lo, at) + 1)"
    below = met.where("hit").groupBy("centroid").agg(
        F.sum(F.expr("int(leaf AND hi = size(path) - 1)")).cast("long").alias("leaves"),
        F.sum(F.expr(f"aggregate({from_here}, 0L, (a, x) -> a + x)")).alias("saved"),
    )
    ways = met.where("hit AND at BETWEEN lo AND hi").selectExpr(
        "centroid", "cut", "explode(slice(path, top_depth + 1, at - top_depth + 1)) AS node"
    )
    added = written(ways.join(below, "centroid").select("node", "leaves", "saved", "cut"), "trie-added")
    kept = [c for c in stretches.columns if c not in ("lo", "hi", "top")]
    part = "struct({} AS lo, {} AS hi, {} AS top)"
    child = "path[least(at + 1, size(path) - 1)]"
    parts = met.selectExpr(
        *kept,
        f"""inline(array_compact(CASE
          WHEN NOT hit THEN array({part.format('lo', 'hi', 'top')})
          WHEN at < lo THEN array({part.format('lo', 'hi', child)})
          ELSE array(IF(lo < at, {part.format('lo', 'at - 1', 'top')}, NULL),
                     IF(at < hi, {part.format('at + 1', 'hi', child)}, NULL)) END))""",
    )
    cuts = added.groupBy("node").agg(F.sum("cut").alias("cut"))
    smaller = sizes.join(cuts, "node", "left").selectExpr("node", "size - coalesce(cut, 0) AS size")
    return done, written(parts, "trie-parts"), added.drop("cut"), written(smaller, "trie-sizes")


def prefix_trie(lists: DataFrame, local: int = LOCAL) -> DataFrame:
    """The nodes of the trie of ``(conv_id, turns)``, see ``turn_lists``; ids are distinct.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null at the root), ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``. Conversations without turns are
    members of the root. No conversation gives no node.
    """
    paths = written(_paths(lists), "trie-paths")
    # copies are one chain
    chains = paths.groupBy(F.element_at("path", -1).alias("end")).agg(
        F.min("conv_id").alias("conv"), F.count("*").alias("n"), F.first(F.struct("path", "words")).alias("p")
    )
    chains = written(chains.select("conv", "n", "end", "p.path", "p.words"), "trie-chains")
    steps = chains.selectExpr(
        "conv",
        "n",
        """inline(transform(path, (x, i) -> struct(x AS node, i AS depth,
          IF(i > 0, path[greatest(i - 1, 0)], NULL) AS parent, IF(i > 0, words[greatest(i - 1, 0)], 0L) AS last_words)))""",
    )
    nodes = written(
        steps.groupBy("node").agg(
            F.min("conv").alias("conv_id"),
            F.sum("n").alias("n_convs"),
            F.first("depth").alias("depth"),
            F.first("parent").alias("parent"),
            F.first("last_words").alias("last_words"),
        ),
        "trie-nodes",
    )
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    root = nodes.where("depth = 0").select("conv_id").first()
    root_conv = F.lit(root["conv_id"] if root else None).cast("long")
    # what a conversation owns: every node below the root meets its owner; the root is one row and known
    owner = nodes.select("node", F.col("conv_id").alias("owner"), F.col("n_convs").alias("members"))
    owners = steps.where("depth > 0").join(owner, "node")
    mine = F.col("owner") == F.col("conv")
    saved = F.struct("depth", ((F.col("members") - 1) * F.col("last_words")).alias("saved"))
    owned = owners.groupBy("conv").agg(
        F.min(F.when(mine, F.col("depth"))).alias("lowest"),
        F.max(F.when(~mine, F.struct("depth", "owner"))).alias("above"),
        F.sort_array(F.collect_list(F.when(mine, saved))).alias("saved"),
    )
    is_root = F.col("conv") == root_conv
    stretches = (
        chains.join(owned, "conv", "left")
        .join(children.withColumnRenamed("node", "end"), "end", "left")
        .select(
            "conv",
            "path",
            F.when(is_root, 0).otherwise(F.col("lowest")).alias("first"),
            F.when(is_root, None).otherwise(F.coalesce("above.owner", root_conv)).alias("above"),
            F.when(is_root, F.concat(F.array(F.lit(0).cast("long")), F.coalesce("saved.saved", F.array().cast("array<bigint>"))))
            .otherwise(F.col("saved.saved"))
            .alias("saved"),
            F.col("n_children").isNull().alias("leaf"),
        )
    )
    stretches = written(stretches, "trie-stretches")
    owning = stretches.where("first is not null")
    above = owning.select(F.col("conv").alias("conv_id"), "first", "above")
    parts = owning.drop("above").selectExpr("*", "first AS lo", "size(path) - 1 AS hi", "path[0] AS top")
    ready, added = parts, []
    if nodes.count() > local:
        length = "CASE WHEN first IS NULL THEN 0 WHEN depth >= first THEN size - depth ELSE size - first END"
        sizes = (
            stretches.selectExpr("first", "size(path) AS size", "inline(transform(path, (x, i) -> struct(x AS node, i AS depth)))")
            .groupBy("node")
            .agg(F.sum(F.expr(length)).cast("long").alias("size"))
        )
        sizes, fitting = written(sizes, "trie-sizes"), []
        while split := _split_round(parts, sizes, local):
            done, parts, more, sizes = split
            fitting.append(done)
            added.append(more)
        ready = parts
        for done in fitting:
            ready = ready.unionByName(done)
    totals = _local_totals(ready)
    for more in added:
        totals = totals.unionByName(more)
    totals = totals.groupBy("node").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    placed = nodes.join(totals, "node").join(children, "node", "left").join(ends_digests(paths), "node", "left")
    return placed.join(above, "conv_id").select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        F.when(F.col("depth") > F.col("first"), F.col("conv_id")).otherwise(F.col("above")).alias("parent_conv_id"),
        "n_convs",
        F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all ``conversations``, each going on from the first turns of another."""
    return prefix_trie(branched(turn_lists(table(spark, sf_dir, "conversations"))))


OP12_SQL = r"""
WITH crc AS (
  SELECT list(list_reduce(range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)
    ORDER BY i) AS tab FROM range(256) r(i)),
own AS (
  SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, ''))
    ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
headed AS (
  SELECT conv_id, turns, xor(list_reduce(
    list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ord(substr(conv_id::VARCHAR, i, 1))::BIGINT),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 4 AS h
  FROM own, crc),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.turns[1:o.h], []), o.turns[o.h + 1:]) AS turns
  FROM headed o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
nodes AS (
  SELECT turns[1:d] AS prefix, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(turns) = d)), sha256('')) AS ends_sha256
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt) GROUP BY ALL),
counted AS (
  SELECT n.*, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.prefix[1:n.depth] = n.prefix) AS n_children,
    CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(prefix[depth].t, '[^\x20\x09-\x0D]+')) END AS saved
  FROM nodes n),
summed AS (
  SELECT prefix[1:a] AS prefix, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM counted) GROUP BY ALL)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, s.n_leaves, s.saved_tokens, c.ends_sha256
FROM counted c JOIN summed s USING (prefix) LEFT JOIN nodes p ON p.depth = c.depth - 1 AND p.prefix = c.prefix[1:c.depth - 1]"""
