"""Importance resampling towards a target corpus, with bit-sliced sums.

Runs of 1 to 3 words fall into BUCKETS buckets; a bucket's gain is a whole number that says how much
more often the target fills it. A document's counts per bucket become bit planes of BUCKETS bits: plane
``k`` holds bit ``k`` of every count. The gains are planes as well, one set for the positive and one for
the negative ones. A plane of counts AND a plane of gains is a set of buckets, its number of bits times a
power of two is that pair's share of the weight, and the shares add up to the weight exactly.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from wardline.llm.common import arrow_map, as_bytes, slices, table, written

BUCKETS = 10_000
#: Planes are whole 64-bit words.
_PADDED = -(-BUCKETS // 64) * 64
#: Lower-cases A-Z; digits, letters and all bytes of other scripts stay, anything else is a blank.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
#: Repeated rows are written out in steps of this many.
_RUN = 1 << 16


def feature_buckets(text: bytes) -> tuple[int, np.ndarray]:
    """The number of words, and the bucket of each run of 1, 2 and 3 words, repeats included."""
    words = text.translate(_WORD_BYTES).split()
    one = list(map(crc32, words))
    further = [b" " + w for w in words]  # a longer run continues the checksum of the shorter one
    two = list(map(crc32, further[1:], one))
    three = list(map(crc32, further[2:], two))
    return len(words), np.array(one + two + three, np.uint32) % BUCKETS


def bucket_totals(texts: DataFrame, text: str = "text") -> np.ndarray:
    """Features per bucket over all rows. Each task sends BUCKETS numbers at most; so does the result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in slices(batches, "text"):
            for value in as_bytes(batch.column("text")):
                total += np.bincount(feature_buckets(value)[1], minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": some, "n": total[some]})

    rows = arrow_map(texts.select(F.col(text).alias("text")), run, "bucket long, n long")
    totals = np.zeros(BUCKETS, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        totals[r["bucket"]] = r["n"]
    return totals


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousand times the logarithm of how the target's smoothed share exceeds the source's, rounded down."""
    s_all, t_all = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    ratios = ((target + 1.0) * s_all) / ((source + 1.0) * t_all)
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


@dataclass
class GainPlanes:
    """Bit planes of signed gains: ``planes[j]`` counts ``worth[j]`` for each of its bits."""

    planes: np.ndarray
    worth: np.ndarray


def _planes(values: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 on as bit planes of 64-bit words, lowest bit first."""
    padded = np.zeros(_PADDED, np.int64)
    padded[: len(values)] = values
    depth = int(padded.max()).bit_length()
    bits = (padded[None, :] >> np.arange(depth)[:, None]) & 1
    return np.packbits(bits.astype(bool), axis=1, bitorder="little").view(np.uint64)


def gain_planes(gains: np.ndarray) -> GainPlanes:
    up, down = _planes(np.maximum(gains, 0)), _planes(np.maximum(-gains, 0))
    worth = [1 << j for j in range(len(up))] + [-(1 << j) for j in range(len(down))]
    return GainPlanes(np.concatenate([up, down]), np.array(worth, np.int64))


def plane_weight(buckets: np.ndarray, gains: GainPlanes) -> int:
    """The sum of the gains of all features, out of planes of their counts."""
    if not len(buckets):
        return 0
    weight = 0
    for k, plane in enumerate(_planes(np.bincount(buckets, minlength=BUCKETS))):
        shared = np.bitwise_count(plane[None, :] & gains.planes).sum(axis=1, dtype=np.int64)
        weight += int(shared @ gains.worth) << k
    return weight


def noise(key: str, seed: int = 42) -> int:
    """Gumbel noise in thousandths, rounded down, from a key as text."""
    h = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def importance(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 42) -> DataFrame:
    """``(key, n_words, n_features, weight, score)`` for every row of ``docs``, against all rows of ``target``.

    Whole texts count; null is a text without words, which has weight 0. Without any target row the gains
    compare with an even share. The score is the weight plus noise drawn from the key (a null key: from the
    empty text), so equal keys draw alike. Columns but key and text are ignored.
    """
    gains = gain_planes(bucket_gains(bucket_totals(docs, text), bucket_totals(target, text)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            n_words, n_features, weights = [], [], []
            for value in as_bytes(batch.column("text")):
                n, found = feature_buckets(value)
                n_words.append(n)
                n_features.append(len(found))
                weights.append(plane_weight(found, gains))
            drawn = [w + noise(k, seed) for w, k in zip(weights, batch.column("named").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *(pa.array(x, pa.int64()) for x in (n_words, n_features, weights, drawn))],
                ["key", "n_words", "n_features", "weight", "score"],
            )

    named = F.coalesce(F.col(key).cast("string"), F.lit("")).alias("named")
    picked = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), named)
    schema = f"key {dict(picked.dtypes)['key']}, n_words long, n_features long, weight long, score long"
    return arrow_map(picked, run, schema).withColumnRenamed("key", key)


def drawn(scored: DataFrame, key: str = "doc_id", percent: int = 5, least_words: int = 20) -> DataFrame:
    """``scored`` (from ``importance``) with ``rank``: 1, 2, 3... for the drawn rows, null for all others.

    Of the rows with ``least_words`` words or more, ``percent`` in a hundred (rounded down) are drawn: the
    highest scores, ties by the smaller key, a null key before all; repeated rows take ranks one after the
    other. Scores are dealt out by range, so a range's ranks begin after the counts of the ranges above it:
    no task sees all rows. Rows that repeat are one row with a number until their ranks are written out.
    """
    spark = scored.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8)
    scored = written(scored, "scores")
    able = scored.where(F.col("n_words") >= least_words).repartitionByRange(parts, F.desc("score"))
    able = written(able.withColumn("__range", F.spark_partition_id()), "score-ranges")
    unable = scored.where(F.col("n_words") < least_words)
    counts = sorted((r["__range"], r["n"]) for r in able.groupBy("__range").agg(F.count("*").alias("n")).collect())
    wanted = sum(n for _, n in counts) * percent // 100
    above, begins = 0, []
    for part, n in counts:
        if above >= wanted:
            break
        begins.append((part, above))
        above += n
    last = begins[-1][0] if begins else -1
    # as many rows as there are ranges
    before = spark.createDataFrame(begins, "__range int, __before long")
    names = scored.columns
    once = able.where(F.col("__range") <= last).groupBy("__range", *names).agg(F.count("*").alias("__n"))
    running = F.sum("__n").over(
        _ordered("__range", F.desc("score"), F.asc_nulls_first(key), *(n for n in names if n not in ("score", key)))
    )
    placed = once.withColumn("__end", running).join(F.broadcast(before), "__range")
    first = F.col("__before") + F.col("__end") - F.col("__n") + 1
    runs = placed.select(*names, first.alias("__first"), (F.col("__before") + F.col("__end")).alias("__last"))
    runs = runs.withColumn("__from", F.explode(F.expr(f"sequence(__first, __last, {_RUN}L)")))
    ranks = runs.withColumn("rank", F.explode(F.expr(f"sequence(__from, least(__from + {_RUN - 1}L, __last))")))
    ranked = ranks.select(*names, F.when(F.col("rank") <= wanted, F.col("rank")).alias("rank"))
    rest = able.where(F.col("__range") > last).select(*names).unionByName(unable)
    return ranked.unionByName(rest.withColumn("rank", F.lit(None).cast("long")))


def _ordered(part: str, *order: Column | str) -> WindowSpec:
    return Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def resampled(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 5) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose key is drawn."""
    ranks = drawn(importance(docs, target, key, text), key, percent).where("rank is not null")
    keys = ranks.select(F.col(key).alias("__drawn")).distinct()
    return docs.join(keys, docs[key].eqNullSafe(keys["__drawn"]), "left_semi")


def op11_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight and score of every document towards ``benchmark``, and the ranks of the drawn twentieth."""
    scored = importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn(scored).select("doc_id", "n_features", "weight", "score", "rank", "n_words")


#: DuckDB has no crc32: its table is made by rule, and each distinct run of words is folded byte by byte.
OP11_SQL = r"""
WITH crc AS (
  SELECT list(list_reduce(range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)
    ORDER BY i) AS tab FROM range(256) r(i)),
texts AS (
  SELECT 'd' AS side, rowid AS row_id, doc_id, text FROM (SELECT row_number() OVER () AS rowid, * FROM documents)
  UNION ALL SELECT 'b', NULL, NULL, text FROM benchmark),
worded AS (
  SELECT side, row_id, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
runs AS (
  SELECT side, row_id, unnest(list_concat(w, list_concat(
    list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))) AS f FROM worded),
hashed AS (
  SELECT f, xor(list_reduce(
    list_transform(range(1, octet_length(encode(f)) + 1), lambda i: ('0x' || substr(hex(encode(f)), 2 * i - 1, 2))::BIGINT),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM runs), crc),
bucketed AS (SELECT side, row_id, bucket, count(*) AS n FROM runs JOIN hashed USING (f) GROUP BY ALL),
totals AS (
  SELECT coalesce(sum(n) FILTER (WHERE side = 'd'), 0)::DOUBLE AS s,
    coalesce(sum(n) FILTER (WHERE side = 'b'), 0)::DOUBLE AS t FROM bucketed),
gains AS (
  SELECT bucket, floor(1000 * ln(((b + 1) * (s + 10000)) / ((a + 1) * (t + 10000))))::BIGINT AS gain
  FROM (SELECT bucket, coalesce(sum(n) FILTER (WHERE side = 'd'), 0)::DOUBLE AS a,
      coalesce(sum(n) FILTER (WHERE side = 'b'), 0)::DOUBLE AS b FROM bucketed GROUP BY bucket), totals),
weighed AS (
  SELECT row_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
  FROM bucketed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY row_id),
scored AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
      + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM worded LEFT JOIN weighed USING (row_id) WHERE side = 'd'),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS FIRST) AS place,
    count(*) OVER (PARTITION BY n_words >= 20) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 5 * n // 100 THEN place END AS rank, n_words
FROM placed"""
