"""Importance resampling against plain Python."""

import hashlib
import math
import re
from zlib import crc32

import numpy as np
from pyspark.sql import functions as F

from wardline.llm.importance import (
    bucket_gains,
    drawn,
    feature_buckets,
    gain_planes,
    importance,
    plane_weight,
    resampled,
)

SCHEMA = "doc_id long, text string, score string, rank long, bucket int"


def plain_features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [crc32(r.encode()) % 10000 for r in runs]


def plain(rows, target, percent=5):
    s, t = np.zeros(10000, int), np.zeros(10000, int)
    for _, text in rows:
        np.add.at(s, np.array(plain_features(text)[1], int), 1)
    for text in target:
        np.add.at(t, np.array(plain_features(text)[1], int), 1)
    S, T = int(s.sum()), int(t.sum())
    gain = [math.floor(1000 * math.log(((b + 1) * (S + 10000)) / ((a + 1) * (T + 10000)))) for a, b in zip(s.tolist(), t.tolist())]
    found = []
    for key, text in rows:
        n, buckets = plain_features(text)
        weight = sum(gain[b] for b in buckets)
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        found.append([key, n, len(buckets), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    able = sorted((r for r in found if r[1] >= 20), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    wanted = len(able) * percent // 100
    ranked = [(*r, i + 1 if i < wanted else None) for i, r in enumerate(able)]
    return ranked + [(*r, None) for r in found if r[1] < 20]


def texts():
    rng = np.random.default_rng(3)
    vocabulary = ["alpha", "Beta", "gamma", "ÉTÉ", "x2", "日本", "the", "of"]
    rows = [(i, " ".join(rng.choice(vocabulary, int(rng.integers(0, 60))))) for i in range(120)]
    rows += [(None, None), (None, "the " * 40), (200, ""), (201, "--- !! \n"), (202, "one two"), (203, "The-of " * 3000)]
    return rows + [(300, "the of alpha " * 9)] * 15 + [(-4, "the of alpha " * 9)]


def test_planes_sum_exactly():
    rng = np.random.default_rng(1)
    gains = rng.integers(-20000, 20000, 10000)
    buckets = np.concatenate([rng.integers(0, 10000, 5000), np.full(70001, 17), np.full(3, 9999)]).astype(np.uint32)
    assert plane_weight(buckets, gain_planes(gains)) == int(gains[buckets].sum())
    assert plane_weight(buckets, gain_planes(np.zeros(10000, np.int64))) == 0
    assert plane_weight(buckets[:0], gain_planes(gains)) == 0
    assert bucket_gains(np.zeros(10000, int), np.zeros(10000, int)).tolist() == [0] * 10000


def test_features():
    for _, text in texts():
        n, buckets = feature_buckets((text or "").encode())
        assert (n, sorted(buckets.tolist())) == (plain_features(text)[0], sorted(plain_features(text)[1]))


def test_same_as_plain_python(spark):
    rows, target = texts(), ["gamma ÉTÉ of", None, "x2 x2 x2", ""]
    docs = spark.createDataFrame([(k, t, "own", 7, 1) for k, t in rows], SCHEMA)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    for percent in (5, 37, 100, 0):
        got = drawn(importance(docs, wanted), percent=percent).select("doc_id", "n_words", "n_features", "weight", "score", "rank")
        key = lambda r: tuple((v is not None, v or 0) for v in r)
        assert sorted(map(tuple, got.collect()), key=key) == sorted(plain(rows, target, percent), key=key), percent


def test_resampled_rows_keep_their_columns(spark):
    rows = texts()
    docs = spark.createDataFrame([(k, t, "own", 7, 1) for k, t in rows], SCHEMA)
    wanted = spark.createDataFrame([("gamma ÉTÉ of",)], "text string")
    kept = resampled(docs, wanted, percent=30)
    assert kept.columns == docs.columns
    keys = {r[0] for r in plain(rows, ["gamma ÉTÉ of"], 30) if r[5] is not None}
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in docs.collect() if r.doc_id in keys)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "one two three")], "doc_id long, text string")
    none = docs.limit(0)
    assert drawn(importance(none, docs.select("text"))).count() == 0
    only = drawn(importance(docs, none.select("text"))).collect()
    assert [(r.doc_id, r.n_features, r["rank"]) for r in only] == [(1, 6, None)]


def test_repeated_rows_take_ranks_in_turn(spark):
    docs = spark.range(100).select(F.lit(5).cast("long").alias("doc_id"), F.lit("word " * 30).alias("text"))
    ranks = drawn(importance(docs, docs.select("text")), percent=50).groupBy("rank").count().collect()
    assert sorted((r["rank"] or 0, r["count"]) for r in ranks) == [(0, 50), *((i, 1) for i in range(1, 51))]
