"""Near copies with edited words against a comparison of all pairs."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from wardline.llm.hyperminhash import similar_groups

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def grams(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def similar(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


def made():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(4000)]
    out = []
    for base in range(12):
        words = rng.choices(vocabulary, k=rng.choice([40, 100, 400]))
        out.append(" ".join(words))
        for edits in (1, 1, 2, 3, 4, 6, 8):
            w = list(words)
            for i in rng.sample(range(len(w)), edits * len(w) // 200 + 1):
                w[i] = rng.choice(vocabulary)
            out.append(" ".join(w))
    out += [out[0], out[0].upper(), None, "", " \n", "one", "one two", "ONE  two", "one two three four five"]
    chain = [f"c{i}" for i in range(160)]  # neighbours are near, ends are not
    return out + [" ".join(chain[10 * i : 10 * i + 100]) for i in range(6)] + [" ".join(chain[4 * i : 4 * i + 100]) for i in range(14)]


def test_groups(spark):
    texts = made()
    sets = [grams(t) for t in texts]
    group = list(range(len(texts)))
    seen = []
    for a in range(len(texts)):
        for b in range(a):
            if (s := similar(sets[a], sets[b])) >= 0.8:
                seen.append(s)
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = [new if g == old else g for g in group]
    assert sum(0.8 <= s < 0.95 for s in seen) > 50
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert {r.doc_id: r.group for r in similar_groups(docs, "doc_id").collect()} == dict(enumerate(group))
    kept = corpus_pipeline.near_dedup(spark, docs.union(docs.limit(5)), "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(group))
    assert corpus_pipeline.near_dedup(spark, docs.limit(0), "").collect() == []
    clashing = docs.withColumn("__document", F.lit("own")).withColumn("key", F.lit(1)).withColumn("group", F.lit(2))
    kept = corpus_pipeline.near_dedup(spark, clashing, "")
    assert kept.columns == clashing.columns and {r["__document"] for r in kept.collect()} == {"own"}
