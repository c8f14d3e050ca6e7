"""The corpus pipeline stage by stage against plain Python."""

import re

from pyspark.sql import functions as F

import corpus_pipeline
from wardline.llm.common import table, written
from wardline.llm.decontaminate import words_of
from tests.llm.test_near_copies import grams, similar


def test_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (None, "12 34", "en", "s", 5), (10**6, 'x token="abcdefghijklmnop" y', "en", "s", 28)], docs.schema
    )
    stages = dict(corpus_pipeline.STAGES)
    kept = written(docs.union(odd).union(docs.limit(3)), "in")
    ids = lambda df: sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in df.collect())
    before = kept.collect()
    kept = written(stages["language ID"](spark, kept, sf_dir), "a")
    assert ids(kept) == sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in before if re.search(r"[^\W\d_]", r.text or ""))
    rows = kept.collect()
    kept = written(stages["SimHash near-dedup"](spark, kept, sf_dir), "b")
    sets = [grams(r.text) for r in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if similar(sets[a], sets[b]) >= 0.8:
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = [new if g == old else g for g in group]
    first = {g: min(rows[i].doc_id for i in range(len(rows)) if group[i] == g) for g in set(group)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(first.values())
    rows = kept.collect()
    kept = written(stages["benchmark decontamination"](spark, kept, sf_dir), "c")
    windows = set()
    for item in table(spark, sf_dir, "benchmark").collect():
        w = words_of(item.text.encode())
        windows |= {tuple(w[k : k + 13]) for k in range(len(w) - 12)}
    clean = []
    for r in rows:
        w, hit = words_of(r.text.encode()), set()
        for k in range(len(w) - 12):
            if tuple(w[k : k + 13]) in windows:
                hit |= set(range(k, k + 13))
        if not hit or 20 * len(hit) < len(w):
            clean.append(r.doc_id)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(clean) != sorted(r.doc_id for r in rows)
    rows = kept.collect()
    kept = written(stages["secret scans"](spark, kept, sf_dir), "d")
    assert kept.columns == docs.columns
    text = {r.doc_id: r for r in kept.collect()}
    assert set(text) == {r.doc_id for r in rows}
    assert text[10**6].text == 'x [SECRET]" y' and text[10**6].n_chars == 13
    pieces = stages["packing"](spark, kept, sf_dir)
    assert {r.doc_id for r in pieces.collect()} == set(text)


def test_clashing_and_missing_columns(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").drop("n_chars")
    own = {"spans": "s", "items": "i", "n_words": "w", "__spans": "t", "__document": "d", "key": "k"}
    for name, value in own.items():
        docs = docs.withColumn(name, F.lit(value))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = written(stage(spark, docs, sf_dir), "clash")
        assert kept.dtypes == docs.dtypes, name
        assert {tuple(r[c] for c in own) for r in kept.collect()} == {tuple(own.values())}, name


def test_the_pipeline_and_an_empty_table(spark, sf_dir, tmp_path):
    pieces = corpus_pipeline.run(spark, sf_dir)
    assert pieces.count() > 0 and pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
    table(spark, sf_dir, "documents").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    table(spark, sf_dir, "benchmark").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
