"""The language stage of the pipeline decides by predict()."""

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from wardline.llm import language_id

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EN, DE = "the and of to with that this house quickly ", "der die das und nicht für über schön ungefähr "
TEXTS = [(EN * 5, "en"), (DE * 5, "de"), (EN * 3, "en"), (EN + DE, "en"), ("z", "de"), ("12 34", "en"), ("", None), (None, "en"), ("jazz", None)]


def test_stage_keeps_what_is_predicted(spark):
    docs = spark.createDataFrame([(i, t, n, "s", 0) for i, (t, n) in enumerate(TEXTS)], SCHEMA)
    kept = corpus_pipeline.language_id(spark, docs, "")
    assert kept.dtypes == docs.dtypes
    told = language_id.predict(docs, language_id.fit(docs)).where("lang_pred <> 'und'")
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in told.collect()} == {0, 1, 2, 3, 4, 8}


def test_texts_of_an_unknown_language_go(spark):
    texts = [*TEXTS[:4], ("0xq zzkx qqxz zxqk " * 9, "und"), ("zzkx qqxz 0xq", None)]
    docs = spark.createDataFrame([(i, t, n, "s", 0) for i, (t, n) in enumerate(texts)], SCHEMA)
    assert {r.doc_id for r in corpus_pipeline.language_id(spark, docs, "").collect()} == {0, 1, 2, 3}


def test_without_labels_all_rows_stay(spark):
    docs = spark.createDataFrame([(i, t, None, "s", 0) for i, (t, _) in enumerate(TEXTS)], SCHEMA)
    assert corpus_pipeline.language_id(spark, docs, "").count() == len(TEXTS)


def test_what_no_language_is_near_to_is_told(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit(docs)
    told = language_id.predict(docs, model)
    assert told.where("lang_pred <> 'und' and far").count() <= 2 and told.where("ambiguous").count() <= 10
    long = {r.lang: r.text for r in docs.where("length(text) > 1500").collect()}
    rng = random.Random(1)
    noise = lambda n: " ".join("".join(rng.choices("bcdfghjklmnpqrstvwxz", k=rng.randint(2, 9))) for _ in range(n))
    russian = "Это предложение написано на русском языке и ничего не значит."
    odd = [noise(20), noise(60), noise(3000), russian, russian * 50, long["en"][:600] + " " + long["de"][:600], "a", "", None]
    odd += [long["en"][:600], long["fr"][:60], long["de"] * 20]
    rows = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    got = [tuple(r) for r in language_id.predict(rows, model).orderBy("doc_id").select("far", "ambiguous", "score").collect()]
    assert [far for far, _, _ in got[:5]] == [True] * 5 and all(score < 0.7 for _, _, score in got[:5])
    assert got[5][:2] == (False, True) and got[5][2] < 0.7  # half and half is no junk
    assert got[6][0] is False and [x[0] for x in got[7:9]] == [True, True]
    assert [x[:2] for x in got[9:]] == [(False, False)] * 3
    kept = language_id.recognised(rows, model).select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == [5, 6, 9, 10, 11]


def test_limit_of_few_and_of_no_texts(spark):
    assert language_id.fit(spark.createDataFrame([], SCHEMA)).limits == (np.inf, np.inf)
    one = spark.createDataFrame([(1, EN * 4, "en", "s", 0)], SCHEMA)
    told = language_id.predict(one, language_id.fit(one)).first()
    assert (told.lang_pred, told.far) == ("en", False)
    same = one.union(one).union(one.withColumn("text", F.lit(None).cast("string")))
    assert language_id.predict(same, language_id.fit(same)).where("far").count() == 1
