"""BM25 search with repeated query rows."""

from collections import Counter

from wardline.llm import bm25


def test_repeated_rows_lose_no_hits(spark):
    rows = [(i, "common " + "pad " * i) for i in range(12)]
    rows += [(0, "common ")] * 3 + [(1, "other common"), (20, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    index = bm25.build_index(docs)
    queries = docs.where("doc_id < 2")
    single = lambda t: bm25.search(index, spark.createDataFrame([(0, t)], docs.schema), k=6)
    plain = lambda df: sorted((r["rank"], r.doc_id, r.score) for r in df.collect())
    got = bm25.search(index, queries, k=6)
    assert plain(got.where("query_id = 0")) == plain(single("common "))
    assert plain(got.where("query_id = 1")) == sorted(plain(single("common pad ")) + plain(single("other common")))
    # a document counts as often as it stands in the index
    assert Counter(r.doc_id for r in single("common ").collect())[0] == 4
