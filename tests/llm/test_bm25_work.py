"""How often the search works out what a block's rare terms add, and what it leaves to dense products."""

from collections import Counter

import numpy as np

from wardline.llm import bm25


def test_rare_terms_of_a_block_are_scored_once(monkeypatch):
    docs, words = 3 * bm25.BLOCK_ROWS, np.arange(3 * bm25.BLOCK_ROWS, dtype="<u8")
    one = lambda t: np.ones(docs, t).tobytes()
    row = {
        "keys": list(range(docs)), "lengths": one("<i8"), "terms": words.tobytes(), "n": docs, "words": docs, "counts": one("<u4"),
        "ends": np.arange(1, docs + 1, dtype="<u4").tobytes(), "rows": np.arange(docs, dtype="<u2").tobytes(),
    }
    queries = bm25.Queries(np.arange(docs), words, np.arange(1, docs + 1), np.arange(docs, dtype=np.int32), np.ones(docs))
    calls, rare = [], bm25.Shard._rare
    monkeypatch.setattr(bm25.Shard, "_rare", lambda self, block, *a, **k: (calls.append(int(block)), rare(self, block, *a, **k))[1])
    best, names = np.zeros((docs, 2)), np.full((docs, 2), bm25._LAST)
    bm25.Shard(row, queries, 1.0).search(2, best, names)
    assert sorted(calls) == [0, 1, 2]
    assert names[:, 0].tolist() == list(range(docs)) and best[:, 1].tolist() == [0.0] * docs


def test_terms_of_many_pairs_are_not_scored_entry_by_entry(monkeypatch):
    """One document in 17, and all queries, have the word."""
    docs = 2 * bm25.BLOCK_ROWS
    having = np.arange(0, docs, 17)
    row = {
        "keys": list(range(docs)), "lengths": np.ones(docs, "<i8").tobytes(), "terms": np.array([5], "<u8").tobytes(), "n": docs, "words": docs,
        "ends": np.array([len(having)], "<u4").tobytes(), "rows": having.astype("<u2").tobytes(), "counts": np.ones(len(having), "<u4").tobytes(),
    }
    queries = bm25.Queries(np.arange(100), np.array([5], np.uint64), np.array([100]), np.arange(100), np.ones(100))
    best, names = np.zeros((100, 2)), np.full((100, 2), bm25._LAST)
    shard, entries, expanded = bm25.Shard(row, queries, 1.0), [], bm25._expanded
    getattr(queries, "dense", None)
    monkeypatch.setattr(bm25, "_expanded", lambda *a: (entries.append(len(expanded(*a)[0])), expanded(*a))[1])
    shard.search(2, best, names)
    assert sum(entries) == 0
    assert names.tolist() == [[0, 17]] * 100 and (best > 0).all()


def test_groups_of_queries_find_the_same(spark, monkeypatch):
    """Two languages, texts of all lengths, ties and words that repeat: in groups and not, as plain sums have it."""
    rng = np.random.default_rng(3)
    words = [[f"{side}{'abcdefghij'[i // 10]}{'abcdefghij'[i % 10]}" for i in range(60)] for side in "xy"]
    share = 1 / np.arange(1, 61)
    texts = [" ".join(rng.choice(words[i % 2], 1 + int(rng.pareto(1) * 8) % 90, p=share / share.sum())) for i in range(300)]
    texts += texts[:40] + [None, "", "12 !"]
    rows = [(None if i % 50 == 49 else i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    queries = docs.where("doc_id % 2 = 0")
    found = []
    for least in (1, 10**9):
        monkeypatch.setattr(bm25, "GROUP_FROM", least)
        found.append(sorted(map(tuple, bm25.search(bm25.build_index(docs), queries, 5).collect())))
    bags = [Counter((t or "").split()) if t != "12 !" else Counter({"12": 1}) for _, t in rows]
    lengths = [sum(b.values()) for b in bags]
    df, mean = Counter(w for b in bags for w in b), sum(lengths) / len(bags)
    want = []
    for key, text in rows:
        if key is None or key % 2:
            continue
        scores = []
        for (doc, _), bag, length in zip(rows, bags, lengths):
            norm = bm25.K1 * (1 - bm25.B + bm25.B * length / mean)
            score = sum(
                n * np.log1p((len(rows) - df[w] + 0.5) / (df[w] + 0.5)) * bag[w] * (bm25.K1 + 1) / (bag[w] + norm)
                for w, n in bags[key].items()
                if w in bag
            )
            scores.append((-round(score, 9), doc is None, doc or 0))
        best = [s for s in sorted(scores) if s[0] < 0][:5]
        want += [(key, rank, None if lost else doc, -score) for rank, (score, lost, doc) in enumerate(best, 1)]
    want.sort(key=lambda h: h[:2])
    for hits in found:
        assert [h[:3] for h in hits] == [h[:3] for h in want]
        assert np.allclose([h[3] for h in hits], [h[3] for h in want], rtol=0, atol=2e-9)
