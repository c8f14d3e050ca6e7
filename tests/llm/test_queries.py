"""The registered queries without SQL, on whole tables, against plain Python that shares no code with them."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from wardline.llm import language_id
from wardline.llm.queries import QUERIES


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").collect()


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def little(ids):
    return np.array(ids, "<u4").tobytes()


def test_op1(spark, sf_dir, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {d.doc_id: [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 1] for d in docs}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in QUERIES["op1_pack"](spark, sf_dir).collect():
        assert r.ids_crc32 == crc32(little(ids[r.doc_id][r.start : r.start + r.length])) and r.length > 0
        assert r.doc_tokens == len(ids[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for key, parts in [*((k, p) for k, p in pieces.items()), *((None, p) for p in sequences.values())]:
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == len(ids[key]) if key is not None else at <= 2048
    assert set(pieces) == set(ids)


BASE = (
    ("assign", re.compile(r"""(?ai:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 1, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
)


def test_op2(spark, sf_dir, docs):
    got = {r.doc_id: r for r in QUERIES["op2_secret_scan"](spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for d in docs:
        found = []
        for rank, (kind, pattern, group, least) in enumerate(BASE):
            found += [(m.start(), rank, kind, m.end()) for m in pattern.finditer(d.text or "") if len(m[group]) >= least]
        counts = Counter(kind for _, _, kind, _ in found)
        listed = [f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found)]
        row = got[d.doc_id]
        assert [row[f"n_{kind}"] for kind, *_ in BASE] == [counts[kind] for kind, *_ in BASE]
        assert row.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert not Counter(listed) - Counter(row.spans.split(","))


def test_op3(spark, sf_dir, docs):
    bags = {d.doc_id: Counter(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(d.text))) for d in docs}
    df, n = Counter(w for bag in bags.values() for w in bag), len(docs)
    mean = sum(map(Counter.total, bags.values())) / n
    got = defaultdict(dict)
    for r in QUERIES["op3_bm25_search"](spark, sf_dir).collect():
        got[r.query_id][r["rank"]] = (r.doc_id, r.score)
    for query in (d.doc_id for d in docs if d.doc_id % 50 == 0):
        scores = []
        for key, bag in bags.items():
            norm = 1.2 * (0.25 + 0.75 * bag.total() / mean)
            s = sum(
                q * math.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * bag[w] * 2.2 / (bag[w] + norm)
                for w, q in bags[query].items() if w in bag
            )
            if bags[query].keys() & bag.keys():
                scores.append((-round(s, 9), key))
        best = sorted(scores)[:10]
        assert [got[query][i + 1][1] for i in range(len(best))] == pytest.approx([-s for s, _ in best], abs=2e-9)
        assert {got[query][i + 1][0] for i in range(len(best))} <= {k for s, k in scores if s <= best[-1][0] + 2e-9}


def test_op6(spark, sf_dir, docs):
    """Held-out rows, and the same decoding written out for one text at a time."""
    held = {d.doc_id: crc32(str(d.doc_id).encode()) % 4 == 2 for d in docs}
    rows = {r.doc_id: r for r in QUERIES["op6_language_id"](spark, sf_dir).collect()}
    assert {k: r.held_out for k, r in rows.items()} == held
    table = spark.createDataFrame([d for d in docs if not held[d.doc_id]], "doc_id long, text string, lang string, source string, n_chars long")
    model, right = language_id.fit(table), []
    for d in docs:
        row = rows[d.doc_id]
        if not re.search(r"[^\W\d_]", d.text or ""):
            assert (row.lang_pred, row.score) == ("und", 0.0)
            continue
        counts, _ = language_id.gram_counts([d.text])
        losses = []
        for code in model.codes:
            loss = 0.0
            for b, sign in enumerate(code):
                margin = float(counts[0] @ model.weights[:, b].astype(float)) / math.sqrt(max(counts.sum(), 1))
                loss += math.log1p(math.exp(-sign * min(30, max(-30, margin)))) * model.reliability[b]
            losses.append(loss)
        assert row.lang_pred == model.languages[int(np.argmin(losses))] and 0 <= row.score <= 1
        if held[d.doc_id] and d.lang:
            right.append(row.lang_pred == d.lang)
    assert np.mean(right) > 0.97


def test_op8(spark, sf_dir, docs):
    prints = {}
    for d in docs:
        w = words(d.text)
        grams = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        prints[d.doc_id] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    component = {k: k for k in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 2 and component[a] > component[b]:
                    component[a], changed = component[b], True
    got = QUERIES["op8_simhash_near_dedup"](spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == sorted((k, f"{prints[k]:016x}", component[k]) for k in prints)


def test_op9(spark, sf_dir, docs):
    tokens = {d.doc_id: [*words(d.text), None] for d in docs}
    held = {k: crc32(str(k).encode()) % 7 == 2 for k in tokens}
    count = Counter(t for k, ts in tokens.items() if not held[k] for t in ts)
    n, v = count.total(), len(count)
    for r in QUERIES["op9_lm_score"](spark, sf_dir).collect():
        mine = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(mine), n)
        assert r.n_known == sum(count[t] > 0 for t in mine)
        assert r.base_score == pytest.approx(sum(math.log10((count[t] + 1) / (n + v + 1)) for t in mine), rel=1e-9)
        assert r.score < 0 and r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens), rel=1e-9)


def test_op10(spark, sf_dir, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected, start = [], 0
    for d in sorted(docs, key=lambda d: d.doc_id):
        ids = [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 0]
        expected.append((d.doc_id, start, len(ids), crc32(little(ids))))
        start += len(ids)
    got = QUERIES["op10_huffman_files"](spark, sf_dir).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, got.collect())) == expected
