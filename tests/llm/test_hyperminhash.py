"""HyperMinHash groups against all pairs in plain Python."""

import re

import numpy as np
import pytest

from wardline.llm import hyperminhash
from wardline.llm.hyperminhash import accidents, band_shape, bands, estimated, registers, shingle_set, similar_groups

SCHEMA = "doc_id long, text string, n int, same string, `group` double"


def plain_set(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def plain_groups(rows, width, percent):
    sets = [plain_set(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return sorted(((k, len(s), least.get(find(i)) if s else k) for i, ((k, _), s) in enumerate(zip(rows, sets))), key=str)


def rows_of(seed, families=12):
    rng = np.random.default_rng(seed)
    word = lambda: f"w{rng.integers(0, 4000)}"
    rows, key = [], 0
    for _ in range(families):
        base = [word() for _ in range(int(rng.choice([4, 6, 9, 40, 120, 600])))]
        for _ in range(int(rng.integers(1, 9))):
            text = list(base)
            for _ in range(int(rng.integers(0, max(2, len(base) // 12)))):
                text[int(rng.integers(0, len(text)))] = word()
            rows.append((key, " ".join(text) if key % 3 else "\n".join(text).upper()))
            key += 1
    rows += [(None, None), (1000, ""), (1001, " \t "), (1002, "one"), (1003, "ONE"), (1004, "one two"), (1005, "a b c d e")]
    rows += [(1006, "a b c d e f"), (1007, "x a b c d e"), (None, "null key only"), (None, rows[0][1]), (1008, None)]
    rows += [(2, "again " * 50), (2, "again " * 50), (1009, "é " * 5000)]
    return rows


@pytest.mark.parametrize("width, percent, block", [(2, 80, 2048), (5, 80, 3), (1, 60, 3)])
def test_same_as_all_pairs(spark, monkeypatch, width, percent, block):
    monkeypatch.setattr(hyperminhash, "BLOCK", block)
    rows = rows_of(width)
    docs = spark.createDataFrame([(k, t, 5, "own", 0.5) for k, t in rows], SCHEMA)
    got = similar_groups(docs, width=width, percent=percent)
    assert got.columns == ["doc_id", "n", "group"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_groups(rows, width, percent)


def test_one_frame_and_a_chain(spark, monkeypatch):
    """Texts of one frame are candidates of each other but no copies; a chain of copies is one group."""
    monkeypatch.setattr(hyperminhash, "BLOCK", 16)
    frame = [f"f{i}" for i in range(100)]
    rows = [(i, " ".join(frame + [f"u{i}x{j}" for j in range(25)])) for i in range(60)]
    words = [f"c{i}" for i in range(100)]
    for i in range(12):  # each shares 9 in 10 words with the one before
        rows.append((500 - i, " ".join(words)))
        words = words[8:] + [f"d{i}x{j}" for j in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, similar_groups(docs, width=2).collect()), key=str)
    assert got == plain_groups(rows, 2, 80)
    assert {g for k, _, g in got if k > 400} == {489}


def test_empty_table(spark):
    assert similar_groups(spark.createDataFrame([], SCHEMA)).count() == 0


def test_estimates():
    rng = np.random.default_rng(2)
    for n in (5, 50, 400, 20_000):
        for share in (0.0, 0.5, 0.8, 1.0):
            a = np.unique(rng.integers(0, 1 << 64, n, np.uint64))
            cut = int(n * 2 * share / (1 + share))
            b = np.unique(np.concatenate([a[rng.permutation(n)[:cut]], rng.integers(0, 1 << 64, n - cut, np.uint64)]))
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            found, used = estimated(registers(a)[None, :], registers(b)[None, :], np.array([n]), np.array([n]))
            assert abs(found[0] - true) <= 5 * np.sqrt(0.25 / max(used[0], 1)) + 1e-3
    assert 0 < accidents(np.array([10_000]), np.array([10_000]))[0] < 1e-3


def test_registers_and_bands():
    assert not registers(np.zeros(0, np.uint64)).any()
    one = registers(np.array([(3 << 56) | (1 << 50) | (0b1100000001 << 40)], np.uint64))
    assert np.flatnonzero(one).tolist() == [3] and one[3] == ((5 + 1) << 10) | 0b1100000001
    zero = registers(np.array([7 << 56], np.uint64))
    assert zero[7] == 57 << 10
    assert band_shape(80) == (47, 5) and band_shape(60) == (76, 3)
    with pytest.raises(ValueError):
        band_shape(1)
    assert len(set(bands(one, 47, 5).tolist())) == 47
    # a set and its superset of one more agree in a band of five with 0.8 ** 5
    rng = np.random.default_rng(4)
    agreed = []
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 64, 5, np.uint64))
        agreed.append((bands(registers(a), 47, 5) == bands(registers(a[:4]), 47, 5)).mean())
    assert abs(np.mean(agreed) - 0.8**5) < 0.04
    assert len(shingle_set(b"a b a b a", 2)) == 2
