"""The prefix trie against plain Python."""

import hashlib
import random
import re
from zlib import crc32

import pytest

from wardline.llm.prefix_trie import branched, prefix_trie, split_totals, turn_lists

SCHEMA = "conv_id long, turn long, role string, text string, depth int, node string"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def plain_lists(rows):
    convs = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            order = (turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest())
            convs.setdefault(conv, []).append((order, (role or "", text or "")))
    return {c: [t for _, t in sorted(turns, key=lambda x: x[0])] for c, turns in convs.items()}


def plain_branched(convs):
    found = {}
    for c, turns in convs.items():
        h = crc32(str(c).encode()) % 4
        found[c] = convs.get(c - c % 20, [])[:h] + turns[h:]
    return found


def plain_trie(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    rows = []
    for node, ids in members.items():
        tree = [m for m in members if m[: len(node)] == node]
        children = [m for m in tree if len(m) == len(node) + 1]
        words = lambda m: len(re.findall(r"[^\x20\x09-\x0D]+", m[-1][1])) if m else 0
        inner = {m[:-1] for m in members if m}
        ends = ",".join(str(c) for c in sorted(ids) if len(convs[c]) == len(node))
        rows.append((
            min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(children),
            sum(m not in inner for m in tree), sum((len(members[m]) - 1) * words(m) for m in tree),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows, key=str)


def conversations(seed):
    rng = random.Random(seed)
    texts = ["yes", "no  no", "", "a\tb c", None, "ünï\x0bcode"]
    rows = []
    for c in [*range(90), 1000, 1001, 7000]:
        for turn in range(rng.choice([1, 2, 3, 5, 8, 40 if c % 30 == 0 else 2])):
            rows.append((c, turn, rng.choice(["user", "user", None]), rng.choice(texts[: rng.choice([2, 2, 6])]), 3, "x"))
    rows += [(5, None, "user", "first"), (5, 0, "user", "tie"), (5, 0, "user", "another"), (None, 0, "user", "lost")]
    rows += [r for r in rows if r[0] in (7, 8)]  # repeated rows
    chain = [(2000 + i, t, "user", "same" if t < 60 else f"own {i}") for i in range(4) for t in range(62)]
    copies = [(3000 + i, t, "user", "copy copy") for i in range(50) for t in range(3)]
    return [(*r, None, None)[:6] for r in rows + chain + copies]


def test_split_totals():
    rng = random.Random(5)
    for n in (1, 2, 3, 10, 200):
        for shape in (lambda v: v - 1, lambda v: 0, lambda v: rng.randrange(v), lambda v: max(0, v - rng.randint(1, 3))):
            parents = [-1, *(shape(v) for v in range(1, n))]
            values = [(rng.randint(0, 9), v) for v in range(n)]
            sums = [list(x) for x in values]
            for v in reversed(range(1, n)):
                sums[parents[v]] = [a + b for a, b in zip(sums[parents[v]], sums[v])]
            assert split_totals(parents, values) == sums


@pytest.mark.parametrize("local", [20_000, 30])
def test_same_as_plain_python(spark, local):
    rows = conversations(local)
    lists = turn_lists(spark.createDataFrame(rows, SCHEMA))
    got = prefix_trie(branched(lists), local)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=str) == plain_trie(plain_branched(plain_lists(rows)))


def test_without_branching_and_turnless(spark):
    rows = [(3, 0, "user", "a", 1, ""), (4, 0, "user", "a", 1, ""), (20, 0, "user", "b", 1, "")]
    lists = turn_lists(spark.createDataFrame(rows, SCHEMA))
    empty = lists.selectExpr("conv_id + 100 AS conv_id", "slice(turns, 1, 0) AS turns")
    got = prefix_trie(lists.unionByName(empty))
    convs = plain_lists(rows)
    assert sorted(map(tuple, got.collect()), key=str) == plain_trie(convs | {c + 100: [] for c in convs})
    only = prefix_trie(empty).collect()
    assert [(r.conv_id, r.depth, r.n_convs, r.n_leaves) for r in only] == [(103, 0, 3, 1)]


def test_empty_table(spark):
    lists = turn_lists(spark.createDataFrame([], SCHEMA))
    assert prefix_trie(branched(lists)).count() == 0
