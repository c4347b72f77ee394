"""The prefix trie against a plain one, the decomposition against bottom-up sums."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from airsight.llm import prefix_trie as p

SCHEMA = "conv_id long, turn long, role string, text string, depth string, node string"


def digest(role, text):
    return sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        block = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        full[c] = own.get(block, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, convs in members.items():
        below = [x for x in members if x[: len(node)] == node]
        leaves = [x for x in below if not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in members)]
        ends = ",".join(map(str, sorted(c for c in convs if len(full[c]) == len(node))))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), sum(len(x) == len(node) + 1 for x in below), len(leaves),
            sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x), sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def conversations(seed=1):
    rng = random.Random(seed)
    rows = []
    for c in [*range(-3, 60), 100, 117, 205, 2**40, *range(300, 340)]:
        shared = c % 5 == 0
        for t in range(rng.choice([1, 2, 3, 3, 6, 9])):
            turn = rng.choice([t, t, None, 3])  # ties and nulls
            text = rng.choice(["", None, "a", "b", "é" * 7])
            rows.append((c, turn, rng.choice(["user", None]), "the first" if shared else text, "x", "y"))
    rows += [(7, 50 + i, "user", "long", "x", "y") for i in range(70)]  # a long conversation
    return [*rows, (None, 1, "user", "nobody's", "x", "y"), *rows[:9]]


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("most", [3, 40, 10**6])
def test_trie(spark, most):
    rows = conversations()
    mine = p.prefix_trie(spark.createDataFrame(rows, SCHEMA), most).select(*COLUMNS)
    assert sorted(map(tuple, mine.collect()), key=repr) == plain(rows)


def test_large_conversations_and_many_ends(spark, monkeypatch):
    monkeypatch.setattr(p, "ENDS_WIDTH", 4)
    spark.conf.set("airsight.maxGroupRows", "20")
    try:
        rows = conversations(2) + [(c, 0, "user", "same", "x", "y") for c in range(1000, 1080)]
        mine = p.prefix_trie(spark.createDataFrame(rows, SCHEMA), 8).select(*COLUMNS)
        assert sorted(map(tuple, mine.collect()), key=repr) == plain(rows)
    finally:
        spark.conf.unset("airsight.maxGroupRows")


def test_no_conversations(spark):
    for rows in ([], [(None, 0, "user", "x", "x", "y")]):
        empty = p.prefix_trie(spark.createDataFrame(rows, SCHEMA))
        assert sorted(empty.columns) == sorted(COLUMNS) and empty.count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_decomposition(seed):
    rng = random.Random(seed)
    n = rng.choice([1, 2, 5, 40, 300])
    parent = [-1] + [rng.choice([i - 1, rng.randrange(i)]) if seed % 3 else i - 1 for i in range(1, n)]
    values = [(rng.randrange(9), rng.randrange(-5, 5)) for _ in range(n)]
    weight, sums = [rng.randrange(1, 4) for _ in range(n)], [list(v) for v in values]
    for i in range(n - 1, 0, -1):
        weight[parent[i]] += weight[i]
        sums[parent[i]] = [a + b for a, b in zip(sums[parent[i]], sums[i])]
    assert p.rollup(parent, weight, values) == sums
    parts = [list(range(n))]
    steps = 0
    while any(len(x) > 1 for x in parts):  # every step halves the weight
        parts = [y for x in parts if len(x) > 1 for y in p.split(x, parent, weight, values, [[0, 0] for _ in parent])]
        steps += 1
    assert 2**steps <= 8 * n
