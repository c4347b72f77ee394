"""Apportionment against one-seat-at-a-time dealing, and the mix against its contract."""

import random
import re
from math import gcd

import pytest
from pyspark.sql import functions as F

from airsight.llm import mixing as m

SCHEMA = "doc_id long, text string, source string, size string"


def dealt(votes, seats, most):
    given = [0] * len(votes)
    for _ in range(min(seats, sum(most))):
        open_ = [i for i in range(len(votes)) if given[i] < most[i]]
        given[max(open_, key=lambda i: (votes[i] / (2 * given[i] + 1), -i))] += 1
    return given


@pytest.mark.parametrize("seed", range(40))
def test_highest_quotients(seed):
    rng = random.Random(seed)
    n = rng.randrange(1, 9)
    votes = [float(rng.choice([0, 1, 2, 3, rng.randrange(1, 500)])) for _ in range(n)]
    most = [rng.choice([0, 3, 50, 400]) for _ in range(n)]
    seats = rng.randrange(0, 300)
    assert m.sainte_lague(votes, seats, most) == dealt(votes, seats, most)


def test_water_fill():
    assert m.water_fill([10, 10, 10], [1, 2, 3]) == pytest.approx([5, 10, 15])
    targets = m.water_fill([1, 100, 5, 0], [1, 2, 3, 1])
    assert targets == pytest.approx([3, 88, 15, 0]) and sum(targets) == pytest.approx(106)
    assert m.water_fill([], []) == [] and m.water_fill([0, 0], [1, 2]) == [0, 0]


def rows():
    rng = random.Random(3)
    out = [(i, " ".join(["w x"] * rng.choice([0, 1, 5, 300, 2000])), rng.choice(["big"] * 6 + ["b", "é", "z", None]), "x") for i in range(300)]
    return out + [(900, None, "b", "x"), (901, "a\x0bb\x0cc\td", "tiny", "x"), (902, "", "empty", "x"), (903, "w " * 90_000, "b", "x"), (5, "dup dup", "z", "x"), (5, "dup dup", "z", "x"), (None, "null id", "z", "x")]


@pytest.mark.parametrize("shard_words", [m.SHARD_WORDS, 5_000])
def test_contract(spark, shard_words):
    data = rows()
    found = m.mix(spark.createDataFrame(data, SCHEMA).repartition(5), shard_words=shard_words).collect()
    sizes = {}
    for _, text, source, _ in data:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = dict(zip(order, m.water_fill([sizes[s] for s in order], [float(1 + i % 3) for i in range(len(order))])))
    assert len(found) == len(data)
    assert sorted((r["doc_id"] or -1, r["size"]) for r in found) == sorted((i or -1, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, _, _ in data)
    for s in order:
        mine = [r for r in found if r["source"] == s]
        assert all(r["source_size"] == sizes[s] and r["target"] == pytest.approx(targets[s]) and 0 <= r["taken"] <= 3 * r["size"] for r in mine)
        shards = 1 + sizes[s] // shard_words
        assert abs(sum(r["taken"] for r in mine) - targets[s]) <= m.BLOCK_WORDS * (1 + 3 * shards)
    again = m.mix(spark.createDataFrame(data[::-1], SCHEMA).repartition(2), shard_words=shard_words).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again))


def test_empty_table(spark):
    assert m.mix(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("shard_words", [m.SHARD_WORDS, 5_000, 150])
def test_small_sources_reach_their_targets(spark, shard_words):
    rng = random.Random(8)
    sizes = {"a": 20_000, "b": 20, "c": 70, "d": 20_000, "e": 200, "f": 1}
    data = []
    for source, left in sizes.items():
        while left:
            n = min(left, rng.choice([1, 7, 40, 130, 900]))
            data.append((len(data), "w " * n, source, "x"))
            left -= n
    found = m.mix(spark.createDataFrame(data, SCHEMA), shard_words=shard_words).collect()
    assert all(0 <= r["taken"] <= m.MAX_REPEATS * r["size"] for r in found)
    for s, size in sizes.items():
        mine = [r for r in found if r["source"] == s]
        shards = 1 + size // shard_words
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= m.BLOCK_WORDS * (1 + shards), s  # a block for the source and one a shard


def dealt_words(rows, shard_words):
    """(doc_id, source, size, taken) by lists: every word of a shard stands in a list, and blocks are taken from it one by one.

    ``rows`` are (doc_id, source, size, place in the draw, hash for the shard).
    """
    totals = {}
    for _, source, size, _, _ in rows:
        totals[source] = totals.get(source, 0) + size
    names = sorted(totals, key=lambda s: (s is None, s or ""))
    targets = m.water_fill([totals[s] for s in names], [float(1 + i % 3) for i in range(len(names))])
    limit = lambda n: -(-3 * n // 64)
    seats = dealt(targets, round(sum(totals.values()) / 64), [limit(totals[s]) for s in names])
    out = []
    for i, source in enumerate(names):
        shards = {}
        for row in rows:
            if row[1] == source:
                shards.setdefault(row[4] % (1 + totals[source] // shard_words), []).append(row)
        in_order = sorted(shards)
        sizes = [sum(r[2] for r in shards[k]) for k in in_order]
        for k, n, quota in zip(in_order, sizes, dealt(sizes, seats[i], [limit(n) for n in sizes])):
            members = sorted(shards[k], key=lambda r: (r[3], r[0] is not None, r[0] or 0, r[2]))
            line = [at for at, r in enumerate(members) for _ in range(r[2])]
            blocks = [line[b : b + 64] for b in range(0, n, 64)]
            wanted, taken = min(64 * quota, 3 * n), [0] * len(members)
            step = max(1, int(len(blocks) * 0.6180339887))
            while blocks and gcd(step, len(blocks)) != 1:
                step += 1
            turns = sorted(range(len(blocks)), key=lambda b: (b * step + m.SEED * (i + 1) + k) % len(blocks))
            while wanted:
                for b in turns:
                    for at in blocks[b][:wanted]:
                        taken[at] += 1
                    wanted -= len(blocks[b][:wanted])
            out += [(r[0], source, r[2], t) for r, t in zip(members, taken)]
    return out


@pytest.mark.parametrize("shard_words", [m.SHARD_WORDS, 5_000, 150])
def test_whole_mix_equals_dealing_by_lists(spark, shard_words):
    docs = spark.createDataFrame([r for r in rows() if r[0] != 903] + [(904, "w " * 9_000, "b", "x")], SCHEMA)
    draws = docs.select("doc_id", "source", m.words(F.col("text")).alias("size")).select(
        "*", F.xxhash64(F.lit(m.SEED), "doc_id", "size"), F.xxhash64(F.lit(m.SEED + 1), "doc_id", "size")
    )
    expected = dealt_words([tuple(r) for r in draws.collect()], shard_words)
    found = m.mix(docs, shard_words=shard_words).select("doc_id", "source", "size", "taken").collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))
    assert any(t > s for _, _, s, t in expected) and any(0 < t < s for _, _, s, t in expected)
