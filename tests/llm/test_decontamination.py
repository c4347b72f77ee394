"""The search against exact containment of every item in every document."""

import random

import numpy as np
import pytest

from airsight.llm import decontamination as d
from test_ngram_join import grams

SCHEMA = "doc_id long, text string, item_id string"


def tables():
    rng = random.Random(5)
    vocabulary = [f"w{i}ü" if i % 5 == 0 else f"w{i}" for i in range(900)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([5, 9, 14, 30, 60])))) for i in range(40)]
    docs = []
    for i in range(120):
        w = rng.choices(vocabulary, k=rng.choice([3, 40, 300, 4000]))
        for _ in range(rng.choice([0, 0, 1, 2])):
            item = rng.choice(items)[1].split(" ")
            if rng.random() < 0.4:
                item[rng.randrange(len(item))] = "edited"
            at = rng.randrange(len(w))
            w[at:at] = item
        docs.append((i, rng.choice([" ", "\n"]).join(w)))
    docs += [(500, None), (501, ""), (502, items[0][1]), (502, "other text"), (None, items[3][1]), (503, "tiny item"), (502, items[0][1])]
    items += [(900, "tiny item"), (901, None), (902, ""), (None, items[1][1]), (0, items[0][1])]
    return docs, items


def brute(docs, items):
    out = {}
    for i, t in items:
        n = max(1, min(5, len((t or "").split())))
        g = grams(t)
        for k, x in docs:
            w = (x or "").split()
            h = grams(x) if n == 5 else {tuple(w[j : j + n]) for j in range(len(w) - n + 1)}
            if g and len(g & h) >= 0.8 * len(g) - 1e-9:
                out[k, i] = max(out.get((k, i), (0, 0, 0)), (len(g & h) / len(g), len(g & h), len(g)))
    return {(k, i, m, n, c) for (k, i), (c, m, n) in out.items()}


@pytest.mark.parametrize("limit", [None, "1"])
def test_pairs_equal_brute_force(spark, monkeypatch, limit):
    docs, items = tables()
    if limit:
        spark.conf.set("airsight.maxBroadcastBytes", limit)
        monkeypatch.setattr(d, "PROBE_BYTES", 1)
    try:
        found = d.contaminated(
            spark.createDataFrame([(*r, "x") for r in docs], SCHEMA).repartition(4), spark.createDataFrame([(i, t) for i, t in items], "item_id long, text string")
        ).collect()
    finally:
        spark.conf.unset("airsight.maxBroadcastBytes")
    want = brute(docs, items)
    assert len(want) > 60 and {tuple(r) for r in found} == want and len(found) == len(want)


def test_short_items_in_long_documents(spark):
    rng = random.Random(8)
    docs = [(i, " ".join(rng.choices([f"w{j}" for j in range(60)], k=rng.choice([2, 30, 400])))) for i in range(60)]
    items = [(n * 10 + i, " ".join(rng.choices([f"w{j}" for j in range(60)], k=n))) for n in (1, 2, 3, 4, 5, 6) for i in range(4)]
    found = d.contaminated(spark.createDataFrame([(*r, "x") for r in docs], SCHEMA), spark.createDataFrame(items, "item_id long, text string"))
    want = brute(docs, items)
    assert {tuple(r) for r in found.collect()} == want and {i // 10 for _, i, *_ in want} >= {1, 2}


def test_a_phrase_that_all_share_proposes_no_pairs(spark, monkeypatch):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(20_000)]
    phrase = "the following are multiple choice"
    items = [(i, f"{phrase} {' '.join(rng.choices(words, k=14))}") for i in range(1000)]
    docs = [(i, f"{' '.join(rng.choices(words, k=60))} {phrase} {' '.join(rng.choices(words, k=60))}") for i in range(1000)] + [(5000 + i, items[i][1]) for i in range(20)]
    rows, stage = {}, d.stage
    monkeypatch.setattr(d, "stage", lambda df, label: rows.setdefault(label, stage(df, label)))
    found = d.contaminated(spark.createDataFrame([(*r, "x") for r in docs], SCHEMA), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(5000 + i, i) for i in range(20)}
    assert rows["candidates"].count() < 5000 and rows["pairs"].count() == 20


@pytest.mark.parametrize("grams_", [1, 2, 5, 12, 13, 56, 400])
def test_the_index_keeps_enough(grams_):
    kept, least = d.indexed_shingles(grams_)
    shared = int(np.ceil(0.8 * grams_ - 1e-9))
    assert kept <= grams_ and kept - (grams_ - shared) == least >= 1
    load = d.item_load(grams_)
    assert load == 0 or 1 - (1 - (1 - np.exp(-load)) / load) ** least >= d.RECALL


def test_clean_documents_stay(spark):
    docs, items = tables()
    bad = {r[0] for r in brute(docs, items)}
    kept = d.decontaminate(spark.createDataFrame([(*r, "x") for r in docs], SCHEMA), spark.createDataFrame([(i, t) for i, t in items], "item_id long, text string"))
    assert kept.columns == ["doc_id", "text", "item_id"]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(k for k, _ in docs if k not in bad)


def test_empty_tables(spark):
    none, items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert d.contaminated(none, items).count() == 0
    some = spark.createDataFrame([(1, "a b c d e f", "x")], SCHEMA)
    assert d.contaminated(some, items.limit(0)).count() == 0 and d.decontaminate(some, items.limit(0)).count() == 1


def test_sketch_minima_are_nested():
    grams_ = np.unique(np.random.RandomState(2).randint(0, 2**63, 700, dtype=np.int64).astype(np.uint64) * np.uint64(2))
    before = np.ones(len(grams_), dtype=bool)
    for load in d.LOADS:
        now = d._minima(grams_, load, len(grams_))
        assert (before | ~now).all() and now.any()
        before = now
