"""The join against all pairs, on texts with copies, near copies, ties and odd rows."""

import random

import numpy as np
import pyarrow as pa
import pytest

from airsight.llm import ngram_join, shingles

SCHEMA = "doc_id long, text string, key string, links int"


def grams(text, n=5):
    w = [x for x in (text or "").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").split(" ") if x]
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def corpus():
    rng = random.Random(3)
    vocabulary = [f"w{i}é" if i % 7 == 0 else f"w{i}" for i in range(400)]
    base = [" ".join(rng.choices(vocabulary, k=rng.choice([30, 80, 200]))) for _ in range(12)]
    texts = []
    for b in base:
        for _ in range(8):
            w = b.split(" ")
            for _ in range(rng.choice([0, 1, 1, 2, 6])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            texts.append(rng.choice([" ", "\n"]).join(w))
    texts += ["", "", None, "  \n", "one two", "one two", "one  two", "a b c d e", "b c d e f", " ".join(vocabulary * 40)]
    return [(i * 3, t) for i, t in enumerate(texts)] + [(6, texts[2]), (None, texts[0]), (None, "x y z")]


def brute(rows, threshold=0.8):
    texts = sorted({t or "" for _, t in rows})
    sets = {t: grams(t) for t in texts}
    links, parent = {t: 0 for t in texts}, {t: t for t in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(texts):
        for b in texts[:i]:
            union = len(sets[a] | sets[b])
            if union and len(sets[a] & sets[b]) / union >= threshold:
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    ids = {}
    for d, t in rows:
        ids.setdefault(t or "", []).append(d)
    top = lambda values: max((v for v in values if v is not None), default=None)
    classes = {}
    for t in texts:
        classes.setdefault(find(t), []).extend(ids[t])
    return sorted(
        ((d, top(ids[t or ""]), len(ids[t or ""]), links[t or ""], top(classes[find(t or "")])) for d, t in rows), key=repr
    )


@pytest.mark.parametrize("block", [400_000, 900])
def test_join_equals_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", block)
    rows = corpus()
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA).repartition(5)
    assert sorted((tuple(r) for r in ngram_join.ngram_join(docs).collect()), key=repr) == brute(rows)


def test_tasks_of_a_large_bucket_are_dealt_evenly(spark, monkeypatch):
    """Near copies in one bucket: blocks of a few texts, dealt by ranges, leave no task far above the others."""
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", 2_000)
    dealt, verify = [], ngram_join._verify

    def counted(threshold):
        run = verify(threshold)

        def rows(batches):
            batches = list(batches)
            yield from run(batches)
            size = b"#%d" % sum(b.num_rows for b in batches)
            yield pa.RecordBatch.from_arrays([pa.array([size], pa.binary()), pa.array([0], pa.int64()), pa.array([b"#"], pa.binary())], names=["key", "links", "root"])

        return rows

    def seen(df, label):
        out = stage(df, label)
        if label == "links":
            dealt.extend(int(r["key"][1:]) for r in out.collect() if bytes(r["root"]) == b"#")
            return out.filter("root <> X'23'")
        return out

    stage = ngram_join.stage
    monkeypatch.setattr(ngram_join, "_verify", counted)
    monkeypatch.setattr(ngram_join, "stage", seen)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        base = [f"w{i}" for i in range(100)]
        docs = spark.createDataFrame([(i, " ".join([*base, f"x{i}"]), "x", 1) for i in range(300)], SCHEMA)
        got = ngram_join.ngram_join(docs).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {r["links"] for r in got} == {299} and {r["class_id"] for r in got} == {299}
    assert len(dealt) == 8 and max(dealt) <= 2 * sum(dealt) / len(dealt)


def test_one_document_of_each_class_stays(spark):
    rows = corpus()
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA)
    kept = ngram_join.keep_one_each(docs).collect()
    want = {r[4] for r in brute(rows) if r[4] is not None}
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == sorted(want)
    assert [r["text"] for r in kept if r["doc_id"] is None] == ["x y z"]
    assert kept[0].asDict().keys() == {"doc_id", "text", "key", "links"}


def test_empty_table(spark):
    assert ngram_join.ngram_join(spark.createDataFrame([], SCHEMA)).count() == 0
    assert ngram_join.keep_one_each(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_chain_is_one_component(spark):
    keys = [i.to_bytes(4, "big") for i in np.random.RandomState(1).permutation(60).tolist()]
    edges = spark.createDataFrame(list(zip(keys, keys[1:])), "key binary, root binary")
    found = ngram_join.components(edges).collect()
    assert len(found) == 60 and {bytes(r["root"]) for r in found} == {bytes(4)}


def test_band_plan_reaches_its_recall():
    bands, rows = ngram_join.band_plan(0.8, 0.9999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999 and bands * rows <= ngram_join.MAX_HASHES


def test_word_hashes_do_not_depend_on_cuts(monkeypatch):
    texts = ["a bb  ccc\n", "", None, "a", "bb a", "é ü" * 50, "x" * 9000 + " y", " ", "z"] * 3
    column = pa.array(texts)
    whole, counts = shingles.word_hashes(*shingles.text_bytes(column))
    monkeypatch.setattr(shingles, "CHUNK_BYTES", 7)
    cut, counts_cut = shingles.word_hashes(*shingles.text_bytes(column))
    assert (whole == cut).all() and (counts == counts_cut).all()
    names = [w for t in texts if t for w in t.split()]
    assert counts.tolist() == [len((t or "").split()) for t in texts] and len(set(whole.tolist())) == len(set(names))
    assert dict(zip(names, whole.tolist())) == {n: h for n, h in zip(names, whole.tolist())}
    lone = shingles.word_hashes(*shingles.text_bytes(pa.array(["ccc"])))[0]
    assert lone[0] == whole[2]
