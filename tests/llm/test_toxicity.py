"""Segments against all intervals, and held-out accuracy of the classifier."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from airsight.llm import toxicity as t

SCHEMA = "doc_id long, text string, score string, passages int"
SF_DIR = "/root/testdata/sf0.01"


def brute_segments(scores, low=0):
    """Take the best interval (of ties the shortest, then the leftmost), then look left and right of it."""
    best = None
    for i in range(len(scores)):
        total = 0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > 0 and (best is None or (total, i - j, -i) > (best[2], best[0] - best[1], -best[0])):
                best = (i, j, total)
    if best is None:
        return []
    i, j, s = best
    return brute_segments(scores[:i], low) + [(low + i, low + j, s)] + brute_segments(scores[j + 1 :], low + j + 1)


@pytest.mark.parametrize("seed", range(60))
def test_segments_equal_recursive_search(seed):
    rng = random.Random(seed)
    scores = [rng.choice([-9, -4, -3, -2, -1, 1, 2, 3, 5, 8]) * 1024 + rng.randrange(512) for _ in range(rng.randrange(0, 25))]
    assert t.maximal_segments(scores) == brute_segments(scores)


def test_scan_is_linear():
    scores = [3.0, -1.0] * 100_000
    assert t.maximal_segments(scores) == [(0, 199_998, 3.0 * 100_000 - 99_999)]


def tables(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(900):
        w = rng.choices(words, k=rng.choice([8, 60, 200]))
        toxic = i % 5 == 0
        if toxic:
            w[rng.randrange(len(w))] = rng.choice(["Vile,", "vile", "FOUL."])
        rows.append((i, " ".join(w), "x", 1))
        labels.append((i, int(toxic)))
    rows += [(9001, None, "x", 1), (9002, "", "x", 1), (None, "vile foul vile", "x", 1), (3, "w1 w2", "x", 1), (9003, "w1 " * 50_000 + "vile " * 5, "x", 1)]
    labels += [(None, 1), (4, None), (9001, None), (5, 1), (5, 1)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_odd_rows_and_planted_words(spark):
    docs, labels = tables(spark)
    found = t.classify(docs, labels).collect()
    assert len(found) == 905 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found)
    by_id = {r["doc_id"]: r for r in found if r["doc_id"] not in (3, 5)}
    right = [by_id[i]["predicted"] == (i % 5 == 0) for i in by_id if i is not None and i < 900]
    assert np.mean(right) > 0.98
    assert by_id[9003]["predicted"] == 1 and by_id[None]["predicted"] == 1 and by_id[None]["held_out"]
    assert by_id[9001]["score"] == by_id[9002]["score"] < 0.5
    clean = t.drop_toxic(docs, labels)
    assert clean.columns == docs.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(r["doc_id"] for r in found if not r["predicted"])


def test_nothing_to_learn_from(spark):
    docs, labels = tables(spark)
    none = t.classify(docs, labels.filter("toxic = 0")).agg(F.countDistinct("score"), F.sum("predicted")).first()
    assert tuple(none) == (1, 0)
    assert t.classify(docs.limit(0), labels).count() == 0 and t.drop_toxic(docs, labels.limit(0)).count() == 905


def test_held_out_accuracy(spark):
    read = lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")
    scored = t.classify(read("documents"), read("labels")).join(read("labels"), "doc_id").filter("held_out").toPandas()
    assert ((scored.predicted == 1) & (scored.toxic == 0)).sum() == 0  # clean documents are left alone
    assert scored[scored.toxic == 1].predicted.mean() > 0.7  # words of two languages are too rare here to learn


def test_labels_of_held_out_rows_are_not_learned(spark):
    read = lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")
    labels = read("labels")
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = t.train(read("documents"), labels), t.train(read("documents"), flipped)
    assert (one.tokens == two.tokens).all() and np.allclose(one.weights, two.weights) and one.intercept == pytest.approx(two.intercept)


def plain_words(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())


def plain_weights(docs, labels):
    """Weights of clear words and the drift, by counting sets of words."""
    toxic = {}
    for i, label in labels:
        if label is not None and i is not None and zlib.crc32(str(i).encode()) % 3 != 1:
            toxic[i] = max(toxic.get(i, 0), int(label == 1))
    texts = {}
    for i, text in docs:
        if i in toxic:
            texts[text or ""] = max(texts.get(text or "", 0), toxic[i])
    having = [{}, {}]
    for text, label in texts.items():
        for w in set(plain_words(text)):
            having[label][w] = having[label].get(w, 0) + 1
    names = set(having[0]) | set(having[1])
    n0, n1 = sum(having[0].values()), sum(having[1].values())
    weights, rest0, rest1 = {}, n0, n1
    prior = 0.5 * len(names) + 0.01 * (n0 + n1)
    for w in names:
        y0, y1 = having[0].get(w, 0), having[1].get(w, 0)
        a = 0.5 + 0.01 * (y0 + y1)
        odds = [math.log((y + a) / (n + prior - y - a)) for y, n in ((y0, n0), (y1, n1))]
        delta, error = odds[1] - odds[0], math.sqrt(1 / (y1 + a) + 1 / (y0 + a))
        if abs(delta) >= 2.5 * error:
            weights[w] = math.copysign(abs(delta) - 2 * error, delta)
            rest0, rest1 = rest0 - y0, rest1 - y1
    return weights, max(0.05, math.log(max(rest0, 1) / n0) - math.log(max(rest1, 1) / n1))


def test_whole_query_equals_plain_scorer(spark):
    rng = random.Random(12)
    words, docs = [f"w{i}" for i in range(200)] + ["Ärger", "x-y"], []
    labels = []
    for i in range(700):
        w = rng.choices(words, k=rng.choice([1, 8, 30, 90]))
        if i % 4 == 0:
            w[rng.randrange(len(w))] = rng.choice(["Vile, foul!", "vile", "FOUL.", "vile w1 w2 foul"])
        docs.append((i, rng.choice([" ", "\n", ", "]).join(w)))
        labels.append((i, int(i % 4 == 0)))
    docs += [(800, None), (801, ""), (None, "vile"), (3, docs[8][1])]
    labels += [(800, 0), (5, None), (None, 1), (7, 1)]
    d, known = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(labels, "doc_id long, toxic int")
    model, (weights, drift) = t.train(d, known), plain_weights(docs, labels)
    hashed = lambda w: int(t.tokens_of(pa.array([w.decode()]))[0][0])
    learned = dict(zip(model.tokens.tolist(), model.weights.tolist()))
    assert {hashed(w): v for w, v in weights.items()} == pytest.approx(learned) and drift == pytest.approx(model.drift) and len(weights) > 1
    expected = []
    for i, text in docs:
        scores = [weights.get(w, -drift) for w in plain_words(text)]
        best = max([math.fsum(scores[a : b + 1]) for a in range(len(scores)) for b in range(a, len(scores))], default=0.0)
        evidence = model.rate * max(best, 0.0) - math.log(model.scale * max(len(scores), 1))
        p = 1 / (1 + math.exp(-(model.intercept + model.slope * evidence)))
        expected.append((-1 if i is None else i, i is None or zlib.crc32(str(i).encode()) % 3 == 1, p))
    found = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["held_out"], r["score"], r["predicted"]) for r in t.classify(d, known).collect())
    assert len(found) == len(expected)
    for (i, held, score, predicted), (j, left_out, p) in zip(found, sorted(expected)):
        assert (i, held) == (j, left_out) and score == pytest.approx(p, abs=1e-6) and predicted == int(score >= 0.7)
    assert 0 < sum(f[3] for f in found) < len(found)
