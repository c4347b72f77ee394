"""The field against enumeration of all labellings, and held-out accuracy of the classifier."""

import itertools
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from airsight.llm import quality as q

SCHEMA = "doc_id long, text string, score string"
SF_DIR = "/root/testdata/sf0.01"


def test_marginals_equal_enumeration():
    rng = np.random.RandomState(1)
    counts = np.array([3, 1, 6, 1, 4])
    unary, transitions = rng.randn(counts.sum()), rng.randn(2, 2)
    found, at = q.marginals(unary, transitions, counts), 0
    _, _, totals = q.forward_backward(unary, transitions, counts)
    for n, total in zip(counts, totals):
        weights = {}
        for labels in itertools.product((0, 1), repeat=int(n)):
            score = sum(unary[at + i] for i, x in enumerate(labels) if x) + sum(transitions[a, b] for a, b in zip(labels, labels[1:]))
            weights[labels] = np.exp(score)
        z = sum(weights.values())
        assert np.log(z) == pytest.approx(total)
        for i in range(n):
            assert sum(w for labels, w in weights.items() if labels[i]) / z == pytest.approx(found[at + i])
        at += n


def test_fit_learns_transitions():
    rng = np.random.RandomState(2)
    counts = np.full(300, 12)
    good = np.repeat(rng.rand(300 * 3) < 0.5, 4).astype(float)
    x = np.column_stack([good + rng.randn(len(good)) * 2, np.ones(len(good))])
    weights, transitions = q.fit_field(x, counts, good, (np.zeros(2), np.zeros((2, 2))))
    chained = (q.marginals(x @ weights, transitions, counts) > 0.5) == good
    alone = (x[:, 0] > 0.5) == good
    assert transitions[0, 0] + transitions[1, 1] > transitions[0, 1] + transitions[1, 0] + 1 and chained.mean() > alone.mean() + 0.05


def test_line_features():
    features, length, counts = q.line_features(pa.array(["AB c\nd d d\n", None, "", "x", "x\nx"]))
    assert counts.tolist() == [3, 1, 1, 1, 2] and length.tolist() == [5, 6, 0, 0, 0, 1, 2, 1]
    column = {name: features[:, i] for i, name in enumerate(q.FEATURES)}
    assert column["upper"][0] == pytest.approx((2 / 5) ** 0.5) and column["again"][1] == pytest.approx((2 / 3) ** 0.5)
    assert column["same_line"].tolist() == [0, 0, 0, 0, 0, 0, 1, 1] and column["distinct"][1] == pytest.approx(1 / 3)


def test_the_sample_is_bounded_by_its_lines():
    assert q.within(np.array([5, 100, 3, 2, 1, 0]), 10).tolist() == [True, False, True, True, False, True]
    assert not q.within(np.zeros(0, dtype=int), 10).any() and q.within(np.array([10]), 10).all()


def test_document_means_weigh_by_length():
    assert q.document_means(np.array([1.0, 0.0, 0.5]), np.array([30, 10, 0]), np.array([2, 1])).tolist() == [0.75, 0.5]


def test_odd_rows(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(400):
        lines = [" ".join(f"w{rng.randrange(500)}" for _ in range(9)) for _ in range(rng.choice([1, 3, 9]))]
        if i % 4 == 0:
            lines[rng.randrange(len(lines)) :] = ["$$$ %%% " * rng.choice([5, 40])] * 2
        rows.append((i, "\n".join(lines), "x"))
        labels.append((i, int(i % 4 != 0)))
    rows += [(900, None, "x"), (901, "", "x"), (None, "w1 w2", "x"), (902, "w1 w2\n" * 30_000, "x"), (7, "w3", "x")]
    labels += [(None, 0), (2, None), (900, 1), (3, 0)]
    docs, known = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")
    found = q.classify(docs, known).collect()
    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == 405 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)
    assert np.mean([by_id[i]["predicted"] == (i % 4 != 0) for i in range(400) if i != 7]) > 0.97
    assert by_id[900]["score"] == by_id[901]["score"] and by_id[902]["n_lines"] == 30_001 and by_id[None]["held_out"]
    same = {r["score"] for r in q.classify(docs, known.filter("quality = 1")).collect()}
    assert len(same) == 1 and q.classify(docs.limit(0), known).count() == 0


def test_held_out_accuracy(spark):
    read = lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")
    scored = q.classify(read("documents"), read("labels")).join(read("labels"), "doc_id").filter("held_out").toPandas()
    assert (scored.predicted == scored.quality).mean() > 0.97


def plain_lines(text):
    """(features, length) of every line, a line at a time; a line feed belongs to the line that it ends."""
    out = []
    lines = (text or "").encode().split(b"\n")
    lines = [line + b"\n" for line in lines[:-1]] + lines[-1:]
    bags = [sorted(line.split()) for line in lines]
    for line, bag in zip(lines, bags):
        size, words = max(len(line), 1), line.split()
        some = max(len(words), 1)
        kinds = [
            lambda c: 65 <= c <= 90, lambda c: 48 <= c <= 57, lambda c: c in b"!?", lambda c: c in b"#$%&*@^~+=_\\/", lambda c: c in b"|<>{}[]",
            lambda c: c in b".,;:", lambda c: c in b" \t", lambda c: c >= 128,
        ]
        shares = [math.sqrt(sum(map(kind, line)) / size) for kind in kinds]
        again = sum(a == b for a, b in zip(words, words[1:]))
        rest = [
            math.log1p(len(line)) / 5, math.log1p(len(words)) / 5, math.log1p(size / some) / 3, math.sqrt(again / some),
            len(set(words)) / some if words else 1.0, float(bool(words) and bags.count(bag) > 1),
        ]
        out.append((shares + rest, len(line)))
    return out


def plain_score(text, model):
    """Quality of one text: forward and backward products over its lines, then the mean by length."""
    lines = plain_lines(text)
    z = [[(v - c) / s for v, c, s in zip(f, model.centre, model.spread)] for f, _ in lines]
    zero = [0.0] * len(model.centre)
    unary = []
    for i in range(len(z)):
        x = z[i] + (z[i - 1] if i else zero) + (z[i + 1] if i + 1 < len(z) else zero) + [1.0]
        unary.append(sum(a * w for a, w in zip(x, model.weights)))
    node, step = [[1.0, math.exp(u)] for u in unary], np.exp(model.transitions).tolist()
    norm = lambda pair: [v / sum(pair) for v in pair]
    forward, backward = [norm(node[0])], [[1.0, 1.0]]
    for n in node[1:]:
        forward.append(norm([n[k] * sum(forward[-1][j] * step[j][k] for j in (0, 1)) for k in (0, 1)]))
    for n in reversed(node[1:]):
        backward.append(norm([sum(step[k][j] * n[j] * backward[-1][j] for j in (0, 1)) for k in (0, 1)]))
    good = [norm([a * b for a, b in zip(f, g)])[1] for f, g in zip(forward, reversed(backward))]
    weight = [max(n, 1) for _, n in lines]
    mean = sum(p * w for p, w in zip(good, weight)) / sum(weight)
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, model.intercept + model.slope * mean)))), len(lines), sum(p < 0.5 for p in good)


def test_whole_query_equals_plain_scorer(spark):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(300):
        lines = [" ".join(rng.choice(["", "Ä", "X"]) + f"w{rng.randrange(200)}" for _ in range(rng.choice([0, 2, 9]))) for _ in range(rng.choice([1, 2, 7, 20]))]
        if i % 3 == 0:
            lines[rng.randrange(len(lines)) :] = rng.choice([["$$$ %%% BUY!! BUY!!"] * 2, ["<a|b> 99 99 99"], ["w1 w2 w3", "w3 w2 w1"]])
        docs.append((i, "\n".join(lines)))
        labels.append((i, int(i % 3 != 0)))
    docs += [(900, None), (901, ""), (902, "\n\n \t\n"), (None, "w1"), (7, "w3 w3")]
    d, known = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(labels, "doc_id long, quality int")
    model = q.train(d, known)
    expected = sorted((-1 if i is None else i, *plain_score(text, model)) for i, text in docs)
    found = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["score"], r["n_lines"], r["n_bad_lines"], r["predicted"], r["held_out"]) for r in q.classify(d, known).collect())
    assert len(found) == len(expected) and 0 < sum(f[4] for f in found) < len(found)
    for (i, score, lines, bad, predicted, held), (j, p, n, n_bad) in zip(found, expected):
        assert (i, lines, bad) == (j, n, n_bad) and score == pytest.approx(p, abs=1e-4)
        assert predicted == int(score >= 0.5) and held == (i < 0 or zlib.crc32(str(i).encode()) % 3 == 1)
