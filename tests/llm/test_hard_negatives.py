"""Strassen's product against numpy's, mining against a double loop."""

import math
import random

import numpy as np
import pytest

from airsight.llm import hard_negatives as h

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vector string"


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 70, 5), (33, 65, 130), (100, 64, 257), (0, 8, 8), (70, 70, 70)])
def test_product(shape):
    m, k, n = shape
    rng = np.random.default_rng(1)
    a, b = rng.integers(-(2**40), 2**40, (m, k)), rng.integers(-(2**10), 2**10, (k, n))
    for leaf in (1, 8, 32):
        assert (h.strassen(a, b, leaf) == a @ b).all()


def plain(rows, is_anchor, positives=h.POSITIVES, negatives=h.NEGATIVES, window=h.WINDOW):
    good = {}
    for i, v, label, *_ in rows:
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v):
            good.setdefault(i, []).append((label, [math.floor(256 * x) for x in v]))
    out = []
    for a in [i for i in good if is_anchor(i)]:
        label, mine = min(good[a])
        scored = {(-sum(x * y for x, y in zip(mine, v)), i, other == label) for i, vs in good.items() for other, v in vs if i != a}
        for p_score, p, _ in sorted(x for x in scored if x[2])[:positives]:
            some = sorted(x for x in scored if not x[2] and window[0] * -p_score <= 100 * -x[0] <= window[1] * -p_score)[:negatives]
            out += [(a, p, r, n, -p_score, -score) for r, (score, n, _) in enumerate(some, 1)]
    return sorted(out)


def vectors():
    rng = random.Random(4)
    centres = [[rng.uniform(-1, 1) for _ in range(9)] for _ in range(4)]
    rows = []
    for i in range(700):
        c = rng.randrange(4)
        v = [float(np.float32(x + rng.uniform(-0.6, 0.6))) for x in centres[c]]
        rows.append((i, [0.5] * 9 if i % 3 == 0 else v, rng.choice([c, c, 0]), "x", "y"))  # a third share one vector: ties
    rows += [(1000, None, 1, "x", "y"), (1100, [0.1] * 9, None, "x", "y"), (1200, [0.1, None] + [0.2] * 7, 1, "x", "y"), (None, [0.1] * 9, 1, "x", "y")]
    rows += [(1300, [float("nan")] * 9, 1, "x", "y"), (1400, [float("inf")] * 9, 1, "x", "y"), (1500, [0.3], 2, "x", "y"), (1600, [], 2, "x", "y")]
    return rows + [rows[1], rows[100], (100, [0.25] * 9, 3, "x", "y")]  # repeated rows and ids


@pytest.mark.parametrize("group_bytes", [200, 1 << 20])
def test_mining(spark, group_bytes):
    rows = vectors()
    found = h.hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(5), h.F.col("vec_id") % 100 == 0, group_bytes=group_bytes)
    expected = plain(rows, lambda i: i % 100 == 0)
    assert len(expected) > 100
    assert sorted(map(tuple, found.collect())) == expected


def test_small_tables(spark):
    def mined(rows):
        return h.hard_negatives(spark.createDataFrame(rows, SCHEMA), h.F.col("vec_id") % 100 == 0).collect()

    assert mined([]) == [] and mined([(0, [1.0], 1, "", "")]) == []
    assert mined([(0, [1.0], 1, "", ""), (1, [1.0], 1, "", ""), (2, [0.5], 2, "", "")]) == [(0, 1, 1, 2, 65536, 32768)]
    assert mined([(0, [1.0], 1, "", ""), (1, [-1.0], 1, "", ""), (2, [-0.5], 2, "", "")]) == []  # no score is in a negative window


def test_heaps_merge():
    heaps, rng = h.Heaps(3, 4), random.Random(2)
    entries = [(rng.randrange(3), rng.randrange(5), rng.randrange(40)) for _ in range(300)]
    for low in range(0, 300, 7):
        heaps.add(*(np.array(c) for c in zip(*entries[low : low + 7])))
        if low % 5 == 0:
            heaps.merge()
    expected = [x for s in range(3) for x in sorted({e for e in entries if e[0] == s}, key=lambda e: (-e[1], e[2]))[:4]]
    assert list(zip(*(c.tolist() for c in heaps.merge()))) == expected
