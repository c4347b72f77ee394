"""Metrics against direct computations."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from airsight.operators import comparison, metrics, profile


@pytest.fixture(params=["2000000", "20"])
def route(request, spark):
    spark.conf.set("airsight.maxGroupRows", request.param)
    yield
    spark.conf.unset("airsight.maxGroupRows")


def test_regression(spark):
    df = spark.createDataFrame([("a", 0.0, 1.0), ("a", 2.0, 1.0), ("a", 4.0, 5.0), ("z", 0.0, 1.0), ("z", 0.0, 2.0)], "m string, y double, p double")
    got = {r["m"]: r for r in metrics.regression_metrics(df, "y", "p", ["m"]).collect()}
    assert (got["a"]["rmse"], got["a"]["mae"], got["a"]["r2"], got["a"]["mape"]) == (1.0, 1.0, 0.625, 37.5)
    assert got["z"]["mape"] is None and got["z"]["r2"] is None


def test_published_report_rows_are_consistent(spark):
    # class rows of a recorded run: support, precision, recall; the summary rows must follow from them
    tp = {"High": 6, "Low": 45, "Moderate": 111, "Severe": 0, "Very High": 960}
    support = {"High": 19, "Low": 55, "Moderate": 116, "Severe": 11, "Very High": 962}
    called = {"High": 6, "Low": 48, "Moderate": 117, "Severe": 0, "Very High": 992}
    wrong_true = [k for k in tp for _ in range(support[k] - tp[k])]
    wrong_called = [k for k in tp for _ in range(called[k] - tp[k])]
    # pair the misses with the false alarms so that no pair is a hit
    pairs = []
    pool = sorted(wrong_called)
    for t in sorted(wrong_true, reverse=True):
        i = next(i for i, c in enumerate(pool) if c != t)
        pairs.append((t, pool.pop(i)))
    rows = [(k, k) for k in tp for _ in range(tp[k])] + pairs
    report = {r["label"]: r for r in metrics.classification_report(spark.createDataFrame(rows, "y string, p string"), "y", "p").collect()}
    assert report["accuracy"]["support"] == pytest.approx(0.9647463456577816)
    assert report["macro avg"]["f1"] == pytest.approx(0.6578351805259031)
    assert report["weighted avg"]["precision"] == pytest.approx(0.9557880687762389)
    assert report["weighted avg"]["f1"] == pytest.approx(0.9569758045124878)
    assert report["Severe"]["precision"] == 0.0 and report["High"]["f1"] == pytest.approx(0.48)


def test_confusion_keeps_zero_cells(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (2, 0)], "y int, p int")
    matrix = metrics.confusion_matrix(df, "y", "p")
    cells = {(r["y_true"], r["y_pred"]): r["n"] for r in matrix.collect()}
    assert len(cells) == 9 and cells[0, 1] == 1 and cells[1, 1] == 0 and cells[2, 0] == 1
    wide = {r["y_true"]: r for r in metrics.confusion_wide(matrix, [0, 1, 2]).collect()}
    assert [wide[2][str(c)] for c in range(3)] == [1, 0, 0]


def test_auc(spark, route):
    rng = np.random.default_rng(3)
    y, s = rng.random(300) < 0.4, rng.integers(0, 60, 300) / 60
    rows = [(1, bool(a), float(b)) for a, b in zip(y, s)] + [(2, bool(a), 0.5) for a in y] + [(3, True, float(b)) for b in s]
    got = {r["cls"]: r["auc"] for r in metrics.roc_auc_by_class(spark.createDataFrame(rows, "c int, y boolean, s double"), "c", "y", "s").collect()}
    pos, neg = s[y], s[~y]
    brute = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    assert got[1] == pytest.approx(brute) and got[2] == 0.5 and got[3] is None


def curve_by_hand(y, s):
    points = [(0.0, 0.0)]
    scores = sorted(set(s), reverse=True)
    counts = [(int(np.sum((s == v) & ~y)), int(np.sum((s == v) & y))) for v in scores]
    f = t = 0
    for i, (dn, dp) in enumerate(counts):
        f, t = f + dn, t + dp
        if i in (0, len(counts) - 1) or counts[i + 1] != counts[i]:
            points.append((f / np.sum(~y), t / np.sum(y)))
    return np.array(points)


def test_macro_curve(spark, route):
    rng = np.random.default_rng(5)
    truth, scores = rng.integers(0, 3, 150), rng.integers(1, 50, (150, 3)) / 50
    rows = [(k, bool(truth[i] == k), float(scores[i, k])) for i in range(150) for k in range(3)]
    curve = metrics.roc_curve_macro(spark.createDataFrame(rows, "c int, y boolean, s double"), "c", "y", "s")
    got = sorted((r["fpr"], r["mean_tpr"]) for r in curve.collect())
    curves = [curve_by_hand(truth == k, scores[:, k]) for k in range(3)]
    grid = np.unique(np.concatenate([c[:, 0] for c in curves]))
    mean = np.mean([np.interp(grid, c[:, 0], c[:, 1]) for c in curves], axis=0)
    assert [g[0] for g in got] == list(grid) and [g[1] for g in got] == pytest.approx(list(mean))
    assert metrics.curve_area(curve).first()[0] == pytest.approx(np.trapezoid(mean, grid))


def test_correlation_with_gaps_and_constants(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 5.0, None), (2.0, None, 5.0, 1.0), (3.0, 5.0, 5.0, float("nan")), (4.0, 9.0, 5.0, 7.0)], "a double, b double, c double, d double"
    ).repartition(3)
    got = {(r["x"], r["y"]): r["r"] for r in profile.correlation_matrix(df, ["a", "b", "c", "d"]).collect()}
    pdf = df.toPandas().astype(float).corr()
    for (x, y), r in got.items():
        assert (r is None) if math.isnan(pdf.loc[x, y]) else r == pytest.approx(pdf.loc[x, y]), (x, y)


def test_histogram(spark):
    rng = np.random.default_rng(2)
    a, p = rng.normal(size=500), rng.normal(size=500)
    bins = profile.residual_histogram(spark.createDataFrame([(float(x), float(z)) for x, z in zip(a, p)], "a double, p double"), "a", "p").orderBy("bin").collect()
    counts, edges = np.histogram(a - p, bins=60)
    assert [r["n"] for r in bins] == list(counts) and [r["bin_low"] for r in bins] == pytest.approx(list(edges[:-1]))
    single = profile.residual_histogram(spark.createDataFrame([(1.0, 0.0)], "a double, p double"), "a", "p")
    assert single.agg(F.sum("n")).first()[0] == 1


RECORDED = [  # recorded comparison rows
    ("Random Forest", "ML", 0.9647, 0.957, 0.9283, 0.0039), ("ANN (Deep Learning)", "DL", 0.9501, 0.942, 0.9193, None),
    ("XGBoost", "ML", 0.9656, 0.9588, 0.9193, 0.0031), ("Decision Tree", "ML", 0.9622, 0.9554, 0.9151, 0.0059),
    ("Logistic Regression", "ML", 0.945, 0.9312, 0.9111, 0.0073),
]


def test_winners(spark):
    df = spark.createDataFrame(RECORDED, "model_name string, type string, accuracy double, f1_weighted double, roc_auc double, cv_std double")
    best = lambda d: comparison.best_classifier(d).first()[0]
    assert best(df) == "Random Forest" and best(df.filter("model_name <> 'Random Forest'")) == "XGBoost"
    assert best(df.filter("false")) == "Unknown"
    assert comparison.best_classifier_in_log(df.withColumn("roc_auc", F.lit(0.0))).first()[0] == "Unknown"
    assert [r["model_name"] for r in comparison.comparison([df.filter("type = 'ML'"), df.filter("type = 'DL'").drop("cv_std")], "roc_auc").collect()] == [
        "Random Forest", "ANN (Deep Learning)", "XGBoost", "Decision Tree", "Logistic Regression",
    ]
    air = spark.createDataFrame([("Random Forest", 0.5329, 0.8474), ("XGBoost", 0.5383, 0.8443), ("LSTM", 0.822012, 0.636931)], "model_name string, rmse double, r2 double")
    assert comparison.best_regressor(air).first()[0] == "Random Forest"
    tied = air.withColumn("r2", F.lit(0.5))
    assert comparison.best_regressor_in_training(tied, "XGBoost").first()[0] == "XGBoost"
    assert comparison.winner_row(df, "absent", order=[F.desc("roc_auc")]).first()["model_name"] == "Random Forest"


def test_histories(spark):
    losses = [3.0, 2.0, 2.0, 1.0] + [1.0] * 9 + [1.5, 0.1]
    df = spark.createDataFrame([(1, losses), (2, [5.0, 4.0, 3.0]), (3, [1.0])], "run int, val_loss array<double>")
    got = {r["run"]: tuple(r)[1:] for r in comparison.best_epoch(df, "run").collect()}
    assert got == {1: (4, 1.0, 14, True), 2: (3, 3.0, 3, False), 3: (1, 1.0, 1, False)}
    rows = comparison.history_rows(df, "run", ["val_loss"]).filter("run = 2").collect()
    assert [(r["epoch"], r["val_loss"]) for r in rows] == [(1, 5.0), (2, 4.0), (3, 3.0)]
