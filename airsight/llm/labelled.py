"""Learning from labelled documents: which rows may be used, and a one-dimensional calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airsight.llm.common import held_out, text_key, whole
from airsight.session import lookup, stage

#: Parts of the training texts for cross-fitting.
FOLDS = 5


def training_texts(docs: DataFrame, labels: DataFrame, label: str, most: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(text, <label>, fold): labelled texts that may be learned from, equal texts once, about ``most`` of them at most, by hash of the id.

    Of equal texts with different labels the higher label counts. ``fold`` deals the texts out for cross-fitting.
    """
    wanted = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    wanted = wanted.groupBy(F.col("doc_id").alias("labelled")).agg(F.max(F.when(F.col(label) == 1, 1).otherwise(0)).alias(label))
    n = wanted.count()
    if n > most:
        wanted = wanted.filter(F.pmod(F.xxhash64(F.lit(5), "labelled"), F.lit(1 << 20)) < int((1 << 20) * most / n))
    mine = docs.select(F.col(id_col).alias("id"), whole(F.col(text)).alias("text")).join(lookup(wanted, "labels"), F.col("id") == F.col("labelled"))
    once = mine.groupBy(text_key(F.col("text")).alias("key")).agg(F.first("text").alias("text"), F.max(label).alias(label))
    return stage(once.select("key", "text", label, F.pmod(F.xxhash64(F.lit(6), "key"), F.lit(FOLDS)).cast("int").alias("fold")), "training-texts")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Intercept and slope by Newton steps; the ridge keeps them finite where the kinds separate."""
    design = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + ridge * np.eye(2), design.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])
