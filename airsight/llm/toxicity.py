"""Toxic passages as maximum-scoring segments of token log-odds, calibrated by extreme values."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airsight.llm.common import fresh, held_out
from airsight.llm.labelled import FOLDS, logistic, training_texts
from airsight.llm.shingles import LOWER, NOT_WORD, slices, text_bytes, word_hashes
from airsight.session import stage

#: Labelled documents to learn from at most; of more, those with the least hashes of their ids are taken.
MAX_TRAINING_DOCS = 50_000
#: Standard errors from which on a token's log-odds are clear; all clear tokens of the training texts are kept.
MIN_Z = 2.5
#: Dirichlet prior of a token: so many pseudo-counts, and so many per training text of either kind that has it.
PRIOR = (0.5, 0.01)
#: Standard errors that a token's weight stays below its log-odds, so that rare tokens weigh little.
MARGIN = 2.0
#: What every token without clear log-odds costs a passage, at least.
DRIFT = 0.05
#: A passage is significant if chance makes fewer than so many like it in a clean document of the same length.
MAX_E = 0.05
#: From this score on a document counts as toxic.
CUTOFF = 0.7


@dataclass(frozen=True)
class Model:
    """``tokens`` (sorted hashes) and their ``weights``; ``drift`` for all others; ``rate`` and ``scale`` are the
    Karlin-Altschul parameters of clean texts; ``intercept`` and ``slope`` turn evidence into a probability."""

    tokens: np.ndarray
    weights: np.ndarray
    drift: float
    rate: float = 1.0
    scale: float = 0.01
    intercept: float = -5.0
    slope: float = 1.0


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of every text, without punctuation and with ASCII capitals folded, and their numbers."""
    return word_hashes(*text_bytes(column), NOT_WORD, LOWER)


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) of a sequence in linear time, by Ruzzo and Tompa's scan.

    A candidate is kept with the total before it and after it. A new one absorbs the nearest candidate that begins lower,
    unless that one already ends as high; what lies between is then part of a longer, better segment.
    """
    kept: list[tuple[int, int, float, float, int]] = []  # first, last, before, after, nearest candidate that begins lower
    total = 0.0
    for i, s in enumerate(scores):
        if s <= 0:
            total += s
            continue
        first, before, after = i, total, total + s
        total = after
        j = len(kept) - 1
        while True:
            while j >= 0 and kept[j][2] >= before:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= after:
                kept.append((first, i, before, after, j))
                break
            first, before, below = kept[j][0], kept[j][2], kept[j][4]
            del kept[j:]
            j = below
    return [(a, b, after - before) for a, b, before, after, _ in kept]


def passages(tokens: np.ndarray, model: Model) -> list[tuple[int, int, float]]:
    """(first token, last token, score) of all maximal segments of one text.

    Runs of tokens between clear ones are one negative step each, so the scan's length is the number of clear tokens.
    """
    if not len(model.tokens) or not len(tokens):
        return []
    at = np.minimum(np.searchsorted(model.tokens, tokens), len(model.tokens) - 1)
    clear = np.flatnonzero(model.tokens[at] == tokens)
    weights = model.weights[at[clear]]
    if not (weights > 0).any():
        return []
    steps: list[float] = []
    place: list[int] = []
    last = -1
    for p, w in zip(clear.tolist(), weights.tolist()):
        if p - last > 1:
            steps.append(-model.drift * (p - last - 1))
            place.append(last + 1)
        steps.append(w)
        place.append(p)
        last = p
    return [(place[a], place[b], s) for a, b, s in maximal_segments(steps)]


def log_e_values(found: list[tuple[int, int, float]], n: int, model: Model) -> np.ndarray:
    """Logarithm of how many passages of such a score chance makes in ``n`` tokens of clean text (Karlin and Altschul)."""
    return math.log(model.scale * max(n, 1)) - model.rate * np.array([s for _, _, s in found], dtype=float)


def evidence(found: list[tuple[int, int, float]], n: int, model: Model) -> float:
    """-ln E of the best passage, or of a score of 0 without passages: the extreme value of the text."""
    return -float(log_e_values(found or [(0, 0, 0.0)], n, model).min())


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, toxic, fold) to (token, kind, n): the number of texts that have the token, kind = 2 * fold + toxic.

    A text counts once, however often it repeats a token. Counts are summed per slice of a batch.
    """
    for batch in batches:
        for piece in slices(batch, "text"):
            tokens, counts = tokens_of(piece.column("text"))
            sets = [np.unique(t) for t in np.split(tokens, np.cumsum(counts)[:-1])]
            kinds = piece.column("toxic").to_numpy() + 2 * piece.column("fold").to_numpy()
            for k in range(2 * FOLDS):
                mine = [t for t, kind in zip(sets, kinds) if kind == k and len(t)]
                if not mine:
                    continue
                names, n = np.unique(np.concatenate(mine), return_counts=True)
                if len(names):
                    yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(np.full(len(names), k, dtype=np.int32)), pa.array(n)], names=["token", "kind", "n"])


def _log_odds(y1, y0, n1: float, n0: float, names: int):
    """Log-odds ratio of a token under its Dirichlet prior, and the standard error of it; ``names`` tokens share the prior."""
    a, total = PRIOR[0] + PRIOR[1] * (y1 + y0), PRIOR[0] * names + PRIOR[1] * (n1 + n0)
    delta = F.log((y1 + a) / (n1 + total - y1 - a)) - F.log((y0 + a) / (n0 + total - y0 - a))
    return delta, F.sqrt(1 / (y1 + a) + 1 / (y0 + a))


def _weights(counts: DataFrame, kinds: tuple[list[str], list[str]]) -> tuple[np.ndarray, np.ndarray, float]:
    """Clear tokens, their weights and the drift, learned from the given columns of toxic and clean counts."""
    y1, y0 = (sum((F.col(c) for c in side), F.lit(0)) for side in kinds)
    n1, n0, names = counts.filter(y1 + y0 > 0).agg(F.sum(y1), F.sum(y0), F.count("*")).first()
    if not n1 or not n0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0), DRIFT
    delta, error = _log_odds(y1, y0, float(n1), float(n0), names)
    scored = counts.filter(y1 + y0 > 0).select("token", delta.alias("delta"), error.alias("error"), y1.alias("y1"), y0.alias("y0"))
    clear = scored.filter(F.abs("delta") >= MIN_Z * F.col("error"))
    weight = F.signum("delta") * (F.abs("delta") - MARGIN * F.col("error"))
    top = clear.select("token", weight.alias("weight"), "y1", "y0").toArrow()
    tokens = top.column("token").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    rest1, rest0 = n1 - sum(top.column("y1").to_pylist()), n0 - sum(top.column("y0").to_pylist())
    drift = max(DRIFT, -math.log(max(rest1, 1) / n1) + math.log(max(rest0, 1) / n0))
    return tokens[order], top.column("weight").to_numpy()[order], drift


def _rate(tokens: np.ndarray, weights: np.ndarray, drift: float, share: np.ndarray) -> float:
    """The positive solution of E[exp(rate * score)] = 1 over clean tokens, of which ``share`` are each of the clear ones."""

    def excess(x: float) -> float:
        return float((share * np.exp(x * weights)).sum() + (1 - share.sum()) * math.exp(-x * drift)) - 1

    low, high = 1e-3, 1e-3
    while excess(high) < 0 and high < 20:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return max(high, 0.05)


def _profile(models: list[Model]):
    """(text, toxic, fold) to (toxic, n, best): the best passage of a training text, seen by the model of the other folds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                tokens, counts = tokens_of(piece.column("text"))
                parts = np.split(tokens, np.cumsum(counts)[:-1])
                scores = [[s for _, _, s in passages(t, models[f])] for t, f in zip(parts, piece.column("fold").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("toxic"), pa.array(counts), pa.array([max(s, default=0.0) for s in scores], pa.float64())], names=["toxic", "n", "best"]
                )

    return run


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text: str = "text") -> Model:
    """Learn the model. Token counts are Spark aggregates over the training texts; the driver gets the clear tokens
    and one line per training text, both bounded by ``MAX_TRAINING_DOCS``, and tasks get the tokens as two sorted columns.

    Weights for the calibration are cross-fitted: a text is scored by weights from the other folds, so that its own words
    don't vouch for it. Without texts of both kinds nothing is clear and every score is that of the intercept.
    """
    texts = training_texts(docs, labels, label, MAX_TRAINING_DOCS, id_col, text).withColumnRenamed(label, "toxic")
    counts = texts.mapInArrow(_count_tokens, "token long, kind int, n long").groupBy("token")
    counts = stage(counts.agg(*[F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"k{k}") for k in range(2 * FOLDS)]), "token-counts")

    def of(kind: int, without: int | None = None) -> list[str]:
        return [f"k{2 * f + kind}" for f in range(FOLDS) if f != without]

    others = [Model(*_weights(counts, (of(1, f), of(0, f)))) for f in range(FOLDS)]
    tokens, weights, drift = _weights(counts, (of(1), of(0)))
    profile = texts.mapInArrow(_profile(others), "toxic int, n long, best double").toArrow()
    y, n = profile.column("toxic").to_numpy().astype(float), profile.column("n").to_numpy()
    best = profile.column("best").to_numpy()
    if not len(tokens) or not 0 < y.sum() < len(y):
        share = (y.sum() + 1) / (len(y) + 2)
        return Model(tokens[:0], weights[:0], drift, intercept=math.log(share / (1 - share)), slope=0.0)
    clean = y == 0
    in_texts = sum((F.col(c) for c in of(0)), F.lit(0)).alias("n")
    total = max(int(counts.agg(F.sum(in_texts)).first()[0] or 0), 1)
    found = counts.join(_token_table(counts, tokens), "token").select("token", in_texts).toArrow()
    in_clean = dict(zip(found.column("token").to_numpy().view(np.uint64).tolist(), found.column("n").to_pylist()))
    share = np.array([in_clean.get(t, 0) for t in tokens.tolist()]) / total
    rate = _rate(tokens, weights, drift, share)
    # maximum likelihood of the scale: under chance scale * n * exp(-rate * best) is exponential with mean 1
    scale = float(clean.sum() / max((n * np.exp(-rate * best))[clean].sum(), 1e-9))
    model = Model(tokens, weights, drift, rate, scale)
    x = np.array([evidence([(0, 0, b)] if b > 0 else [], int(k), model) for b, k in zip(best, n)])
    intercept, slope = logistic(x, y)
    return Model(tokens, weights, drift, rate, scale, intercept, max(slope, 0.0))


def _token_table(like: DataFrame, tokens: np.ndarray) -> DataFrame:
    return like.sparkSession.createDataFrame(pa.table({"token": tokens.view(np.int64)}))


def _score(model: Model, text: str, names: list[str]):
    score_name, n_name, passages_name = names
    kind = pa.list_(pa.struct([("first_token", pa.int32()), ("last_token", pa.int32()), ("score", pa.float64()), ("e_value", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text):
                tokens, counts = tokens_of(piece.column(text))
                scores, listed = [], []
                for part in np.split(tokens, np.cumsum(counts)[:-1]):
                    found = passages(part, model)
                    e = np.exp(log_e_values(found, len(part), model))
                    x = model.intercept + model.slope * evidence(found, len(part), model)
                    scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, x)))))
                    listed.append([{"first_token": a, "last_token": b, "score": s, "e_value": float(v)} for (a, b, s), v in zip(found, e) if v <= MAX_E])
                rest = [c for c in piece.schema.names if c != text]
                yield pa.RecordBatch.from_arrays(
                    [*[piece.column(c) for c in rest], pa.array(scores, pa.float64()), pa.array([len(x) for x in listed], pa.int32()), pa.array(listed, kind)],
                    names=[*rest, score_name, n_name, passages_name],
                )

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``score`` (0 to 1), ``n_passages`` and ``passages``, the significant toxic passages.

    Every token of the whole text is looked up, and every maximal segment found. Null and empty texts have no passage and get
    the score of a single neutral token. Rows that repeat are scored each. No rows give no rows. Other columns are ignored.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    kind = "array<struct<first_token:int,last_token:int,score:double,e_value:double>>"
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, score double, n_passages int, passages {kind}"
    return docs.mapInArrow(_score(model, "text", ["score", "n_passages", "passages"]), schema)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Learn from ``labels`` and score all of ``docs``: ``doc_id``, ``held_out``, ``score``, ``predicted``, ``n_passages``, ``passages``."""
    scored = score(docs, train(docs, labels, "toxic", id_col, text), id_col, text)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUTOFF).cast("int").alias("predicted"), "n_passages", "passages"
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without those whose score reaches ``CUTOFF``; all columns as they are, whatever their names."""
    names = [fresh(c, docs.columns) for c in ("score", "n_passages", "passages", "text_to_score")]
    model = train(docs, labels, "toxic", id_col, text)
    marked = docs.withColumn(names[3], F.col(text))
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes) + f", {names[0]} double, {names[1]} int, {names[2]} array<struct<first_token:int,last_token:int,score:double,e_value:double>>"
    return marked.mapInArrow(_score(model, names[3], names[:3]), schema).filter(F.col(names[0]) < CUTOFF).select(*[F.col(f"`{c}`") for c in docs.columns])
