"""Document quality from a linear-chain conditional random field that labels every line good or bad."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airsight.llm.common import held_out
from airsight.llm.labelled import logistic, training_texts
from airsight.llm.shingles import WHITE_SPACE, slices, text_bytes, word_hashes
from airsight.session import stage

#: Labelled documents to learn from at most, and lines of all of them together.
MAX_TRAINING_DOCS = 6_000
MAX_TRAINING_LINES = 300_000
#: From this score on a document counts as good.
CUTOFF = 0.5
#: Gradient steps of a fit, and fits; between them the lines of bad documents are labelled anew.
STEPS, ROUNDS = 250, 3
RIDGE = 1e-3

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "mark": b"!?", "symbol": b"#$%&*@^~+=_\\/", "bar": b"|<>{}[]",
    "stop": b".,;:", "space": b" \t",
}
_TABLES = {name: np.isin(np.arange(256), list(chars)) for name, chars in _CLASSES.items()} | {"high": np.arange(256) >= 128}
#: Features of a line; the field sees them for the line itself and its two neighbours.
FEATURES = [*_TABLES, "length", "words", "word_length", "again", "distinct", "same_line"]


def line_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature matrix with a row per line, length of every line in bytes, and number of lines of every text.

    Lines stand between line feeds, so a text has one line at least, an empty one if it is empty. A line feed counts as a byte of the
    line that it ends.
    """
    buffer, edges = text_bytes(column)
    feeds = np.flatnonzero(buffer == 10)
    starts = np.sort(np.concatenate([edges[:-1], feeds + 1]))
    counts = np.diff(np.searchsorted(feeds, edges)) + 1
    line_edges = np.append(starts, len(buffer))
    length = np.diff(line_edges)
    size = np.maximum(length, 1)
    columns = []
    for chars in _TABLES.values():
        running = np.concatenate([[0], np.cumsum(chars[buffer], dtype=np.int32)])
        columns.append(np.sqrt((running[line_edges[1:]] - running[line_edges[:-1]]) / size))
    words, per_line = word_hashes(buffer, line_edges, WHITE_SPACE)
    line_of = np.repeat(np.arange(len(length)), per_line)
    some = np.maximum(per_line, 1)
    again = np.zeros(len(length))
    if len(words) > 1:
        np.add.at(again, line_of[1:], (words[1:] == words[:-1]) & (line_of[1:] == line_of[:-1]))
    order = np.lexsort((words, line_of))
    new = np.ones(len(words), dtype=bool)
    new[1:] = (words[order][1:] != words[order][:-1]) | (line_of[order][1:] != line_of[order][:-1])
    distinct = np.bincount(line_of[order][new], minlength=len(length))
    sums = np.zeros(len(length), dtype=np.uint64)
    np.add.at(sums, line_of, words)
    doc_of = np.repeat(np.arange(len(counts)), counts)
    by_line = np.lexsort((sums, doc_of))
    same = np.zeros(len(length), dtype=bool)
    equal = (sums[by_line][1:] == sums[by_line][:-1]) & (doc_of[by_line][1:] == doc_of[by_line][:-1])
    same[by_line[1:]] |= equal
    same[by_line[:-1]] |= equal
    columns += [
        np.log1p(length) / 5, np.log1p(per_line) / 5, np.log1p(size / some) / 3, np.sqrt(again / some), np.where(per_line > 0, distinct / some, 1.0),
        same & (per_line > 0),
    ]
    return np.column_stack(columns).astype(np.float32), length, counts


def with_neighbours(features: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Features of the line, of the one before and of the one behind (zeros beyond the text), and a constant."""
    first = np.cumsum(counts) - counts
    before, behind = np.zeros_like(features), np.zeros_like(features)
    before[1:], behind[:-1] = features[:-1], features[1:]
    before[first] = 0
    behind[first + counts - 1] = 0
    return np.hstack([features, before, behind, np.ones((len(features), 1), dtype=features.dtype)])


def forward_backward(unary: np.ndarray, transitions: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward log sums (a row per line, bad and good) and the log partition of every text.

    ``unary`` is the score of good against bad. All texts advance together, the long ones on their own at the end.
    """
    n, order = int(counts.sum()), np.argsort(-counts, kind="stable")
    first = (np.cumsum(counts) - counts)[order]
    length = counts[order]
    node = np.column_stack([np.zeros(n), unary])
    forward, backward = node.copy(), np.zeros((n, 2))
    running = np.searchsorted(-length, -np.arange(1, length[0] + 1), side="right") if len(length) else []
    for t in range(1, len(running)):
        at = first[: running[t]] + t
        forward[at] += np.logaddexp(forward[at - 1, :1] + transitions[0], forward[at - 1, 1:] + transitions[1])
    for t in range(len(running) - 2, -1, -1):
        at = first[: running[t + 1]] + t
        behind = node[at + 1] + backward[at + 1]
        backward[at] = np.logaddexp(behind[:, :1] + transitions[:, 0], behind[:, 1:] + transitions[:, 1])
    last = np.cumsum(counts) - 1
    return forward, backward, np.logaddexp(forward[last, 0], forward[last, 1])


def marginals(unary: np.ndarray, transitions: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Probability of good for every line."""
    forward, backward, total = forward_backward(unary, transitions, counts)
    return np.exp(forward[:, 1] + backward[:, 1] - np.repeat(total, counts))


def fit_field(x: np.ndarray, counts: np.ndarray, good: np.ndarray, start: tuple[np.ndarray, np.ndarray], steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions that maximise the likelihood of the labels, by gradient steps with adapted rates (Adam)."""
    weights, transitions = start[0].copy(), start[1].copy()
    inner = np.ones(len(x), dtype=bool)
    inner[np.cumsum(counts) - 1] = False
    a = np.flatnonzero(inner)
    label = good.astype(int)
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[a], label[a + 1]), 1)
    moments = [np.zeros(len(weights) + 4), np.zeros(len(weights) + 4)]
    for step in range(1, steps + 1):
        unary = x @ weights
        forward, backward, total = forward_backward(unary, transitions, counts)
        per_line = np.repeat(total, counts)
        p = np.exp(forward[:, 1] + backward[:, 1] - per_line)
        behind = np.column_stack([np.zeros(len(x)), unary])[a + 1] + backward[a + 1]
        both = np.exp(forward[a][:, :, None] + transitions[None] + behind[:, None, :] - per_line[a][:, None, None]).sum(axis=0) if len(a) else seen
        slope = np.concatenate([x.T @ (good - p), (seen - both).ravel()]) / len(x) - RIDGE * np.concatenate([weights, transitions.ravel()])
        moments[0] = 0.9 * moments[0] + 0.1 * slope
        moments[1] = 0.999 * moments[1] + 0.001 * slope**2
        move = 0.1 * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.999**step)) + 1e-9)
        weights += move[:-4]
        transitions += move[-4:].reshape(2, 2)
    return weights, transitions


def document_means(p: np.ndarray, length: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Mean of the lines' probabilities by length; an empty line counts as one byte."""
    weight = np.maximum(length, 1).astype(float)
    first = np.cumsum(counts) - counts
    return np.add.reduceat(p * weight, first) / np.add.reduceat(weight, first)


@dataclass(frozen=True)
class Model:
    """``centre`` and ``spread`` standardise features, ``weights`` and ``transitions`` are the field's; ``intercept`` and ``slope`` turn a document's mean into its score."""

    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    transitions: np.ndarray
    intercept: float
    slope: float

    def lines(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        features, length, counts = line_features(column)
        x = with_neighbours((features - self.centre) / self.spread, counts)
        return marginals(x @ self.weights, self.transitions, counts), length, counts

    def score(self, means: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.intercept + self.slope * means, -30, 30)))


def _featured(label: str):
    """(key, text, label) to (key, label, lines, features, length): the line features of a training text, by rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", 1 << 20):
                features, length, counts = line_features(piece.column("text"))
                ends = np.cumsum(counts)[:-1]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("key"), piece.column(label), pa.array(counts),
                        pa.array([x.ravel() for x in np.split(features, ends)], pa.list_(pa.float32())), pa.array(np.split(length, ends), pa.list_(pa.int64())),
                    ],
                    names=["key", label, "lines", "features", "length"],
                )

    return run


def within(lines: np.ndarray, most: int) -> np.ndarray:
    """Which documents are learned from: in the given order, each that fits the lines still left, whatever its length."""
    left, kept = most, np.zeros(len(lines), dtype=bool)
    for i, n in enumerate(lines.tolist()):
        if n <= left:
            kept[i] = True
            left -= n
    return kept


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text: str = "text") -> Model:
    """Fit the field on a bounded sample: tasks make the line features of at most ``MAX_TRAINING_DOCS`` labelled texts, taken in the order of a hash
    while they have ``MAX_TRAINING_LINES`` lines together; the driver gets these numbers, never texts.

    Labels are known of documents only. First every line has the label of its document. Then, ``ROUNDS`` - 1 times, the lines of bad
    documents that the field takes for good are labelled good, but for the document's most doubtful line, and the field is fitted again. A
    logistic curve maps the document's mean to its label. Without texts of both kinds all scores are equal.
    """
    texts = training_texts(docs, labels, label, MAX_TRAINING_DOCS, id_col, text)
    kind = f"key binary, {label} int, lines long, features array<float>, length array<long>"
    featured = stage(texts.select("key", "text", label).mapInArrow(_featured(label), kind), "line-features")
    sizes = featured.select("key", "lines").orderBy("key").toArrow()  # at most MAX_TRAINING_DOCS
    kept = within(sizes.column("lines").to_numpy(), MAX_TRAINING_LINES)
    if not kept.all():
        chosen = docs.sparkSession.createDataFrame(sizes.select(["key"]).filter(pa.array(kept)))
        featured = featured.join(chosen, "key", "left_semi")
    sample = featured.orderBy("key").toArrow()
    y, counts = sample.column(label).to_numpy().astype(float), sample.column("lines").to_numpy()
    width = len(FEATURES)
    if not 0 < y.sum() < len(y):
        share = (y.sum() + 1) / (len(y) + 2)
        return Model(np.zeros(width), np.ones(width), np.zeros(3 * width + 1), np.zeros((2, 2)), math.log(share / (1 - share)), 0.0)
    features = sample.column("features").combine_chunks().flatten().to_numpy().reshape(-1, width).astype(float)
    length = sample.column("length").combine_chunks().flatten().to_numpy()
    centre, spread = features.mean(axis=0), features.std(axis=0) + 1e-3
    x = with_neighbours((features - centre) / spread, counts)
    good = np.repeat(y, counts)
    field = (np.zeros(x.shape[1]), np.zeros((2, 2)))
    bad_lines = good == 0
    first = np.cumsum(counts) - counts
    for round_ in range(ROUNDS):
        field = fit_field(x, counts, good, field)
        p = marginals(x @ field[0], field[1], counts)
        if round_ < ROUNDS - 1:
            doubtful = p <= np.repeat(np.minimum.reduceat(p, first), counts)
            good = np.where(bad_lines, ((p > 0.5) & ~doubtful).astype(float), 1.0)
    intercept, slope = logistic(document_means(p, length, counts), y)
    return Model(centre, spread, field[0], field[1], intercept, max(slope, 0.0))


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", 1 << 20):
                p, length, counts = model.lines(piece.column("text"))
                bad = np.add.reduceat((p < 0.5).astype(np.int64), np.cumsum(counts) - counts)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(model.score(document_means(p, length, counts))), pa.array(counts), pa.array(bad)],
                    names=["doc_id", "score", "n_lines", "n_bad_lines"],
                )

    return run


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``score`` (0 to 1), ``predicted``, ``n_lines``, ``n_bad_lines``.

    All lines of the whole text get their forward-backward marginal. A null text is an empty one, and an empty text one empty line. Rows that
    repeat are scored each. No rows give no rows. Other columns are ignored, whatever their names.
    """
    model = train(docs, labels, "quality", id_col, text)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    scored = docs.mapInArrow(_score(model), f"doc_id {dict(docs.dtypes)['doc_id']}, score double, n_lines long, n_bad_lines long")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUTOFF).cast("int").alias("predicted"), "n_lines", "n_bad_lines"
    )
