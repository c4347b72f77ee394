"""Hard negatives: for an anchor and each of its positives, the best rows of other labels whose score lies in a window below the positive's.

Scores are integer inner products, computed by Strassen's recursion over tiles of anchors and candidates.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airsight.session import stage

#: Positives of an anchor, negatives of a positive, and the window of their scores in percent of the positive's score.
POSITIVES, NEGATIVES, WINDOW = 5, 10, (30, 90)
#: A component x becomes floor(SCALE * x).
SCALE = 256
#: Anchors and candidates of a tile, and the dimension at which the recursion ends.
TILE_ANCHORS, TILE_ROWS, LEAF = 512, 1024, 32
#: Bytes of anchor vectors that one scan of the candidates holds; more anchors take more scans.
GROUP_BYTES = 16 << 20
#: Entries that wait for a heap before they are merged.
PENDING = 200_000


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` in int64 with seven products instead of eight at every halving; odd sides are padded with a line of zeros.

    Every step is exact in the ring of integers modulo 2**64, so the result is exact wherever it fits 64 bits.
    """
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    a = np.pad(a, ((0, m % 2), (0, k % 2)))
    b = np.pad(b, ((0, k % 2), (0, n % 2)))
    r, s, t = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:r, :s], a[:r, s:], a[r:, :s], a[r:, s:]
    b11, b12, b21, b22 = b[:s, :t], b[:s, t:], b[s:, :t], b[s:, t:]
    p1, p2 = strassen(a11 + a22, b11 + b22, leaf), strassen(a21 + a22, b11, leaf)
    p3, p4 = strassen(a11, b12 - b22, leaf), strassen(a22, b21 - b11, leaf)
    p5, p6 = strassen(a11 + a12, b22, leaf), strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * r, 2 * t), dtype=np.int64)
    out[:r, :t] = p1 + p4 - p5 + p7
    out[:r, t:] = p3 + p5
    out[r:, :t] = p2 + p4
    out[r:, t:] = p1 - p2 + p3 + p6
    return out[:m, :n]


class Heaps:
    """The best ``k`` (score, id) of every slot, higher scores first and ties by the smaller id; an entry that repeats both counts once.

    New entries wait until there are enough of them, then one sort merges them, as it merges the heaps of two tasks.
    """

    def __init__(self, slots: int, k: int):
        self.k = k
        self.entries = tuple(np.zeros(0, dtype=np.int64) for _ in range(3))
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n_waiting = 0
        #: The score that an entry must reach to be looked at.
        self.floor = np.full(slots, np.iinfo(np.int64).min)

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if len(slot):
            self.waiting.append((slot, score, ids))
            self.n_waiting += len(slot)
            if self.n_waiting > max(PENDING, len(self.entries[0])):
                self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.waiting:
            slot, score, ids = (np.concatenate(c) for c in zip(self.entries, *self.waiting))
            self.waiting, self.n_waiting = [], 0
            order = np.lexsort((ids, ~score, slot))
            slot, score, ids = slot[order], score[order], ids[order]
            new = np.ones(len(slot), dtype=bool)
            new[1:] = (slot[1:] != slot[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])
            slot, score, ids = slot[new], score[new], ids[new]
            place = np.arange(len(slot)) - np.searchsorted(slot, slot)
            last = place == self.k - 1
            self.floor[slot[last]] = score[last]
            self.entries = tuple(c[place < self.k] for c in (slot, score, ids))
        return self.entries


def quantised(vectors: pa.ListArray, dim: int, scale: int) -> np.ndarray:
    """floor(scale * x) of every component, one line per vector; a vector of fewer components than ``dim`` is filled up with zeros."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    limit = float(1 << 63)
    values = np.floor(flat * scale)
    whole = np.where(values >= limit, np.iinfo(np.int64).max, np.where(values < -limit, np.iinfo(np.int64).min, 0))
    fits = (values < limit) & (values >= -limit)
    whole[fits] = values[fits].astype(np.int64)
    lengths = pa.compute.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    if len(lengths) and (lengths == dim).all():
        return whole.reshape(len(lengths), dim)
    out = np.zeros((len(lengths), dim), dtype=np.int64)
    line = np.repeat(np.arange(len(lengths)), lengths)
    out[line, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = whole
    return out


def _tiles(batches: Iterator[pa.RecordBatch], anchors: np.ndarray, dim: int, scale: int):
    """(first anchor, ids, labels, scores) of every tile of the anchors and the candidates of a task."""
    for batch in batches:
        for low in range(0, batch.num_rows, TILE_ROWS):
            piece = batch.slice(low, TILE_ROWS)
            ids, labels = (piece.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label"))
            right = np.ascontiguousarray(quantised(piece.column("vector"), dim, scale).T)
            for first in range(0, len(anchors), TILE_ANCHORS):
                yield first, ids, labels, strassen(anchors[first : first + TILE_ANCHORS], right)


def _positives(shared, dim: int, scale: int, k: int):
    """Candidates to the best ``k`` other rows of the same label of every anchor, as far as this task sees them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor_ids, anchor_labels, anchors = shared.value[:3]
        heaps = Heaps(len(anchor_ids), k)
        for first, ids, labels, scores in _tiles(batches, anchors, dim, scale):
            part = slice(first, first + len(scores))
            wanted = (anchor_labels[part, None] == labels) & (anchor_ids[part, None] != ids) & (scores >= heaps.floor[part, None])
            a, c = np.nonzero(wanted)
            heaps.add(a + first, scores[a, c], ids[c])
        slot, score, ids = heaps.merge()
        yield pa.RecordBatch.from_arrays([pa.array(anchor_ids[slot]), pa.array(ids), pa.array(score)], names=["anchor_id", "positive_id", "positive_score"])

    return run


def _negatives(shared, dim: int, scale: int, k: int):
    """Candidates to the best ``k`` rows of another label within the window of every positive, as far as this task sees them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor_ids, anchor_labels, anchors, positive_ids, positive_scores, low, high = shared.value  # from the fourth: a column per positive
        each = positive_ids.shape[1]
        heaps = Heaps(positive_ids.size, k)
        for first, ids, labels, scores in _tiles(batches, anchors, dim, scale):
            part = slice(first, first + len(scores))
            other = anchor_labels[part, None] != labels
            floors = heaps.floor.reshape(-1, each)[part]
            for j in range(each):
                least = np.maximum(low[part, j], floors[:, j])
                a, c = np.nonzero(other & (scores >= least[:, None]) & (scores <= high[part, j, None]))
                heaps.add((a + first) * each + j, scores[a, c], ids[c])
        slot, score, ids = heaps.merge()
        columns = [anchor_ids[slot // each], positive_ids.ravel()[slot], positive_scores.ravel()[slot], ids, score]
        names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return run


def _ranked(rows: DataFrame, keys: list[str], other: str, score: str, k: int) -> DataFrame:
    """The heaps of all tasks merged: the best ``k`` of every key, with their rank. Each task gave ``k`` rows of a key at most."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), other)
    return rows.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _windows(scores: list[list[int]], window: tuple[int, int], each: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of a negative of each positive; absent positives and windows without a score are empty."""
    least, most = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    low, high = np.full((len(scores), each), most), np.full((len(scores), each), least)
    for i, mine in enumerate(scores):
        for j, s in enumerate(mine):
            low[i, j], high[i, j] = max(-((-window[0] * s) // 100), least), min((window[1] * s) // 100, most)
    return low, high


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
    scale: int = SCALE,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that ``is_anchor`` holds for.

    The score of two rows is the inner product of their vectors after floor(scale * x). An anchor's positives are the best
    ``positives`` other rows of its label; the negatives of a positive are the best ``negatives`` rows of other labels with
    window[0] * positive_score <= 100 * negative_score <= window[1] * positive_score. Higher scores come first, ties by smaller id.

    Anchors are dealt by a hash of their id into groups of about ``group_bytes``. Each group scans all candidates twice, once for
    the positives and once for the windows they open. A task multiplies tiles of its candidates with the anchors of the group and keeps
    bounded heaps; only these are shuffled, and merged by rank. So no pair is written, no label or vector is a key of a shuffle (a vector
    that a third of all rows share costs what others cost), and memory follows from the group and the tile.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part. Vectors of different lengths are compared as if the
    shorter ended in zeros. Integers beyond 64 bits become the nearest of 64 bits, and products are taken modulo 2**64. Ids and labels are whole numbers.
    Rows that repeat an id are rows of their own, but the same id with the same score counts once; of anchors that repeat
    an id the one with the least label and vector counts. An empty table gives no rows; other columns are ignored, whatever their names.
    """
    taking_part = F.col(vector).isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    spark = rows.sparkSession
    mine = rows.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull()).filter(taking_part).select(
        F.col(id_col).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vector"), is_anchor.alias("is_anchor")
    )
    candidates = mine.drop("is_anchor")
    anchors = mine.filter("is_anchor").groupBy("id").agg(F.min(F.struct("label", "vector")).alias("v")).select("id", "v.*")
    anchors = stage(anchors, "anchors")
    dim = candidates.agg(F.max(F.size("vector")).alias("d")).first()["d"] or 0
    groups = max(1, math.ceil(anchors.count() * dim * 8 / group_bytes))
    dealt = anchors.withColumn("group", F.pmod(F.xxhash64("id"), F.lit(groups)))
    pair = "anchor_id long, positive_id long, positive_score long"

    def held(group: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        table = group.toArrow().combine_chunks()  # about group_bytes
        ids, labels = (table.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("id", "label"))
        vectors = table.column("vector").combine_chunks() if table.num_rows else pa.array([], pa.list_(pa.float64()))
        return ids, labels, quantised(vectors, dim, scale)

    best = []
    for g in range(groups):
        shared = spark.sparkContext.broadcast(held(dealt.filter(F.col("group") == g)))
        best.append(candidates.mapInArrow(_positives(shared, dim, scale, positives), pair))
    chosen = stage(_ranked(reduce(DataFrame.union, best), ["anchor_id"], "positive_id", "positive_score", positives), "positives")
    per_anchor = chosen.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("found"))
    dealt = stage(dealt.join(per_anchor, F.col("id") == F.col("anchor_id")), "anchors-positives")

    best = []
    for g in range(groups):
        group = dealt.filter(F.col("group") == g)
        found = group.select("id", "label", "vector", "found").toArrow().combine_chunks()
        ids, labels = (found.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("id", "label"))
        listed = found.column("found").to_pylist()
        positive_ids, positive_scores = np.zeros((len(ids), positives), dtype=np.int64), np.zeros((len(ids), positives), dtype=np.int64)
        for i, some in enumerate(listed):
            for j, p in enumerate(some):
                positive_ids[i, j], positive_scores[i, j] = p["positive_id"], p["positive_score"]
        low, high = _windows([[p["positive_score"] for p in some] for some in listed], window, positives)
        vectors = found.column("vector").combine_chunks() if len(ids) else pa.array([], pa.list_(pa.float64()))
        shared = spark.sparkContext.broadcast((ids, labels, quantised(vectors, dim, scale), positive_ids, positive_scores, low, high))
        best.append(candidates.mapInArrow(_negatives(shared, dim, scale, negatives), pair + ", negative_id long, negative_score long"))
    result = _ranked(reduce(DataFrame.union, best), ["anchor_id", "positive_id", "positive_score"], "negative_id", "negative_score", negatives)
    return result.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
