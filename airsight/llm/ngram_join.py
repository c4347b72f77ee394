"""Similarity self-join of documents on word n-grams: MinHash banding, then exact Jaccard on full n-gram sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airsight.llm.common import fresh, text_key, whole
from airsight.llm.shingles import SHINGLE_WORDS, mix, shingles_of, slices
from airsight.session import lookup, stage

THRESHOLD = 0.8
#: Share of the pairs at the threshold that banding must propose; pairs above it are proposed more often.
RECALL = 0.9999
#: Hash functions of a signature at most.
MAX_HASHES = 128
#: Distinct n-grams of all texts in one block of a bucket, about; a text of more is a block of its own at worst.
BLOCK_GRAMS = 150_000
#: What a text counts for besides its n-grams, so that blocks of tiny texts stay small too.
TEXT_GRAMS = 200
SEED = 77


def band_plan(threshold: float, recall: float, most: int = MAX_HASHES) -> tuple[int, int]:
    """Bands and rows per band: the most selective plan within ``most`` hash functions that reaches ``recall`` at ``threshold``."""
    best = (1, 1)
    for rows in range(1, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows)))
        if bands * rows > most:
            break
        best = (bands, rows)
    return best


def _signatures(grams: np.ndarray, counts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes of every text that has n-grams, one line per text."""
    starts = (np.cumsum(counts) - counts)[counts > 0]
    factors = mix(np.arange(1, bands * rows + 1, dtype=np.uint64) + np.uint64(SEED)) | np.uint64(1)
    out = np.empty((len(starts), bands), dtype=np.uint64)
    for b in range(bands):
        band = np.full(len(starts), b, dtype=np.uint64)
        for r in range(rows):
            least = np.minimum.reduceat(grams * factors[b * rows + r], starts)
            band = mix(band ^ least) + np.uint64(r)
        out[:, b] = mix(band)
    return out


def _banded(bands: int, rows: int, n: int):
    """(key, text) to (key, grams, bands): texts without words get none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", 512 << 10):
                grams, counts = shingles_of(piece.column("text"), n)
                if not len(grams):
                    continue
                some = np.flatnonzero(counts)
                hashes = _signatures(grams, counts, bands, rows)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, hashes.size + 1, bands, dtype=np.int32)), pa.array(hashes.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("key").take(pa.array(some)), pa.array(counts[some]), lists], names=["key", "grams", "bands"]
                )

    return run


def _gram_sets(n: int):
    """(key, buckets, text) to the same with ``grams``, the sorted distinct hashes, for ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                grams, counts = shingles_of(piece.column("text"), n)
                sets = [np.unique(part).tobytes() for part in np.split(grams, np.cumsum(counts)[:-1])]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("key"), piece.column("buckets"), pa.array(sets, pa.binary())], names=["key", "buckets", "grams"]
                )

    return run


def similar_pairs(
    left: list[np.ndarray], right: list[np.ndarray] | None, threshold: float, known: tuple[np.ndarray, np.ndarray] | None = None
) -> Iterator[tuple[int, np.ndarray]]:
    """For every set of ``left``, the positions in ``right`` (None: of later sets of ``left``) with Jaccard at the threshold or above.

    Sets stand ordered by size, so that only a run of comparable sizes is looked at; members are renumbered over all sets, so
    one gather and one segmented sum give a set's intersections with all others. ``known`` has a 0/1 line per set of either side:
    pairs whose lines share a 1 are left out.
    """
    others = left if right is None else right
    sizes = np.array([len(s) for s in others])
    order = np.argsort(sizes, kind="stable")
    ordered = sizes[order]
    universe, numbers = np.unique(np.concatenate([others[i] for i in order]), return_inverse=True)
    starts = np.cumsum(ordered) - ordered
    seen = np.zeros(len(universe), dtype=np.int32)
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    for i, mine in enumerate(left):
        low = int(np.searchsorted(ordered, math.ceil(threshold * len(mine) - 1e-9)))
        high = int(np.searchsorted(ordered, math.floor(len(mine) / threshold + 1e-9), side="right"))
        if right is None:
            low = max(low, int(rank[i]) + 1)
        open_ = np.arange(low, high)
        if known is not None and low < high:
            open_ = open_[known[1][order[low:high]] @ known[0][i] == 0]
        if not len(open_):
            continue
        if right is None:
            at = numbers[starts[rank[i]] : starts[rank[i]] + len(mine)]
        else:
            at = np.minimum(np.searchsorted(universe, mine), len(universe) - 1)
            at = at[universe[at] == mine]
        lengths = ordered[open_]
        ends = np.cumsum(lengths)
        if len(open_) == high - low:
            members = numbers[starts[low] : starts[high - 1] + ordered[high - 1]]
        else:
            members = numbers[np.arange(ends[-1]) + np.repeat(starts[open_] - (ends - lengths), lengths)]
        seen[at] = 1
        both = np.add.reduceat(seen[members], ends - lengths)
        seen[at] = 0
        found = both >= threshold * (len(mine) + lengths - both) - 1e-9
        if found.any():
            yield i, order[open_[found]]


def _shared_before(bucket: int, lists: list[np.ndarray]) -> np.ndarray | None:
    """A 0/1 line per text over the smaller buckets that several of the texts are in; None without such buckets."""
    flat = np.concatenate(lists)
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    less = flat < bucket
    names, column, counts = np.unique(flat[less], return_inverse=True, return_counts=True)
    if not (counts > 1).any():
        return None
    new = np.cumsum(counts > 1) - 1
    several = counts[column] > 1
    out = np.zeros((len(lists), int(new[-1]) + 1), dtype=np.float32)
    out[owner[less][several], new[column[several]]] = 1
    return out


Member = tuple[bytes, bool, np.ndarray, np.ndarray]


def _verified(bucket: int, same: bool, rows: list[Member], threshold: float) -> Iterator[tuple[bytes, int, bytes]]:
    """(key, links, root) of a task's texts that have links here.

    A pair that shares several buckets belongs to the least of them and is left out of the others. ``root`` is the same for all texts
    that the links of this task connect. So a bucket of m similar texts gives m rows, not its m * (m - 1) / 2 pairs.
    """
    ours, theirs = [r for r in rows if r[1]], [r for r in rows if not r[1]]
    if not ours or (not theirs and (not same or len(ours) < 2)):
        return
    every = ours + theirs
    parent = list(range(len(every)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    shared = _shared_before(bucket, [r[2] for r in every])
    known = None if shared is None else (shared, shared) if same else (shared[: len(ours)], shared[len(ours) :])
    links = np.zeros(len(every), dtype=np.int64)
    shift = 0 if same else len(ours)
    for i, found in similar_pairs([r[3] for r in ours], None if same else [r[3] for r in theirs], threshold, known):
        links[i] += len(found)
        links[found + shift] += 1
        for j in (found + shift).tolist():
            a, b = find(i), find(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
    for i in np.flatnonzero(links).tolist():
        yield every[i][0], int(links[i]), every[find(i)][0]


def _verify(threshold: float):
    """Rows of tasks, each task's rows together, to (key, links, root)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task: tuple[int, int, int] | None = None
        rows: list[Member] = []
        out: list[tuple[bytes, int, bytes]] = []

        def made() -> pa.RecordBatch:
            key, links, root = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(key, pa.binary()), pa.array(links, pa.int64()), pa.array(root, pa.binary())], names=["key", "links", "root"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("bucket", "low", "high", "is_low", "key")]
            for b, low, high, is_low, key, buckets, grams in zip(*columns, batch.column("buckets"), batch.column("grams")):
                if (b, low, high) != task:
                    if task:
                        out.extend(_verified(task[0], task[1] == task[2], rows, threshold))
                    task, rows = (b, low, high), []
                    if len(out) > 20_000:
                        yield made()
                        out = []
                rows.append((key, is_low, buckets.values.to_numpy(), np.frombuffer(grams.as_buffer(), dtype=np.uint64)))
        if task:
            out.extend(_verified(task[0], task[1] == task[2], rows, threshold))
        if out:
            yield made()

    return run


def components(edges: DataFrame) -> DataFrame:
    """(key, root) edges to (key, root) with the least key of each connected component as root, for every key that has an edge.

    Large and small stars in turn: every round links the neighbours of a key to the least of them. Each round is written to
    the shared folder, so nothing is computed twice, and neither components nor links pass through the driver, only their number.
    """
    now = stage(edges.filter("key <> root").select(F.greatest("key", "root").alias("key"), F.least("key", "root").alias("root")).distinct(), "stars")
    before = None
    while True:
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("key", "root").cast("decimal(38, 0)")).alias("h")).first()
        if mark == before:
            return now.union(now.select(F.col("root").alias("key"), "root").distinct())
        before = mark
        both = now.union(now.select(F.col("root").alias("key"), F.col("key").alias("root")))
        # written, as a key that a third of all texts link to can be split in a join only apart from its aggregate
        least = lookup(both.groupBy("key").agg(F.least(F.col("key"), F.min("root")).alias("least")), "least")
        large = both.filter("root > key").join(least, "key").select(F.col("root").alias("key"), F.col("least").alias("root")).distinct()
        large = stage(large, "large-stars")
        least = lookup(large.groupBy("key").agg(F.min("root").alias("least")), "least")
        small = large.join(least, "key")
        small = small.select(F.explode(F.array(F.struct("key", F.col("least").alias("root")), F.struct(F.col("root").alias("key"), F.col("least").alias("root")))).alias("e"))
        now = stage(small.select("e.*").filter("key <> root").distinct(), "stars")


def classified(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, n: int = SHINGLE_WORDS, recall: float = RECALL
) -> DataFrame:
    """One row per document: ``doc_id``, ``text_id``, ``copies``, ``links``, ``class_id``, and as keys of text and class ``key`` and ``root``.

    ``text_id`` is the largest id among documents of the very same text, ``copies`` their number, ``links`` the number of
    different other texts with an n-gram Jaccard of ``threshold`` or above, and ``class_id`` the largest id among all
    documents that links and equal texts connect.

    1. Copies collapse to one text. Its MinHash signature gives ``bands`` hashes; texts meet in the buckets they share.
    2. Buckets with one text go. Buckets with the very same texts are one bucket: the one with the least hash.
    3. A bucket is cut into blocks of about ``BLOCK_GRAMS`` n-grams and every pair of its blocks is one task, so that no
       task grows with the bucket. Tasks are dealt by ranges of rows, compare full n-gram sets and return one row per text, never pairs.
    4. Components of the linked texts are found by stars over written tables.

    Words are runs of characters other than ASCII white space; n-grams are compared by 64-bit hashes. A text of fewer
    than ``n`` words has one n-gram of all its words. Null counts as empty; empty and blank texts have no n-gram and no links, but equal
    ones share a class. A null id is less than any other. Rows that repeat an id and its text count as copies. Other
    columns are ignored, whatever their names.
    """
    bands, rows = band_plan(threshold, recall)
    docs = docs.select(F.col(id_col).alias("doc_id"), whole(F.col(text)).alias("text"))
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("key"), "text")
    ids = stage(keyed.select("doc_id", "key"), "text-keys")
    banded = keyed.select("key", "text").mapInArrow(_banded(bands, rows, n), "key binary, grams long, bands array<long>")
    banded = stage(banded.groupBy("key").agg(F.first("grams").alias("grams"), F.first("bands").alias("bands")), "bands")  # copies have equal bands
    in_bucket = banded.select("key", "grams", F.explode("bands").alias("bucket"))
    buckets = in_bucket.groupBy("bucket").agg(
        F.count("*").alias("n"), F.sum(F.col("grams") + TEXT_GRAMS).alias("grams"), F.bit_xor(F.xxhash64("key")).alias("mark"),
        F.bit_xor(F.xxhash64(F.lit(SEED), "key")).alias("mark2"),
    ).filter("n > 1")
    buckets = buckets.groupBy("n", "mark", "mark2").agg(F.min("bucket").alias("bucket"), F.max("grams").alias("grams"))
    buckets = lookup(buckets.select("bucket", F.ceil(F.col("grams") / BLOCK_GRAMS).cast("int").alias("blocks")), "buckets")
    members = stage(
        in_bucket.join(buckets, "bucket").groupBy("key").agg(F.collect_list(F.struct("bucket", "blocks")).alias("buckets")), "members"  # at most one per band
    )
    texts = keyed.select("key", "text").join(lookup(members.select("key"), "member-keys"), "key", "left_semi")
    texts = texts.groupBy("key").agg(F.first("text").alias("text")).join(members, "key")
    # written, as dealing by ranges looks at the rows before it deals them
    sets = stage(texts.mapInArrow(_gram_sets(n), "key binary, buckets array<struct<bucket:bigint,blocks:int>>, grams binary"), "gram-sets")
    mine = F.pmod(F.xxhash64("key", "at.bucket"), F.col("at.blocks").cast("long")).cast("int")
    per_bucket = sets.select("key", "grams", F.transform("buckets", lambda b: b["bucket"]).alias("buckets"), F.explode("buckets").alias("at"))
    per_bucket = per_bucket.select("key", "grams", "buckets", "at", mine.alias("mine"))
    tasks = per_bucket.select(
        "key", "grams", "buckets", F.col("at.bucket").alias("bucket"), "mine", F.explode(F.sequence(F.lit(0), F.col("at.blocks") - 1)).alias("other")
    )
    tasks = tasks.select(
        "bucket", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), (F.col("mine") <= F.col("other")).alias("is_low"), "key", "buckets", "grams"
    )
    # by ranges of about as many rows each, so that the many tasks of a large bucket stand in line and no two of them meet by chance
    together = tasks.repartitionByRange("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    linked = stage(together.mapInArrow(_verify(threshold), "key binary, links long, root binary"), "links")
    roots = components(linked.select("key", "root"))
    counts = linked.groupBy("key").agg(F.sum("links").alias("links"))
    per_text = ids.groupBy("key").agg(F.max("doc_id").alias("text_id"), F.count("*").alias("copies"))
    per_text = per_text.join(counts, "key", "left").join(roots, "key", "left")
    per_text = stage(per_text.select("key", "text_id", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "key").alias("root")), "texts")
    classes = per_text.groupBy("root").agg(F.max("text_id").alias("class_id"))
    return ids.join(per_text.join(classes, "root"), "key").select("doc_id", "text_id", "copies", "links", "class_id", "key", "root")


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The result of ``classified`` without its keys."""
    return classified(docs, id_col, text, threshold).drop("key", "root")


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each class, all its columns as they are: the one with the largest id, and of texts that repeat
    that id the one with the largest key. Rows that repeat both stay once."""
    mine = [fresh(c, docs.columns) for c in ("keep_id", "keep_key", "text_key")]
    classes = stage(classified(docs, id_col, text, threshold).select("doc_id", "key", "root"), "classes")
    kept = classes.groupBy("root").agg(F.max(F.struct("doc_id", "key")).alias("keep"))
    repeats = classes.groupBy("doc_id", "key").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id", "key", F.lit(True).alias("again"))
    kept = kept.select(F.col("keep.doc_id").alias("doc_id"), F.col("keep.key").alias("key"))
    same = kept["doc_id"].eqNullSafe(repeats["doc_id"]) & (kept["key"] == repeats["key"])
    kept = kept.join(repeats, same, "left").select(kept["doc_id"].alias(mine[0]), kept["key"].alias(mine[1]), "again")
    kept = stage(kept, "kept")
    keyed = docs.withColumn(mine[2], text_key(F.col(text)))

    def those(keep: DataFrame) -> DataFrame:
        keep = keep.drop("again")
        return keyed.join(keep, F.col(id_col).eqNullSafe(F.col(mine[0])) & (F.col(mine[2]) == F.col(mine[1])), "left_semi")

    once = those(kept.filter("again IS NULL")).drop(mine[2])
    again = kept.filter("again")
    return once if again.isEmpty() else once.union(those(again).dropDuplicates([id_col, mine[2]]).drop(mine[2]))
