"""Benchmark decontamination: size-partitioned MinHash containment search, verified on shingle hashes, then on the words."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airsight.llm.common import fresh, text_key, whole
from airsight.llm.shingles import SHINGLE_WORDS, shingle_hashes, slices, text_bytes, word_hashes
from airsight.session import lookup, sized, stage

#: Share of an item's shingles that a document must hold.
THRESHOLD = 0.8
#: Probability that the search proposes a pair whose containment is just at the threshold.
RECALL = 0.999
#: Shingles per bin, at most, that sketches come in: from all shingles to one in 16 to 32.
LOADS = (0, 1, 2, 4, 8, 16, 32)
#: Bytes of distinct item shingles that tasks hold to pick a document's hits; more of them are met by a join.
PROBE_BYTES = 32 << 20


def indexed_shingles(grams: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """How many of an item's shingles, the rarest ones, are indexed, and how many of these a document at the threshold holds at least.

    Such a document lacks ``grams`` - shared of the item's shingles at most, so of any ``kept`` of them it holds kept - (grams - shared).
    Half of the shared ones are enough for the search, so as many of the most frequent shingles are left out.
    """
    shared = max(1, math.ceil(threshold * grams - 1e-9))
    least = (shared + 1) // 2
    return grams - shared + least, least


def item_load(grams: int, threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """The largest load at which an item of so many shingles is found with probability ``recall``.

    At a load of m shingles per bin a shared shingle is the minimum of its bin with probability (1 - e^-m) / m, and one of the
    indexed shingles that the document holds suffices. Very short items need load 0, where every shingle is its own minimum.
    """
    need = 1 - (1 - recall) ** (1 / indexed_shingles(grams, threshold)[1])
    return max((m for m in LOADS[1:] if (1 - math.exp(-m)) / m >= need), default=0)


def _minima(grams: np.ndarray, load: int, size: int) -> np.ndarray:
    """Which of the sorted ``grams`` are the least of their bin, for a set of ``size`` shingles with ``load`` of them per bin.

    Bins are runs of leading bits, so the number of bins depends on the power of two from ``size`` on only: the size partition.
    """
    bits = max(0, (size - 1).bit_length() - (load.bit_length() - 1)) if load else 0
    if not load or bits > 60:
        return np.ones(len(grams), dtype=bool)
    if not bits:
        first = np.zeros(len(grams), dtype=bool)
        first[:1] = True
        return first
    bins = grams >> np.uint64(64 - bits)
    return np.concatenate([[True], bins[1:] != bins[:-1]])[: len(grams)]


def _document_hits(loads: list[int], n: int, short: list[int], probe: np.ndarray | None):
    """(doc_id, text) to (doc_id, gram, load): distinct shingles, each with the largest load at which it is the minimum of its bin.

    With ``probe``, the sorted shingles of all items, only those among them are returned. ``short`` has the lengths of items of fewer words than
    ``n``; runs of so many words are returned too, at load 0, where such items are looked up.
    """

    def wanted(grams: np.ndarray) -> np.ndarray:
        if probe is None:
            return np.ones(len(grams), dtype=bool)
        at = np.minimum(np.searchsorted(probe, grams), max(len(probe) - 1, 0))
        return probe[at] == grams if len(probe) else np.zeros(len(grams), dtype=bool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", 1 << 20):
                words, counts = word_hashes(*text_bytes(piece.column("text")))
                ids, out, tops, rows = piece.column("doc_id"), [], [], []
                for k in [n, *short]:
                    grams, sizes = shingle_hashes(words, counts, k)
                    for row, part in enumerate(np.split(grams, np.cumsum(sizes)[:-1])):
                        if not len(part):
                            continue
                        part = np.unique(part)
                        here = np.flatnonzero(wanted(part))
                        if not len(here):
                            continue
                        top = np.zeros(len(part), dtype=np.int32)
                        for load in loads if k == n else []:  # minima at a load are minima at smaller loads too
                            top[_minima(part, load, len(part))] = load
                        out.append(part[here])
                        tops.append(top[here])
                        rows.append(np.full(len(here), row))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(np.concatenate(rows))), pa.array(np.concatenate(out).view(np.int64)), pa.array(np.concatenate(tops))],
                        names=["doc_id", "gram", "load"],
                    )

    return run


def _item_grams(n: int):
    """(item, text) to (item, words, grams, gram), a row per distinct shingle; ``words`` is that of a shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                hashes, words = word_hashes(*text_bytes(piece.column("text")))
                grams, counts = shingle_hashes(hashes, words, n)
                sets = [np.unique(part) for part in np.split(grams, np.cumsum(counts)[:-1])]
                sizes = np.array([len(s) for s in sets])
                flat = np.concatenate(sets) if len(sets) else np.zeros(0, dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("item").take(pa.array(np.repeat(np.arange(len(sets)), sizes))), pa.array(np.repeat(np.minimum(words, n), sizes)),
                        pa.array(np.repeat(sizes, sizes)), pa.array(flat.view(np.int64)),
                    ],
                    names=["item", "words", "grams", "gram"],
                )

    return run


def _exact(threshold: float, n: int):
    """(doc_id, text, item, item_text), a document's rows together, to verified (doc_id, item, matched, item_shingles)."""

    def words_of(text: str) -> list[str]:
        return [x for x in text.translate(_SPACES).split(" ") if x]

    def shingle_set(w: list[str], k: int) -> set[tuple[str, ...]]:
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, words, held = None, [], {}
        for batch in batches:
            out = []
            for doc_id, text, item, item_text in zip(*(batch.column(c) for c in ("doc_id", "text", "item", "item_text"))):
                text = text.as_py()
                if text != last:
                    last, words, held = text, words_of(text), {}
                mine = words_of(item_text.as_py())
                k = min(n, len(mine))
                if k not in held:
                    held[k] = shingle_set(words, k)
                wanted = shingle_set(mine, k)
                matched = len(wanted & held[k])
                if matched >= threshold * len(wanted) - 1e-9:
                    out.append((doc_id.as_py(), item.as_py(), matched, len(wanted)))
            if out:
                doc_id, item, matched, size = zip(*out)
                columns = [pa.array(doc_id, pa.int64()), pa.array(item, pa.binary()), pa.array(matched, pa.int64()), pa.array(size, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item", "matched", "item_shingles"])

    return run


_SPACES = {c: " " for c in range(9, 14)}


def contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", text: str = "text", threshold: float = THRESHOLD, n: int = SHINGLE_WORDS
) -> DataFrame:
    """Pairs of a document and a test item of whose distinct ``n``-word shingles the document holds at least ``threshold``.

    Columns: ``doc_id``, ``item_id``, ``matched``, ``item_shingles``, ``containment``.

    Jaccard similarity of a short item and a long document is tiny, so one signature size cannot serve all. Documents are
    partitioned by size; a document of a partition has as many MinHash bins (one-permutation hashing) as its size needs to keep the number
    of shingles per bin in bounds, and an item's shingles are looked up among the minima of those bins. The bound follows from the
    item's size (``item_load``), so short items meet finer sketches. Work is linear in the text.

    1. Tasks return the shingles of a document that items have at all, written as its hits; hits are counted per shingle.
    2. Of an item its rarest shingles are indexed (``indexed_shingles``), so a phrase that many documents and many items share proposes no pair.
    3. A proposed pair is verified on the hashes of all hits of the document, then on the words themselves, so results are exact but for
       pairs the search misses (at most one in 1,000 at the threshold, fewer above). Texts are joined only for the second.

    The items' shingles go to the tasks only while they have ``PROBE_BYTES`` at most; otherwise all shingles are joined with them.

    Words are runs of characters other than ASCII white space. An item of fewer than ``n`` words has one shingle of all its words, and is looked
    up among the runs of so many words of every document. Null and empty items and documents give no pair. Texts of any length are
    read in one task, about eight bytes a word. Repeated rows give their pair once; rows that repeat an id with different texts give the largest
    containment. A null id takes part and stays null. Other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(F.col(text)).alias("text"))
    items = items.select(F.col(item_col).cast("long").alias("item_id"), whole(F.col(text)).alias("item_text"))
    items = stage(items.distinct().withColumn("item", text_key(F.col("item_text"))), "items")
    texts = items.groupBy("item").agg(F.first("item_text").alias("item_text"))
    grams = stage(texts.select("item", F.col("item_text").alias("text")).mapInArrow(_item_grams(n), "item binary, words long, grams long, gram long"), "item-grams")
    sizes = grams.select("words", "grams").distinct().collect()  # distinct sizes of items, not items
    if not sizes:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, matched long, item_shingles long, containment double")
    short = sorted({r["words"] for r in sizes if r["words"] < n})
    plan = {r["grams"]: (indexed_shingles(r["grams"], threshold)[0], item_load(r["grams"], threshold)) for r in sizes}
    loads = sorted({load for _, load in plan.values()} - {0})
    kept, load = (F.element_at(F.create_map(*[F.lit(x) for g, p in plan.items() for x in (g, p[i])]), F.col("grams")) for i in (0, 1))

    distinct = stage(grams.select("gram").distinct(), "distinct-grams")
    fits = distinct.count() * 8 <= PROBE_BYTES
    probe = np.sort(distinct.toArrow().column("gram").to_numpy().view(np.uint64)) if fits else None
    hits = docs.mapInArrow(_document_hits(loads, n, short, probe), "doc_id long, gram long, load int")
    hits = stage(hits if fits else hits.join(distinct, "gram", "left_semi"), "hits")
    often = lookup(hits.groupBy("gram").agg(F.count("*").alias("n")), "hit-counts")
    rarest = Window.partitionBy("item").orderBy(F.coalesce("n", F.lit(0)), "gram")  # the shingles of one item
    ranked = grams.join(often, "gram", "left").withColumn("place", F.row_number().over(rarest)).filter(F.col("place") <= kept)
    index = lookup(ranked.select("item", "gram", load.cast("int").alias("item_load")), "item-index")
    proposed = stage(hits.join(index, "gram").filter("load >= item_load").select("doc_id", "item").distinct(), "candidates")
    mine = proposed.select(F.col("doc_id").alias("candidate"), F.col("item").alias("of"))
    held = hits.join(sized(mine), F.col("doc_id").eqNullSafe(F.col("candidate"))).select("doc_id", "gram", "of")
    met = held.join(sized(grams.select(F.col("item").alias("of"), "gram", "grams")), ["of", "gram"])
    matched = met.groupBy("doc_id", "of").agg(F.count_distinct("gram").alias("matched"), F.first("grams").alias("grams"))
    pairs = stage(matched.filter(F.col("matched") >= threshold * F.col("grams") - 1e-9).select(F.col("doc_id").alias("candidate"), F.col("of").alias("item")), "pairs")

    both = docs.join(sized(pairs), F.col("doc_id").eqNullSafe(F.col("candidate"))).join(sized(texts), "item")
    exact = both.select("doc_id", "text", "item", "item_text").mapInArrow(_exact(threshold, n), "doc_id long, item binary, matched long, item_shingles long")
    share = F.col("matched") / F.col("item_shingles")
    best = exact.join(items.select("item", "item_id"), "item").select("doc_id", "item_id", F.struct(share.alias("containment"), "matched", "item_shingles").alias("best"))
    best = best.groupBy("doc_id", "item_id").agg(F.max("best").alias("best"))
    return best.select("doc_id", "item_id", "best.matched", "best.item_shingles", "best.containment")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that hold a test item; all columns as they are. Rows that share a removed id go together; rows
    without an id are told apart by a 64-bit hash of their text."""
    mine, theirs = fresh("document_id", docs.columns), fresh("contaminated_id", docs.columns)
    known = docs.withColumn(mine, F.coalesce(F.col(id_col).cast("long"), F.xxhash64(whole(F.col(text)))))
    bad = contaminated(known, items, mine, "item_id", text, threshold).select(F.col("doc_id").alias(theirs)).distinct()
    return known.join(lookup(bad, "contaminated"), F.col(mine) == F.col(theirs), "left_anti").drop(mine)
