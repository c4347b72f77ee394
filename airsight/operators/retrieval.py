"""Vector top-k, citations, de-duplication, context packing and prompt tables."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airsight import advice_text as text
from airsight import config as cfg
from airsight.functions.text import collapse, has_content, strip, token_estimate
from airsight.session import max_broadcast_bytes, stage

#: What stands for an absent source or category.
UNKNOWN_SOURCE, DEFAULT_CATEGORY = "unknown", "General"
_CITATION = r"\[([^\[\]]+?\.[a-zA-Z]{2,5})\]"  # a fixed value


# --- vector top-k -------------------------------------------------------------


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Unit rows of a list column as a dense matrix."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype("float64")
    if len(flat) % max(len(lists), 1):
        raise ValueError("vectors have different dimensions")
    rows = flat.reshape(len(lists), len(flat) // max(len(lists), 1))
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1.0)


def _ids(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    ids = column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False)
    return ids.astype(str) if ids.dtype == object else ids


class _Best:
    """The k best (similarity, id) per query seen so far; equal similarities go to the smaller id.

    The first rows set a floor for every query. Of the others, products in single precision tell which may reach the floor, and only these few are
    computed again in double precision and ranked. ``slack`` is more than single precision can be wrong by, so no row is lost.
    """

    cells, first = 4_000_000, 16  # similarities held at a time; rows that set the floor

    def __init__(self, n_queries: int, k: int):
        self.k, self.sims, self.keys = k, np.full((n_queries, k), -np.inf), None

    def add(self, queries: np.ndarray, rows: np.ndarray, keys: np.ndarray) -> None:
        if self.keys is None:
            self.keys = np.zeros(self.sims.shape, dtype=keys.dtype)
        self.keys = self.keys.astype(np.result_type(self.keys, keys), copy=False)
        slack = (rows.shape[1] + 8) * 2.0**-23 + 1e-9
        asked, known = queries.astype(np.float32), rows.astype(np.float32)
        low, width = 0, self.first
        while low < len(rows):
            some = slice(low, low + width)
            tile = max(1, self.cells // width)
            for at in range(0, len(queries), tile):
                part = slice(at, at + tile)
                floor = (self.sims[part, -1] - slack).astype(np.float32)
                q, c = np.nonzero(asked[part] @ known[some].T >= floor[:, None])
                if len(q):
                    self._rank(at + q, low + c, queries, rows, keys)
            low, width = low + width, min(4096, 2 * width)

    def _rank(self, q: np.ndarray, c: np.ndarray, queries: np.ndarray, rows: np.ndarray, keys: np.ndarray) -> None:
        """Enter pairs of queries and rows, in the order of the queries, in the lists of their queries."""
        step = max(1, self.cells // rows.shape[1])
        sims = np.concatenate([np.einsum("ij,ij->i", queries[q[i : i + step]], rows[c[i : i + step]]) for i in range(0, len(q), step)])
        last, shown = self.sims[q, -1], np.round(sims, 10)
        enters = (shown > np.round(last, 10)) | (np.isneginf(last)) | ((shown == np.round(last, 10)) & (keys[c] < self.keys[q, -1]))
        q, c, sims = q[enters], c[enters], sims[enters]
        mine = np.unique(q)
        q, sims = np.concatenate([np.repeat(mine, self.k), q]), np.concatenate([self.sims[mine].ravel(), sims])
        found = np.concatenate([self.keys[mine].ravel(), keys[c]])
        order = np.lexsort((found, -np.round(sims, 10), q))
        q, sims, found = q[order], sims[order], found[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        best = place < self.k  # a query has k entries at least, if only empty ones
        self.sims[mine], self.keys[mine] = sims[best].reshape(-1, self.k), found[best].reshape(-1, self.k)

    def columns(self, query_ids: np.ndarray) -> list[pa.Array]:
        q, place = np.nonzero(self.sims > -np.inf)
        return [pa.array(query_ids[q]), pa.array(self.keys[q, place]), pa.array(self.sims[q, place])]


def _top_schema(queries: DataFrame, corpus: DataFrame, query_id: str, corpus_id: str) -> T.StructType:
    return T.StructType([
        T.StructField(query_id, queries.schema[query_id].dataType),
        T.StructField(corpus_id, corpus.schema[corpus_id].dataType),
        T.StructField("_sim", T.DoubleType()),
    ])


def _against_broadcast(queries, corpus, query_id, corpus_id, vector, k, schema):
    """Few queries: every task multiplies its corpus rows with the whole query matrix."""
    rows = queries.select(query_id, vector).toArrow()  # checked against airsight.maxBroadcastBytes
    if not rows.num_rows:
        return queries.sparkSession.createDataFrame([], schema)
    shared = queries.sparkSession.sparkContext.broadcast((_ids(rows[query_id]), _matrix(rows[vector])))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix = shared.value
        best = _Best(len(ids), k)
        for batch in batches:
            if batch.num_rows:
                best.add(matrix, _matrix(batch[vector]), _ids(batch[corpus_id]))
        if best.keys is not None:
            yield pa.RecordBatch.from_arrays(best.columns(ids), names=schema.names)

    # a small file is one partition, but every core can compare a part of it
    return corpus.select(corpus_id, vector).repartition(queries.sparkSession.sparkContext.defaultParallelism).mapInArrow(search, schema)


def _against_blocks(queries, corpus, query_id, corpus_id, vector, k, schema, n_queries, n_corpus, rows_per_block):
    """Many queries: both sides are cut into blocks of at most ``rows_per_block``, so many that every core has a few pairs of them, and each
    pair is one matrix product."""
    least = math.ceil(math.sqrt(4 * queries.sparkSession.sparkContext.defaultParallelism))
    rows_per_block = max(1, min(rows_per_block, math.ceil(max(n_queries, n_corpus) / least)))
    q_blocks, c_blocks = math.ceil(n_queries / rows_per_block), math.ceil(n_corpus / rows_per_block)
    block = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    left = queries.select(
        F.col(query_id), F.col(vector).alias("_query"), block(query_id, q_blocks).alias("_q"), F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))).alias("_c")
    )
    right = corpus.select(
        F.col(corpus_id), F.col(vector).alias("_row"), block(corpus_id, c_blocks).alias("_c"), F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("_q")
    )

    search = _search_block(query_id, corpus_id, k, schema)
    return left.groupBy("_q", "_c").cogroup(right.groupBy("_q", "_c")).applyInArrow(search, schema)


def _search_block(query_id: str, corpus_id: str, k: int, schema: T.StructType):
    """One block of queries (``_query``) against one block of the corpus (``_row``): the best k of each query. The two vectors are
    renamed because a cogroup mixes up columns that both sides take from one table."""

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            empty = [pa.array([], type=a[query_id].type), pa.array([], type=b[corpus_id].type), pa.array([], type=pa.float64())]
            return pa.Table.from_arrays(empty, names=schema.names)
        best = _Best(a.num_rows, k)
        best.add(_matrix(a["_query"]), _matrix(b["_row"]), _ids(b[corpus_id]))
        return pa.Table.from_arrays(best.columns(_ids(a[query_id])), names=schema.names)

    return search


def _searchable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    return rows.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & ~F.exists(F.col(vector), lambda x: x.isNull()))


def vector_topk(
    queries: DataFrame,
    corpus: DataFrame,
    query_id: str,
    corpus_id: str,
    vector: str = "embedding",
    k: int = cfg.TOP_K,
    threshold: float = cfg.SIMILARITY_THRESHOLD,
) -> DataFrame:
    """Exact cosine top-k per query: (query id, corpus id, rank, similarity).

    Each task keeps k rows per query, so no query-corpus pair is ever written out. The threshold applies after
    the top k are chosen and to the unrounded value. The two id columns need different names. Rows without an id, without a vector or with
    a NULL in it neither ask nor answer; vectors of different dimensions stop the job.
    """
    spark = queries.sparkSession
    queries, corpus = _searchable(queries, query_id, vector), _searchable(corpus, corpus_id, vector)
    dims = queries.select(F.size(vector).alias("d")).union(corpus.select(F.size(vector).alias("d"))).agg(F.min("d").alias("low"), F.max("d").alias("high")).first()
    if dims["low"] != dims["high"]:
        raise ValueError(f"vectors of {dims['low']} and {dims['high']} dimensions")
    limit = max_broadcast_bytes(spark)
    size = queries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vector)).alias("dim")).first()
    width = (size["dim"] or 1) * 8
    schema = _top_schema(queries, corpus, query_id, corpus_id)
    if size["n"] * width <= limit:
        best = _against_broadcast(queries, corpus, query_id, corpus_id, vector, k, schema)
    else:
        best = _against_blocks(
            queries, corpus, query_id, corpus_id, vector, k, schema, size["n"], corpus.count(), max(1, limit // width)
        )
    return _ranked(best, query_id, corpus_id, k, threshold)


def _ranked(best: DataFrame, query_id: str, corpus_id: str, k: int, threshold: float) -> DataFrame:
    """The best k of the blocks' best, as ``vector_topk`` returns them."""
    w = Window.partitionBy(query_id).orderBy(F.round("_sim", 10).desc(), corpus_id)
    ranked = best.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= k)
    similarity = F.greatest(F.lit(0.0), F.col("_sim"))
    return ranked.filter(similarity >= threshold).select(
        query_id, corpus_id, "rank", F.round(similarity, 4).alias("similarity")
    )


#: Vectors that cells are fitted on at most, and cells at most.
CELL_SAMPLE, MAX_CELLS = 100_000, 4096
#: Queries that recall is measured with, about, and the recall that probes are chosen for.
CALIBRATION, RECALL = 500, 0.95


@dataclass(frozen=True)
class Cells:
    """Directions of groups of vectors, and how many of the nearest groups a query asks."""

    centres: np.ndarray
    probes: int


def _cell_order(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Cells of every vector, the nearest first."""
    if len(centres) == 1:
        return np.zeros((len(vectors), 1), dtype=np.int32)
    return np.argsort(-(vectors @ centres.T), axis=1, kind="stable").astype(np.int32)


def fit_cells(
    queries: DataFrame, corpus: DataFrame, query_id: str, corpus_id: str, vector: str = "embedding", k: int = cfg.TOP_K, cells: int | None = None,
    recall: float = RECALL, calibration: int = CALIBRATION, seed: int = cfg.SEED,
) -> Cells:
    """Cells of a corpus (the square root of its size by default, ``MAX_CELLS`` at most) and the probes that reach ``recall``.

    About ``calibration`` queries, chosen by a hash of their id, are answered exactly. Each of their neighbours lies in one cell; the place of that
    cell in the query's order is the number of probes that finds it, and the least number that finds the wanted share is taken. So probes grow with
    the cells, and the recall holds for the table at hand, not for a tested size.
    """
    queries, corpus = _searchable(queries, query_id, vector), _searchable(corpus, corpus_id, vector)
    n_corpus, n_queries = corpus.count(), queries.count()
    n_cells = min(cells or max(1, round(math.sqrt(n_corpus))), MAX_CELLS)
    centres = _centres(corpus, corpus_id, vector, n_cells, n_corpus, seed)
    if len(centres) < 2 or not n_queries:
        return Cells(centres, 1)
    ring = 1 << 30
    share = F.pmod(F.xxhash64(F.lit(seed), F.col(query_id)), F.lit(ring)) < int(ring * min(1.0, calibration / n_queries))
    asked = stage(queries.filter(share).select(query_id, F.col(vector).alias("_asked")), "calibration")
    exact = vector_topk(asked.withColumnRenamed("_asked", vector), corpus.select(corpus_id, vector), query_id, corpus_id, vector, k, threshold=-1.0)
    pairs = stage(exact.select(query_id, corpus_id), "exact-neighbours")  # about calibration x k
    both = pairs.join(asked, query_id).join(corpus.select(corpus_id, F.col(vector).alias("_found")), corpus_id).select("_asked", "_found")
    shared = corpus.sparkSession.sparkContext.broadcast(centres)  # at most MAX_CELLS rows

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                home = _cell_order(_matrix(batch["_found"]), shared.value)[:, :1]
                place = (_cell_order(_matrix(batch["_asked"]), shared.value) == home).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int64))], names=["place"])

    counts = both.mapInArrow(places, "place long").groupBy("place").agg(F.count("*").alias("n")).orderBy("place").collect()  # a line per cell at most
    total, seen = sum(r["n"] for r in counts), 0
    for r in counts:
        seen += r["n"]
        if seen >= recall * total:
            return Cells(centres, r["place"] + 1)
    return Cells(centres, 1)


def _centres(corpus: DataFrame, corpus_id: str, vector: str, cells: int, n_corpus: int, seed: int) -> np.ndarray:
    """Directions of ``cells`` groups of vectors, fitted on about ``CELL_SAMPLE`` of them at most, chosen by a hash of the id."""
    ring = 1 << 30
    share = F.pmod(F.xxhash64(F.lit(seed), corpus_id), F.lit(ring)) < int(ring * min(1.0, CELL_SAMPLE / max(n_corpus, 1)))
    points = corpus.filter(share).select(F.transform(vector, lambda x: x.cast("double")).alias("v"))
    points = points.filter(F.exists("v", lambda x: x != 0)).select(array_to_vector("v").alias("features"))
    if cells < 2 or points.isEmpty():
        return np.zeros((1, 1))  # one cell holds all
    model = KMeans(k=cells, distanceMeasure="cosine", maxIter=10, seed=seed).fit(points)
    centres = np.array(model.clusterCenters())
    return centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)


def _placed_in_cells(rows: DataFrame, key: str, vector: str, centres: np.ndarray, probes: int) -> DataFrame:
    """Every vector once for each of its ``probes`` nearest cells."""
    shared = rows.sparkSession.sparkContext.broadcast(centres)  # at most MAX_CELLS rows
    probes = min(probes, len(centres))
    slim = rows.select(key, vector)
    names = [*slim.columns, "_cell"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near = _cell_order(_matrix(batch[vector]), shared.value)[:, :probes]
            again = batch.take(pa.array(np.repeat(np.arange(batch.num_rows), near.shape[1])))
            yield pa.RecordBatch.from_arrays([*again.columns, pa.array(near.ravel().astype(np.int32))], names=names)

    return slim.mapInArrow(place, T.StructType([*slim.schema.fields, T.StructField("_cell", T.IntegerType())]))


def vector_topk_pruned(
    queries: DataFrame,
    corpus: DataFrame,
    query_id: str,
    corpus_id: str,
    vector: str = "embedding",
    k: int = cfg.TOP_K,
    threshold: float = cfg.SIMILARITY_THRESHOLD,
    cells: int | None = None,
    probes: int | None = None,
    seed: int = cfg.SEED,
    fitted: Cells | None = None,
) -> DataFrame:
    """Like ``vector_topk`` for many queries over a large corpus, but each query sees its ``probes`` nearest cells only.

    Cells are K-means groups by angle. Without ``probes`` their number is that of ``fitted`` or of ``fit_cells``, which measures it for these
    queries; fit once for many searches. Every corpus vector is in one
    cell. A cell that holds many vectors or is asked by many queries is cut into blocks of ``airsight.maxBroadcastBytes``, and each pair of
    blocks of a cell is one matrix product. Similarities are exact; a neighbour in a cell that was not probed is missed. With
    ``probes`` as large as ``cells`` nothing is missed. Absent ids and vectors are left out as in ``vector_topk``.
    """
    queries, corpus = _searchable(queries, query_id, vector), _searchable(corpus, corpus_id, vector)
    size = corpus.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vector)).alias("dim")).first()
    if fitted is None and probes is None:
        fitted = fit_cells(queries, corpus, query_id, corpus_id, vector, k, cells, seed=seed)
    elif fitted is None:
        n_cells = min(cells or max(1, round(math.sqrt(size["n"]))), MAX_CELLS)
        fitted = Cells(_centres(corpus, corpus_id, vector, n_cells, size["n"], seed), probes)
    centres, probes = fitted.centres, probes or fitted.probes
    asked = stage(_placed_in_cells(queries, query_id, vector, centres, probes), "asked-cells")
    held = stage(_placed_in_cells(corpus, corpus_id, vector, centres, 1), "held-cells")
    per_block = max(1, max_broadcast_bytes(corpus.sparkSession) // ((size["dim"] or 1) * 8))
    blocks = lambda rows, name: rows.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / per_block).cast("int").alias(name))
    both = F.broadcast(stage(blocks(asked, "_qs").join(blocks(held, "_cs"), "_cell"), "cell-blocks"))  # at most MAX_CELLS rows
    own = lambda key, n: F.pmod(F.xxhash64(key), F.col(n).cast("long")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = asked.join(both, "_cell").select(query_id, F.col(vector).alias("_query"), "_cell", own(query_id, "_qs").alias("_q"), every("_cs").alias("_c"))
    right = held.join(both, "_cell").select(corpus_id, F.col(vector).alias("_row"), "_cell", own(corpus_id, "_cs").alias("_c"), every("_qs").alias("_q"))
    schema = _top_schema(queries, corpus, query_id, corpus_id)
    by = ["_cell", "_q", "_c"]
    best = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(_search_block(query_id, corpus_id, k, schema), schema)
    return _ranked(best, query_id, corpus_id, k, threshold)


# --- citations ----------------------------------------------------------------


def retrieval_confidence(queries: DataFrame, chunks: DataFrame, query: str) -> DataFrame:
    """High, Medium or Low from the mean similarity; a query without chunks is Low."""
    means = chunks.groupBy(query).agg(F.avg("similarity").alias("_avg"))
    label = (
        F.when(F.col("_avg") >= cfg.CONFIDENCE_HIGH, "High")
        .when(F.col("_avg") >= cfg.CONFIDENCE_MEDIUM, "Medium")
        .otherwise("Low")
    )
    return queries.select(query).distinct().join(means, query, "left").select(
        query, F.round("_avg", 6).alias("avg_similarity"), label.alias("confidence")
    )


def citation_sources(chunks: DataFrame, query: str, rank: str = "rank") -> DataFrame:
    """Best chunk per source with a short excerpt; the earlier chunk wins ties. An absent source is ``unknown``, an absent category ``General``."""
    chunks = chunks.withColumns({
        "source": F.coalesce("source", F.lit(UNKNOWN_SOURCE)), "category": F.coalesce("category", F.lit(DEFAULT_CATEGORY)),
    })
    w = Window.partitionBy(query, "source").orderBy(F.desc("similarity"), rank)
    best = chunks.withColumn("_at", F.row_number().over(w)).filter("_at = 1").drop("_at")
    excerpt = strip(F.left("text", F.lit(cfg.EXCERPT_CHARS)))
    more = F.when(F.length("text") > cfg.EXCERPT_CHARS, " …").otherwise("")
    place = Window.partitionBy(query).orderBy(F.desc("similarity"), rank)
    return best.select(
        query, F.row_number().over(place).cast("bigint").alias("position"), F.col("source").alias("filename"),
        "category", F.round("similarity", 3).alias("similarity"), F.concat(excerpt, more).alias("excerpt"),
    )


def cited_names(answer: Column) -> Column:
    """Distinct bracketed file names in an answer, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(answer, F.lit(_CITATION), F.lit(1))))


def uncited_sources(answers: DataFrame, chunks: DataFrame, query: str, answer: str = "answer") -> DataFrame:
    """Names an answer cites although they were not retrieved for it."""
    cited = answers.select(query, F.explode(cited_names(F.col(answer))).alias("cited"))
    known = chunks.select(query, F.col("source").alias("cited")).distinct()
    return cited.join(known, [query, "cited"], "left_anti")


def citation_result(answers: DataFrame, chunks: DataFrame, query: str, model: str = "", answer: str = "answer") -> DataFrame:
    """Per answer: source list, confidence, cited names and those not retrieved."""
    sources = citation_sources(chunks, query).groupBy(query).agg(
        # at most k sources per query
        F.array_sort(F.collect_list(F.struct("position", "filename", "category", "similarity", "excerpt"))).alias("sources")
    )
    confidence = retrieval_confidence(answers, chunks, query)
    joined = answers.join(sources, query, "left").join(confidence, query)
    names = F.transform(F.coalesce("sources", F.array()), lambda s: s["filename"])
    cited = cited_names(F.col(answer))
    return joined.select(
        query, answer, "sources", "confidence", cited.alias("cited"),
        F.array_sort(F.array_except(cited, names)).alias("not_retrieved"), F.lit(model).alias("model"),
    )


# --- context and prompts ------------------------------------------------------


def dedup_chunks(chunks: DataFrame, query: str, rank: str = "rank") -> DataFrame:
    """Drop chunks whose opening text repeats a more similar one; empty texts are dropped."""
    marked = chunks.filter(has_content(F.col("text"))).withColumn("_flat", collapse(F.col("text")))
    return _first_per_opening(marked, query, rank).drop("_flat")


def _first_per_opening(flat: DataFrame, query: str, rank: str) -> DataFrame:
    w = Window.partitionBy(query, "_mark").orderBy(F.desc("similarity"), rank)
    marked = flat.withColumn("_mark", F.left("_flat", F.lit(cfg.FINGERPRINT_CHARS)))
    return marked.withColumn("_at", F.row_number().over(w)).filter("_at = 1").drop("_at", "_mark")


def condensed(texts: DataFrame, text: str = "text", max_chars: int = cfg.MAX_CONTEXT_CHARS) -> DataFrame:
    """``texts`` with what a context of ``max_chars`` needs in place of the text: its beginning on one line (``opening``) and the
    length of the whole line (``flat_chars``). Rows without content go.

    Texts are long and found by many queries, so do this once per document, before hits are joined with it.
    """
    rest = [c for c in texts.columns if c != text]
    flat = texts.filter(has_content(F.col(text))).select(*rest, collapse(F.col(text)).alias("_flat"))
    return flat.select(
        *rest, F.left("_flat", F.lit(max(max_chars, cfg.FINGERPRINT_CHARS))).alias("opening"), F.length("_flat").alias("flat_chars")
    )


def _flat_unique(chunks: DataFrame, query: str, max_chars: int, rank: str) -> DataFrame:
    """De-duplicated chunks with the beginning of their text on one line; ``chunks`` carry a text or are condensed already."""
    if "text" in chunks.columns:
        chunks = condensed(chunks.select(query, rank, "similarity", "source", "text"), max_chars=max_chars)
    flat = chunks.select(
        query, rank, "similarity", F.coalesce("source", F.lit(UNKNOWN_SOURCE)).alias("source"), F.col("opening").alias("_flat"), "flat_chars"
    )
    return _first_per_opening(flat, query, rank)


def context_entries(
    chunks: DataFrame, query: str, max_chars: int = cfg.MAX_CONTEXT_CHARS, rank: str = "rank"
) -> DataFrame:
    """De-duplicated, numbered context entries that fit the budget; the one crossing it is cut and
    marked with an ellipsis."""
    placed = _placed(_flat_unique(chunks, query, max_chars, rank), query, max_chars, rank)
    return placed.filter("entry IS NOT NULL").select(query, "entry_no", "source", "entry")


def _placed(unique: DataFrame, query: str, max_chars: int, rank: str) -> DataFrame:
    """Every chunk with its number and its entry. There is an entry while the entries before it, uncut, stay below the budget."""
    order = Window.partitionBy(query).orderBy(F.desc("similarity"), rank)
    numbered = unique.withColumn("entry_no", F.row_number().over(order).cast("bigint"))
    head = F.concat(F.lit("["), F.col("entry_no").cast("string"), F.lit("] "), "source", F.lit(":\n"))
    shaped = numbered.withColumn("_head", head)
    full = F.length("_head") + F.col("flat_chars")
    before = F.sum(full).over(Window.partitionBy(query).orderBy("entry_no").rowsBetween(Window.unboundedPreceding, -1))
    placed = shaped.withColumn("_left", F.lit(max_chars) - F.coalesce(before, F.lit(0)))
    body = F.when(
        F.col("flat_chars") > F.col("_left"), F.concat(F.left("_flat", F.col("_left").cast("int")), F.lit("…"))
    ).otherwise(F.col("_flat"))  # an opening is as long as the budget, so what fits is whole
    return placed.select(query, "entry_no", "source", F.when(F.col("_left") > 0, F.concat("_head", body)).alias("entry"))


def context_blocks(
    chunks: DataFrame, query: str, max_chars: int = cfg.MAX_CONTEXT_CHARS, rank: str = "rank"
) -> DataFrame:
    """Packed context per query with its length and the number of distinct chunks, in one pass over ``chunks``."""
    placed = _placed(_flat_unique(chunks, query, max_chars, rank), query, max_chars, rank)
    fitting = F.when(F.col("entry").isNotNull(), F.struct("entry_no", "entry"))
    listed = F.transform(F.array_sort(F.collect_list(fitting)), lambda e: e["entry"])
    # bounded by the budget: every entry that is kept has a heading and starts below it
    return placed.groupBy(query).agg(
        F.count(F.lit(1)).alias("chunks_used"), F.array_join(listed, "\n\n").alias("context"), F.sum(F.length("entry")).alias("context_chars")
    )


def labelled_fields(fields: dict[str, str], available: Sequence[str], joiner: str, separator: str) -> Column:
    """``label<joiner>value`` of the present fields; NULL values are skipped."""
    parts = [
        F.concat(F.lit(label + joiner), F.col(name).cast("string")) for name, label in fields.items() if name in available
    ]
    return F.concat_ws(separator, *parts)


def enrich_query(questions: DataFrame, question: str = "question", out: str = "enriched") -> DataFrame:
    """Question preceded by the prediction values known for it."""
    known = labelled_fields(text.ENRICHMENT_FIELDS, questions.columns, ": ", "; ")
    return questions.withColumn(
        out,
        F.when(known != "", F.concat(F.lit("Prediction context — "), known, F.lit("\n\n"), question)).otherwise(F.col(question)),
    )


def prompt_table(
    questions: DataFrame,
    chunks: DataFrame,
    query: str,
    question: str = "question",
    max_chars: int = cfg.MAX_CONTEXT_CHARS,
    with_prediction: bool = True,
    rank: str = "rank",
) -> DataFrame:
    """One prompt per question: system text, user text and size figures."""
    known = labelled_fields(text.PREDICTION_LINE, questions.columns if with_prediction else [], "=", ", ")
    line = F.when(known != "", F.concat(F.lit("Prediction: "), known))
    joined = questions.join(context_blocks(chunks, query, max_chars, rank), query, "left")
    user = F.concat_ws(
        "\n\n",
        line,
        F.concat(
            F.lit("RETRIEVED CONTEXT:\n"),
            F.when(F.col("chunks_used").isNull(), text.NO_DOCUMENTS).otherwise(F.coalesce("context", F.lit(""))),
        ),
        F.concat(F.lit("QUESTION: "), strip(F.col(question)), F.lit(text.QUESTION_TASK)),
    )
    system = F.lit(text.SYSTEM_PROMPT)
    return joined.select(
        query, system.alias("system"), user.alias("user"),
        F.coalesce("context_chars", F.lit(0)).cast("bigint").alias("context_chars"),
        F.coalesce("chunks_used", F.lit(0)).cast("bigint").alias("chunks_used"),
    ).withColumns({
        "total_chars": (F.length("system") + F.length("user")).cast("bigint"),
        "est_tokens": token_estimate(F.concat("system", "user")),
        "system_tokens": token_estimate(F.col("system")),
        "user_tokens": token_estimate(F.col("user")),
    })


def reduced_prompt_table(questions: DataFrame, chunks: DataFrame, query: str, question: str = "question", rank: str = "rank") -> DataFrame:
    """Smaller variant: the two best chunks, a tighter budget, no prediction line."""
    first = Window.partitionBy(query).orderBy(F.desc("similarity"), rank)
    few = chunks.withColumn("_at", F.row_number().over(first)).filter(F.col("_at") <= cfg.REDUCED_TOP_K).drop("_at")
    return prompt_table(questions, few, query, question, cfg.REDUCED_CONTEXT_CHARS, with_prediction=False, rank=rank)
