"""Documents: scanning, hashing, chunking, change detection, embedding and index refresh."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airsight import config as cfg
from airsight.functions.text import has_content, strip
from airsight.session import lookup, stage


def document_record(path: Column, content: Column) -> dict[str, Column]:
    """File name, category (first folder below the base, else General), SHA-256 and size of a document."""
    parts = F.split(path, "/")
    return {
        "filename": F.element_at(parts, -1),
        "category": F.when(F.size(parts) > 1, F.element_at(parts, 1)).otherwise("General"),
        "hash": F.sha2(content, 256),
        "size": F.octet_length(content),
    }


def supported(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1)).isin(cfg.DOCUMENT_SUFFIXES)


def decode_text(content: Column) -> Column:
    """UTF-8 when valid, else Latin-1."""
    utf8 = F.is_valid_utf8(content.cast("string"))
    return F.when(utf8, F.decode(content, "UTF-8")).otherwise(F.decode(content, "ISO-8859-1"))


def _step(size: int, overlap: int) -> int:
    if size <= 0:
        raise ValueError("chunk size must be positive")
    return size if overlap >= size else size - overlap


def _join_pieces(pieces: Column, size: int, step: int) -> Column:
    """Chunks from consecutive step-sized pieces: each joins the pieces it reaches, cut to its size."""
    reach = -(-size // step)
    chunk = lambda i: strip(F.left(F.array_join(F.slice(pieces, i + 1, reach), ""), F.lit(size)))
    return F.filter(F.transform(pieces, lambda _, i: chunk(i)), lambda c: c != "")


def chunk_documents(
    docs: DataFrame,
    text: str = "text",
    filename: str = "filename",
    category: str = "category",
    key: str | None = None,
    size: int = cfg.CHUNK_SIZE,
    overlap: int = cfg.CHUNK_OVERLAP,
) -> DataFrame:
    """Overlapping stripped chunks, one row each, empty ones left out; the tail chunk is kept even
    if its predecessor covers it. Row-local: no shuffle, and a hot category stays spread as it was read.

    The text is cut once into step-sized pieces and neighbouring pieces are joined, so the work
    grows linearly with the length of the text. ``key`` names the document in chunk ids (use the relative path when file names can repeat).
    """
    name = F.col(key or filename)
    step = _step(size, overlap)
    cut = docs.filter(has_content(F.col(text))).withColumn(
        "_cut", F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    )
    pieces = cut.withColumn("_pieces", _join_pieces(F.col("_cut"), size, step))
    kept = [c for c in docs.columns if c not in (text, filename, category)]
    return pieces.select(
        *kept, F.col(filename).alias("source"), F.col(category).alias("category"), name.alias("_name"),
        # every remaining text has a chunk; the outer form spares the optimizer's extra "is it empty" evaluation
        F.posexplode_outer("_pieces").alias("chunk_index", "text"),
    ).select(
        *kept, "source", "category", F.col("chunk_index").cast("bigint"), "text",
        F.concat("_name", F.lit("_chunk_"), F.col("chunk_index").cast("string")).alias("chunk_id"),
    )


def manifest_diff(old: DataFrame, new: DataFrame, key: str = "path", digest: str = "hash") -> DataFrame:
    """Status per document: added, removed, changed or same. Keys are unique on both sides."""
    a = old.select(F.col(key), F.col(digest).alias("old_hash"))
    b = new.select(F.col(key), F.col(digest).alias("new_hash"))
    status = (
        F.when(F.col("old_hash").isNull(), "added")
        .when(F.col("new_hash").isNull(), "removed")
        .when(F.col("old_hash") != F.col("new_hash"), "changed")
        .otherwise("same")
    )
    return a.join(b, key, "full_outer").select(key, "old_hash", "new_hash", status.alias("status"))


def needs_rebuild(diff: DataFrame, index: DataFrame | None) -> bool:
    """True without an index, with an empty one, or after any change."""
    if index is None or index.isEmpty():
        return True
    return not diff.filter("status <> 'same'").isEmpty()


def refresh_index(
    index: DataFrame, docs: DataFrame, diff: DataFrame, key: str, encode: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """New index content: rows of unchanged documents are kept as they are, only added and changed
    documents are chunked and embedded again. ``docs`` has columns key, text, filename, category."""
    work = diff.filter(F.col("status").isin("added", "changed")).select(key)
    kept = index.join(diff.filter("status = 'same'").select(key), key, "left_semi")
    fresh = encode(chunk_documents(docs.join(work, key, "left_semi"), key=key))
    return kept.unionByName(fresh)


def encode_with(
    chunks: DataFrame, encoder: Callable[[list[str]], np.ndarray], text: str = "text", batch_size: int = 32
) -> DataFrame:
    """Embed texts with any Python encoder, batch by batch inside the tasks, and scale vectors to unit length."""

    @F.pandas_udf("array<float>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = []
            for start in range(0, len(texts), batch_size):
                v = np.asarray(encoder(list(texts.iloc[start : start + batch_size])), dtype="float64")
                length = np.linalg.norm(v, axis=1, keepdims=True)
                out.extend((v / np.where(length > 0, length, 1.0)).astype("float32"))
            yield pd.Series(out)

    return chunks.withColumn("embedding", embed(F.col(text)))


#: Tokens whose places a task remembers, and rows of a batch that it returns.
KNOWN_TOKENS, VECTOR_ROWS = 100_000, 1000


def _token_places(dim: int):
    """(digest, token bytes of the text) to (digest, places, counts): how many tokens of a text each place has, in the order of the places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = lru_cache(KNOWN_TOKENS)(lambda token: int.from_bytes(md5(token, usedforsecurity=False).digest()[:4], "big") % dim)
        for batch in batches:
            for low in range(0, batch.num_rows, VECTOR_ROWS):
                piece, ends, places, counts = batch.slice(low, VECTOR_ROWS), [0], [], []
                for text in piece.column("lowered"):
                    # without an argument, bytes are split at ASCII white space alone
                    n = np.bincount([place(t) for t in text.as_py().split()], minlength=dim) if text.is_valid else np.zeros(dim, dtype=np.int64)
                    at = np.flatnonzero(n)
                    places.append(at)
                    counts.append(n[at])
                    ends.append(ends[-1] + len(at))
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(x), kind)) for x, kind in ((places, pa.int32()), (counts, pa.int64()))]
                yield pa.RecordBatch.from_arrays([piece.column("digest"), *lists], names=["digest", "places", "counts"])

    return run


def hashing_vectors(texts: DataFrame, text: str = "text", dim: int = cfg.EMBEDDING_DIM) -> DataFrame:
    """(digest, place, value): the non-zero components of a unit vector for every distinct text.

    Tokens are runs of characters other than ASCII white space, in small letters; the first 32 bits of a token's MD5 choose its place. A place
    counts its tokens times ln((texts + 1) / (texts with the place + 1)). Texts are named by the SHA-256 of their bytes, so equal ones are embedded
    once. Tokens are counted where the text is read: what is shuffled is a digest with at most ``dim`` counts per text, never a token. Texts without a
    token, and null, have no vector.
    """
    rows = texts.filter(F.col(text).isNotNull()).select(F.sha2(F.col(text), 256).alias("digest"), F.lower(text).cast("binary").alias("lowered"))
    placed = rows.mapInArrow(_token_places(dim), "digest string, places array<int>, counts array<long>")
    counted = stage(placed.groupBy("digest").agg(F.first("places").alias("places"), F.first("counts").alias("counts")), "token-places")
    total = F.lit(float(counted.count()))
    idf = counted.select(F.explode("places").alias("place")).groupBy("place").agg(F.log((total + 1) / (F.count("*") + 1)).alias("idf"))
    known = idf.agg(F.map_from_entries(F.collect_list(F.struct("place", "idf"))).alias("_known"))  # one row, dim entries
    dense = known.select(F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: F.try_element_at("_known", i)).alias("_idf"))
    joined = counted.crossJoin(F.broadcast(dense))
    weighed = joined.select("digest", "places", F.zip_with("places", "counts", lambda p, n: n * F.get("_idf", p)).alias("w"))
    length = F.sqrt(F.aggregate("w", F.lit(0.0), lambda s, w: s + w * w))
    sized = weighed.select("digest", "places", "w", F.nullif(length, F.lit(0.0)).alias("_length"))
    unit = sized.select("digest", "_length", F.inline(F.arrays_zip(F.col("places").alias("place"), F.col("w").alias("w"))))
    return unit.select("digest", "place", (F.col("w") / F.col("_length")).alias("value")).filter(F.col("value") > 0)


def embed_hashing(chunks: DataFrame, text: str = "text", dim: int = cfg.EMBEDDING_DIM) -> DataFrame:
    """``chunks`` with an ``embedding`` of ``dim`` floats from ``hashing_vectors``; a text without a token gets zeros."""
    parts = hashing_vectors(chunks.select(F.col(text)), text, dim).groupBy("digest").agg(F.map_from_entries(F.collect_list(F.struct("place", "value"))).alias("at"))
    joined = chunks.withColumn("_digest", F.sha2(F.col(text), 256)).join(lookup(parts, "embeddings").withColumnRenamed("digest", "_digest"), "_digest", "left")
    value = lambda i: F.coalesce(F.try_element_at("at", i.cast("int")), F.lit(0.0)).cast("float")
    return joined.select(*[F.col(f"`{c}`") for c in chunks.columns], F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), value).alias("embedding"))


def fit_hashing_encoder(chunks: DataFrame, text: str = "text", dim: int = cfg.EMBEDDING_DIM):
    """Built-in encoder: token hashing, inverse document frequency, unit length. Returns a fitted pipeline model."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, HashingTF, Normalizer, Tokenizer

    return Pipeline(stages=[
        Tokenizer(inputCol=text, outputCol="_tokens"),
        HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=dim),
        IDF(inputCol="_tf", outputCol="_tfidf"),
        Normalizer(inputCol="_tfidf", outputCol="_unit"),
    ]).fit(chunks)


def encode_hashing(model, chunks: DataFrame) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    return model.transform(chunks).select(
        *chunks.columns, vector_to_array("_unit", "float32").alias("embedding")
    )
