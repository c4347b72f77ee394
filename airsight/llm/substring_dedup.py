"""Substring deduplication on the shortest spans of consecutive sentences that are a passage."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airsight.llm.common import fresh
from airsight.llm.shingles import mix, slices
from airsight.session import lookup, stage

#: A span is a run of consecutive sentences with so many sentences and words at least.
LEAST_SENTENCES, LEAST_WORDS = 2, 15

#: Where a sentence ends: behind marks with one of ``.!?`` among them before white space, or behind a line feed.
END = re.compile(r"(?<![^\w\s])(?=[^\w\s]*[.!?])[^\w\s]++(?:[^\S\n]*+\n|[^\S\n]++|\Z)|\n")


def sentences(text: str | None) -> list[str]:
    """Pieces that concatenate to ``text``; white space behind a sentence belongs to it."""
    text, out, at = text or "", [], 0
    for m in END.finditer(text):
        out.append(text[at : m.end()])
        at = m.end()
    return out + [text[at:]] if at < len(text) else out


def shortest_runs(words: np.ndarray, sentences: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First sentence and length of the shortest run of ``sentences`` or more with ``least`` words from every sentence on, and of the shortest
    up to every sentence, each once. ``words`` has the running totals, 0 first.

    Every sentence of a longer run lies in one of these within it: in the shortest up to the sentence or, where that begins before the run, in
    the shortest from the beginning of the run on. So two a sentence stand for runs of all lengths.
    """
    n = len(words) - 1
    at = np.arange(n)
    stop = np.maximum(at + sentences, np.searchsorted(words, words[:-1] + least))
    start = np.minimum(at + 1 - sentences, np.searchsorted(words, words[1:] - least, side="right") - 1)
    ahead, back = stop <= n, start >= 0
    found = np.unique(np.concatenate([np.stack([at, stop - at], 1)[ahead], np.stack([start, at + 1 - start], 1)[back]]), axis=0)
    return found[:, 0], found[:, 1]


def span_hashes(pieces: list[str], least_sentences: int, least_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """128-bit hash (two columns), first sentence and length of the shortest runs of consecutive sentences with enough words; blank sentences are
    skipped over."""
    bare = [s.split() for s in pieces if not s.isspace()]
    hashes = np.frombuffer(b"".join(xxhash.xxh3_128_digest(" ".join(w)) for w in bare), dtype=np.uint64).reshape(-1, 2)
    at, length = shortest_runs(np.cumsum([0] + [len(w) for w in bare]), least_sentences, least_words)
    total = np.repeat(length.astype(np.uint64)[:, None], 2, axis=1)
    # no run has more sentences than it needs, or than it needs words, as a sentence has a word at least
    for k in range(int(length.max(initial=0))):
        more = np.flatnonzero(length > k)
        total[more] = mix(total[more] * _FACTORS + hashes[at[more] + k] + np.uint64(k))
    return total, at, length


_FACTORS = np.array([31, 0x9E3779B97F4A7C15], dtype=np.uint64)


def _spans(least_sentences: int, least_words: int):
    """(doc, text) to (span_a, span_b, doc, at, sentences): at most two rows a sentence, ``at`` counts the sentences that are not blank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                found = [span_hashes(sentences(t), least_sentences, least_words) for t in piece.column("text").to_pylist()]
                hashes, at, length = (np.concatenate(c) for c in zip(*found))
                doc = piece.column("doc").take(pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found])))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(np.ascontiguousarray(hashes[:, i]).view(np.int64)) for i in (0, 1)), doc, pa.array(at.astype(np.int32)), pa.array(length.astype(np.int32))],
                    names=["span_a", "span_b", "doc", "at", "sentences"],
                )

    return run


def _cut(text: str, covered: str, removed: str):
    """Cut the sentences with the numbers ``covered`` from ``text``; ``removed`` gets their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            for t, gone in zip(batch.column(text).to_pylist(), batch.column(covered).to_pylist()):
                if not gone:
                    texts.append(t)
                    counts.append(0)
                    continue
                gone, kept, n = set(gone), [], -1
                for s in sentences(t):
                    n += not s.isspace()
                    if n not in gone:
                        kept.append(s)
                texts.append("".join(kept))
                counts.append(sum(g <= n for g in gone))
            names = [c for c in batch.schema.names if c != covered]
            columns = [pa.array(texts, pa.string()) if c == text else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], names=[*names, removed])

    return run


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", least_sentences: int = LEAST_SENTENCES, least_words: int = LEAST_WORDS
) -> DataFrame:
    """(doc, at, sentences): every span that is not the first with its hash. First is the least document id, then the least place.

    Firsts are aggregated inside the tasks before the shuffle. Only hashes of repeated spans remain to be joined, and spans meet
    them on the hash; a passage that a third of the documents share is a skewed join key, which adaptive execution splits.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text).alias("text"))
    runs = stage(texts.mapInArrow(_spans(least_sentences, least_words), "span_a long, span_b long, doc long, at int, sentences int"), "spans")
    firsts = runs.groupBy("span_a", "span_b").agg(F.count("*").alias("n"), F.min(F.struct("doc", "at")).alias("first"))
    firsts = lookup(firsts.filter("n > 1").drop("n"), "repeated-spans")
    met = runs.join(firsts, ["span_a", "span_b"])
    return met.filter(~F.struct("doc", "at").eqNullSafe(F.col("first"))).select("doc", "at", "sentences")


def drop_repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", least_sentences: int = LEAST_SENTENCES, least_words: int = LEAST_WORDS
) -> DataFrame:
    """``docs`` with all sentences cut that a repeated span covers, unless the span is its first, and their number in ``n_removed``.

    A span is every run of ``least_sentences`` or more consecutive sentences that have ``least_words`` or more words together. Sentences end at a line feed or behind marks with one of
    ``.!?`` before white space; they are compared by their words, so white space between words does not matter. Spans are compared by
    128-bit hashes. What is not cut stays as it is, with its separators. No document goes; one that only repeats others is left with an
    empty text.

    A text of any length gives two spans a sentence at most, and is cut in one piece. Null texts stay null; texts of fewer sentences are not touched. Rows that repeat an id count as one document at the
    same places: the first of equal spans there stays in each. A null id comes first. No rows give no rows. Extra columns
    pass through; ``n_removed`` gets underscores in front where the input has the name.
    """
    mine, covered, removed = fresh("span_doc", docs.columns), fresh("covered", docs.columns), fresh("n_removed", docs.columns)
    again = repeated_spans(docs, id_col, text, least_sentences, least_words)
    each = again.select(F.col("doc").alias(mine), F.explode(F.sequence("at", F.col("at") + F.col("sentences") - 1)).alias("at")).distinct()
    per_doc = each.groupBy(mine).agg(F.collect_list("at").alias(covered))  # at most the sentences of a document
    per_doc = lookup(per_doc, "covered")
    joined = docs.join(per_doc, F.col(id_col).eqNullSafe(F.col(mine)), "left").drop(mine)
    schema = docs.withColumn(removed, F.lit(0).cast("long")).schema
    return joined.mapInArrow(_cut(text, covered, removed), schema)
