"""A corpus pipeline over ``documents``: toxicity, line dedup, n-gram Jaccard join, benchmark decontamination, mixing.

Every stage takes the documents that its predecessor kept and, but for the last, returns the columns of ``documents``. Each result is
written to the shared folder and read again, so that no stage repeats another's work and a lost executor costs tasks only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from airsight.llm import decontamination, line_dedup, mixing, ngram_join, toxicity
from airsight.llm.common import table
from airsight.session import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labelled ones among them, does not call toxic."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def remove_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source, copies of a text counted once. ``n_chars`` stays that of the document as it came in."""
    return line_dedup.drop_boilerplate(docs.select(*COLUMNS), copies_count=False).select(*COLUMNS)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal or similar texts."""
    return ngram_join.keep_one_each(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", remove_toxic),
    ("line_dedup", remove_boilerplate),
    ("ngram_join", remove_near_copies),
    ("decontamination", remove_benchmark),
    ("mixing", mix_sources),
]

#: Learned scores, MinHash search and seeded selection have no SQL; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``: doc_id, source, size, source_size, target, taken."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
