"""Document folders as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airsight.operators.corpus import decode_text, document_record, supported


def scan_documents(spark: SparkSession, base: str, with_content: bool = False) -> DataFrame:
    """One row per supported file below ``base``: path relative to it, file name, category, hash and size.

    Spark's file source leaves out files of zero bytes; they have no text to index either.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base)
    inside = F.regexp_replace("path", r"^[a-z0-9]+:/+", "/")
    root = F.lit("/" + base.split(":", 1)[-1].strip("/") + "/")
    relative = F.url_decode(F.regexp_replace(inside, r"\+", "%2B"))
    placed = files.select(F.replace(relative, root, F.lit("")).alias("path"), "content").filter(supported(F.col("path")))
    record = document_record(F.col("path"), F.col("content"))
    return placed.select("path", *[c.alias(n) for n, c in record.items()], *(["content"] if with_content else []))


def read_text_documents(spark: SparkSession, base: str) -> DataFrame:
    """Plain-text files with their decoded text; blank files are kept."""
    docs = scan_documents(spark, base, with_content=True).filter(F.lower("path").endswith(".txt"))
    return docs.select("path", "filename", "category", "hash", "size", decode_text(F.col("content")).alias("text"))
