"""What the operators share: reading tables, the label fold, text keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the third of the ids whose labels are never learned from. A null id is held out, as it joins no label."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(True))


def whole(text: Column) -> Column:
    """The text with null read as empty."""
    return F.coalesce(text, F.lit(""))


def text_key(text: Column) -> Column:
    """128 bits of SHA-256: the identity of a text."""
    return F.unhex(F.substring(F.sha2(whole(text), 256), 1, 32))


def fresh(name: str, taken: list[str]) -> str:
    """A column name that no column of the input has, whatever its case."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name = "_" + name
    return name
