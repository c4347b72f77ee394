"""Writers for comparison tables, logs, metadata, manifests and the vector index."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from airsight.operators.comparison import upsert, winner_row
from airsight.operators.corpus import chunk_documents, manifest_diff
from airsight.session import lookup, stage
from airsight.sources import versions
from airsight.sources.tables import read_or_none


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_comparison(df: DataFrame, path: str, regression: bool = False) -> None:
    """Comparison table; the regression layout has no type column."""
    write_csv(df.drop("type") if regression else df, path)


def write_best_metrics(df: DataFrame, best: str, path: str, name: str = "model_name") -> None:
    """Only the winner's row, or the first row when the winner is not listed."""
    write_csv(winner_row(df, best, name), path)


def write_classification_report(report: DataFrame, model_name: str, path: str) -> None:
    write_csv(report.select("label", F.lit(model_name).alias("model"), "precision", "recall", F.col("f1").alias("f1-score"), "support"), path)


def write_metadata(spark: SparkSession, values: dict[str, object], path: str) -> None:
    """One-row JSON document of training facts."""
    columns = [
        (F.array(*[F.lit(x) for x in v]) if isinstance(v, (list, tuple)) else F.lit(v)).alias(k) for k, v in values.items()
    ]
    spark.range(1).select(*columns).write.mode("overwrite").json(path)


def update_log(spark: SparkSession, new: DataFrame, old_path: str | None, new_path: str, key: str = "model_name") -> DataFrame:
    """Replace or append records and write the result as a new version; the old version stays readable."""
    old = read_or_none(spark, old_path, "json") if old_path else None
    merged = new if old is None else upsert(old, new, key)
    merged.write.mode("errorifexists").json(new_path)
    return spark.read.json(new_path)


INDEX_COLUMNS = ["chunk_id", "text", "source", "category", "chunk_index", "embedding"]


def _indexed(chunks: DataFrame) -> DataFrame:
    """Embedded chunks, sorted by source inside files so that a source filter skips row groups."""
    kept = [c for c in chunks.columns if c not in INDEX_COLUMNS]
    return chunks.select(*kept, *INDEX_COLUMNS).sortWithinPartitions("source")


def write_index(chunks: DataFrame, path: str, key: str = "source") -> int:
    """A new version of the index with just these chunks; ``chunks`` may come from the index itself. Returns the version's number."""
    return versions.commit(chunks.sparkSession, path, key, _indexed(chunks))


def read_index(spark: SparkSession, path: str, key: str = "source") -> DataFrame | None:
    """Chunks of the newest complete version, or None without one."""
    return versions.read(spark, path, key)


def refresh_index(spark: SparkSession, path: str, docs: DataFrame, key: str, encode: Callable[[DataFrame], DataFrame]) -> dict[str, int]:
    """Bring the index at ``path`` up to ``docs`` (key, hash, text, filename, category); returns the number of documents by status.

    Only added and changed documents are chunked and embedded, into a new part; unchanged ones are named by the new version where they
    are. Without a change no version is written. A refresh that is killed leaves the version before it readable.
    """
    listed = versions.current(spark, path)
    if listed is None:
        listed = spark.createDataFrame([], StructType([
            docs.schema[key], *(StructField(c, t) for c, t in ((versions.DIGEST, StringType()), (versions.PART, StringType()), (versions.PART_KEYS, LongType())))
        ]))
    old = listed.select(key, F.coalesce(versions.DIGEST, F.lit("")).alias("hash"))
    diff = stage(manifest_diff(old, docs.select(key, "hash"), key), "index-diff")
    counts = {r["status"]: r["n"] for r in diff.groupBy("status").agg(F.count("*").alias("n")).collect()}
    if set(counts) <= {"same"} and versions.current(spark, path) is not None:
        return counts
    work = lookup(diff.filter(F.col("status").isin("added", "changed")).select(key), "index-work")
    new = docs.join(work, key, "left_semi")
    kept = listed.join(lookup(diff.filter("status = 'same'").select(key), "index-kept"), key, "left_semi")
    rows = _indexed(encode(chunk_documents(new.drop("hash"), key=key)))
    versions.commit(spark, path, key, rows, new.select(key, F.col("hash").alias(versions.DIGEST)), kept)
    return counts


def write_manifest(docs: DataFrame, path: str) -> int:
    """A new version of the manifest: relative path and hash per document. Paths are unique where file names may repeat."""
    return versions.commit(docs.sparkSession, path, "path", docs.select("path", "hash"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    found = versions.read(spark, path, "path")
    return spark.createDataFrame([], "path string, hash string") if found is None else found
