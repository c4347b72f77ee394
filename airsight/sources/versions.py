"""Tables that are replaced as a whole: immutable parts, and versions that name the parts they are made of.

Below the path of a table stand ``parts/<name>`` with data and ``versions/<number>`` with the list of keys, each with the part that holds its rows. A
version counts once its folder is complete, which is the last thing a writer does; readers take the newest complete one. So a
reader never sees half a table, a table may be rewritten from its own rows, and rows that did not change stay where they are.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airsight.session import sized

#: Columns of the list besides the key: digest of what the key stood for (or null), its part, and the number of keys the part was written with.
DIGEST, PART, PART_KEYS = "_digest", "_part", "_part_keys"


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str, complete: bool) -> list[int]:
    """Numbers of the versions, in order; unfinished ones too if ``complete`` is False."""
    at, files = _folder(spark, f"{path}/versions")
    if not files.exists(at):
        return []
    names = [s.getPath().getName() for s in files.listStatus(at)]
    done = lambda name: files.exists(_folder(spark, f"{path}/versions/{name}/_SUCCESS")[0])
    return sorted(int(n) for n in names if n.isdigit() and (not complete or done(n)))


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The list of the newest complete version: the key, its digest and its part. None if there is no version."""
    done = _numbers(spark, path, complete=True)
    return spark.read.parquet(f"{path}/versions/{done[-1]:012d}") if done else None


def read(spark: SparkSession, path: str, key: str) -> DataFrame | None:
    """Rows of the newest complete version, or None. Parts whose keys all count still are read as they are, others are joined with the list."""
    listed = current(spark, path)
    if listed is None:
        return None
    parts = listed.groupBy(PART).agg((F.count("*") == F.max(PART_KEYS)).alias("whole")).collect()  # a line per part
    if not parts:
        return spark.read.parquet(f"{path}/parts/*").limit(0)
    of = lambda whole: [f"{path}/parts/{r[PART]}" for r in parts if r["whole"] == whole]
    tables = [spark.read.parquet(*of(True))] if of(True) else []
    if of(False):
        rows = spark.read.parquet(*of(False)).withColumn("_in", F.regexp_extract("_metadata.file_path", "/parts/([^/]+)/", 1))
        keep = sized(listed.select(F.col(key).alias("_key"), F.col(PART).alias("_of")))
        tables.append(rows.join(keep, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_in") == F.col("_of")), "left_semi").drop("_in"))
    return tables[0] if len(tables) == 1 else tables[0].unionByName(tables[1])


def commit(spark: SparkSession, path: str, key: str, rows: DataFrame, digests: DataFrame | None = None, kept: DataFrame | None = None) -> int:
    """Write ``rows`` as a new part and make a version of them and of the entries ``kept`` from the current list; returns its number.

    ``digests`` has the key and its digest for every key of the part, also for those without rows; without it the keys are those of the rows.
    Whatever stops the writer before the version's folder is complete leaves the version before it as it was.
    """
    part = uuid.uuid4().hex
    rows.write.mode("errorifexists").parquet(f"{path}/parts/{part}")
    if digests is None:
        digests = spark.read.parquet(f"{path}/parts/{part}").select(key).distinct().withColumn(DIGEST, F.lit(None).cast("string"))
    new = digests.select(key, DIGEST)
    entries = new.withColumns({PART: F.lit(part), PART_KEYS: F.lit(new.count())})
    if kept is not None:
        entries = kept.select(*entries.columns).unionByName(entries)
    number = max(_numbers(spark, path, complete=False), default=0) + 1
    entries.write.mode("errorifexists").parquet(f"{path}/versions/{number:012d}")
    return number


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete all but the newest ``keep`` complete versions, unfinished ones before them, and parts that none of those left names."""
    done = _numbers(spark, path, complete=True)[-max(keep, 1):]
    if not done:
        return 0
    used = {r[0] for n in done for r in spark.read.parquet(f"{path}/versions/{n:012d}").select(PART).distinct().collect()}
    at, files = _folder(spark, f"{path}/parts")
    gone = [s.getPath() for s in files.listStatus(at) if s.getPath().getName() not in used]
    gone += [_folder(spark, f"{path}/versions/{n:012d}")[0] for n in _numbers(spark, path, complete=False) if n < done[0]]
    return sum(bool(files.delete(p, True)) for p in gone)
