"""Session-level settings: task size limits and staged (lineage-cutting) tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows one task may hold in a single ordered group before the group is split.
GROUP_ROWS_KEY = "airsight.maxGroupRows"
GROUP_ROWS_DEFAULT = 2_000_000

#: Bytes of query vectors one task may hold as a broadcast matrix.
BROADCAST_BYTES_KEY = "airsight.maxBroadcastBytes"
BROADCAST_BYTES_DEFAULT = 64 * 1024 * 1024


def max_group_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(GROUP_ROWS_KEY, str(GROUP_ROWS_DEFAULT)))


def max_broadcast_bytes(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_BYTES_KEY, str(BROADCAST_BYTES_DEFAULT)))


def staging_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a private one only in local mode without a setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = spark.conf.get("airsight.localStaging", None)
    if not root:
        root = tempfile.mkdtemp(prefix="airsight-")
        spark.conf.set("airsight.localStaging", root)
    return root


_STAGED: list[str] = []


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to shared storage and read it back.

    The written table cuts the lineage: a lost executor re-reads files instead of
    repeating a sampled range shuffle, and later passes read only the columns they need.
    """
    path = staged_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, remembered for ``clear_staged``."""
    path = f"{staging_root(spark).rstrip('/')}/airsight/{label}-{uuid.uuid4().hex}"
    _STAGED.append(path)
    return path


def clear_staged(spark: SparkSession) -> int:
    """Delete what this session has staged. Call it once results are written: DataFrames that read staged tables end with it."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    while _STAGED:
        path = jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        removed += bool(path.getFileSystem(conf).delete(path, True))
    return removed


def table_bytes(df: DataFrame) -> int:
    """Bytes of all values, as one aggregation: 8 for a number, the length of a string, the JSON length of anything nested."""
    width = F.lit(0).cast("long")
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            width += F.coalesce(F.octet_length(c), F.lit(0)) + 8
        elif kind.startswith(("array", "struct", "map")):
            width += F.coalesce(F.octet_length(F.to_json(F.struct(c.alias("c")))), F.lit(0))
        else:
            width += 8
    return int(df.agg(F.sum(width).alias("n")).first()["n"] or 0)


def sized(table: DataFrame) -> DataFrame:
    """Mark a staged table for broadcast if its measured bytes allow it; a larger one is left to the planner's shuffle join."""
    return F.broadcast(table) if table_bytes(table) <= max_broadcast_bytes(table.sparkSession) else table


def lookup(df: DataFrame, label: str) -> DataFrame:
    """A per-key table to join with the rows it came from: staged, measured, and broadcast only if it is small.

    Without the hint the planner would guess its size from the big table and shuffle both by a few hot keys.
    """
    return sized(stage(df, label))
