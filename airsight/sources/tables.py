"""Readers for the measurement tables."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airsight import config as cfg
from airsight.operators.cleaning import (
    col, decode_classes, drop_all_null_columns, drop_incomplete, fill_missing, fit_medians, nan_to_null, parse_timestamps,
    project_complete, require_columns, sentinel_to_null,
)


def read_or_none(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame | None:
    """The table at ``path``, or None if there is no such path. Any other failure, such as a denied access, is raised."""
    try:
        return spark.read.format(fmt).options(**options).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_csv(spark: SparkSession, path: str, numeric: list[str]) -> DataFrame:
    """Header CSV with the named columns as doubles. Blank cells and text that is no number become NULL."""
    raw = spark.read.csv(path, header=True)
    blank = lambda c: F.nullif(F.trim(col(c)), F.lit(""))
    return raw.select(*[
        (blank(c).try_cast("double") if c in numeric else blank(c)).alias(c) for c in raw.columns
    ])


def read_city_types(spark: SparkSession, path: str) -> DataFrame:
    """Six pollutants and the area type; incomplete rows are dropped."""
    raw = read_csv(spark, path, cfg.CITY_FEATURES)
    return project_complete(nan_to_null(raw), [*cfg.CITY_FEATURES, cfg.CITY_TARGET])


def read_health_impact(spark: SparkSession, path: str) -> DataFrame:
    """Health table with the class code replaced by its name; rows with unknown codes are dropped."""
    wanted = [cfg.HEALTH_ID, *cfg.HEALTH_FEATURES, cfg.HEALTH_TARGET]
    raw = require_columns(nan_to_null(read_csv(spark, path, wanted)), wanted)
    complete = drop_incomplete(raw, [cfg.HEALTH_TARGET])
    named = decode_classes(complete, cfg.HEALTH_TARGET, "_name").drop(cfg.HEALTH_TARGET)
    return named.withColumnRenamed("_name", cfg.HEALTH_TARGET)


def read_sensor_series(spark: SparkSession, path: str, fmt: str = "d/M/yyyy H:mm:ss") -> DataFrame:
    """Sensor series: empty columns dropped, -200 as missing, medians filled in, timestamps parsed.

    Columns that only hold the sentinel survive the empty-column check and stay NULL.
    """
    raw = spark.read.csv(path, header=True)
    # columns without a heading: the names Spark or a data-frame export gives them
    header = [c for c in raw.columns if not re.fullmatch(r"_c\d+|Unnamed: \d+", c)]
    numeric = [c for c in header if c not in ("Date", "Time")]
    typed = read_csv(spark, path, numeric).select(*[col(c) for c in header])
    kept = drop_all_null_columns(nan_to_null(typed))
    clean = sentinel_to_null(kept)
    sensors = [f.name for f in clean.schema if isinstance(f.dataType, T.NumericType)]
    filled = fill_missing(clean, fit_medians(clean, sensors))
    return parse_timestamps(filled, "Date", "Time", fmt)
