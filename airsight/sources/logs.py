"""Metric logs and training histories stored as JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

METRIC_FIELDS = [
    "accuracy", "precision_weighted", "recall_weighted", "f1_weighted", "roc_auc", "cv_mean", "cv_std", "train_time",
    "predict_time", "rmse", "mae", "mse", "r2", "mape",
]
RECORD_SCHEMA = "struct<model_name: string, " + ", ".join(f"{f}: double" for f in METRIC_FIELDS) + ">"
LOG_SCHEMA = f"best_model string, best_model_overall string, target string, comparison array<{RECORD_SCHEMA}>"
HISTORY_SCHEMA = (
    "epochs_run bigint, loss array<double>, val_loss array<double>, accuracy array<double>, val_accuracy array<double>, "
    "mae array<double>, val_mae array<double>"
)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Whole-file JSON documents (bare NaN allowed); a missing file gives an empty table."""
    from airsight.sources.tables import read_or_none

    found = read_or_none(spark, path, "binaryFile")
    if found is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_metrics_log(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, LOG_SCHEMA)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, HISTORY_SCHEMA)


def parse_records(text: Column) -> Column:
    """Array of metric records from JSON text."""
    return F.from_json(text, f"array<{RECORD_SCHEMA}>", {"allowNonNumericNumbers": "true"})
