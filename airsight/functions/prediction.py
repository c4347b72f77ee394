"""Prediction records built from class names and class probabilities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airsight.functions.text import let
from airsight.functions.vectors import argmax


def prediction_record(names: Column, probabilities: Column, model_type: str, model_name: str) -> Column:
    """Struct with label, confidence, name-to-probability map, class list, model type and name."""
    return F.struct(
        F.element_at(names, (argmax(probabilities) + 1).cast("int")).alias("prediction"),
        F.array_max(probabilities).alias("confidence"),
        F.map_from_arrays(names, probabilities).alias("probabilities"),
        names.alias("class_names"),
        F.lit(model_type).alias("model_type"),
        F.lit(model_name).alias("model_name"),
    )


def probability_percent(names: Column, probabilities: Column) -> Column:
    """Array of (class, percent with one decimal, is_top) for a probability chart."""

    def entries(top: Column) -> Column:
        return F.zip_with(
            names, probabilities,
            lambda n, p: F.struct(n.alias("cls"), F.round(p * 100, 1).alias("percent"), (p == top).alias("is_top")),
        )

    return let(F.array_max(probabilities), entries)
