"""Recommendation lookups: constant tables broadcast to the areas, so no area row is ever shuffled."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airsight import advice_text as text
from airsight.functions.risk import is_industrial


def constant_table(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A small literal table (a local relation in the plan)."""
    return spark.createDataFrame(pa.table({n: list(values) for n, values in zip(names, zip(*rows), strict=True)}))


def recommendation_rows(spark: SparkSession) -> DataFrame:
    """(risk_level, audience, category, category_pos, pos, item) for both audiences."""
    rows = []
    for order, (category, (audience, levels, *_)) in enumerate(text.CATEGORIES.items(), start=1):
        for target in ("industrial", "other"):
            if audience in ("all", target):
                for level, items in levels.items():
                    rows += [(level, target, category, order, i, item) for i, item in enumerate(items, start=1)]
    return constant_table(spark, ["kb_level", "audience", "category", "category_pos", "pos", "item"], rows)


def known_level(level: Column) -> Column:
    return F.when(level.isin(list(text.PRIORITIES)), level).otherwise(text.DEFAULT_LEVEL)


def _audience(city_type: Column) -> Column:
    return F.when(is_industrial(city_type), "industrial").otherwise("other")


def recommend(areas: DataFrame, level: str = "risk_level", city_type: str = "city_type") -> DataFrame:
    """One row per area and recommended action."""
    kb = F.broadcast(recommendation_rows(areas.sparkSession))  # a fixed 190 rows
    match = (known_level(areas[level]) == kb["kb_level"]) & (_audience(areas[city_type]) == kb["audience"])
    return areas.join(kb, match).drop("kb_level", "audience")


def recommendation_sections(spark: SparkSession) -> DataFrame:
    """Rendered section text per (level, audience): eight rows."""
    headings = constant_table(
        spark,
        ["category", "heading"],
        [(c, f"\n### {meta[5]} {meta[4]}\n") for c, meta in text.CATEGORIES.items()],
    )
    kb = recommendation_rows(spark).join(F.broadcast(headings), "category")
    lines = kb.select(
        "kb_level", "audience", "category_pos", "pos", F.concat(F.lit("- "), "item").alias("line")
    ).unionByName(
        kb.select("kb_level", "audience", "category_pos", F.lit(0).alias("pos"), F.col("heading").alias("line")).distinct()
    )
    ordered = F.array_sort(F.collect_list(F.struct("category_pos", "pos", "line")))
    body = F.array_join(F.transform(ordered, lambda x: x["line"]), "\n")
    return lines.groupBy("kb_level", "audience").agg(
        F.concat(F.lit(text.RECOMMENDATIONS_TITLE + "\n"), body, F.lit("\n")).alias("recommendations_text")
    )


def with_recommendation_text(areas: DataFrame, level: str = "risk_level", city_type: str = "city_type") -> DataFrame:
    kb = F.broadcast(recommendation_sections(areas.sparkSession))  # eight rows
    match = (known_level(areas[level]) == kb["kb_level"]) & (_audience(areas[city_type]) == kb["audience"])
    return areas.join(kb, match, "left").drop("kb_level", "audience")


def with_priority(areas: DataFrame, level: str = "risk_level") -> DataFrame:
    """Priority colour, badge, timeframe and icon; unknown levels get the Caution entry."""
    table = constant_table(
        areas.sparkSession,
        ["p_level", "priority_color", "badge", "timeframe", "priority_icon"],
        [(k, *v) for k, v in text.PRIORITIES.items()],
    )
    return areas.join(F.broadcast(table), known_level(areas[level]) == table["p_level"], "left").drop("p_level")


def with_category_display(recs: DataFrame, category: str = "category") -> DataFrame:
    """Title and icon per category; unknown categories are title-cased."""
    table = constant_table(
        recs.sparkSession, ["c_name", "title", "icon"], [(c, m[2], m[3]) for c, m in text.CATEGORIES.items()]
    )
    joined = recs.join(F.broadcast(table), recs[category] == table["c_name"], "left")
    return joined.select(
        *recs.columns,
        F.coalesce("title", F.initcap(F.translate(F.col(category), "_", " "))).alias("title"),
        F.coalesce("icon", F.lit(text.DEFAULT_ICON)).alias("icon"),
    )


def recommendation_map(areas: DataFrame, level: str = "risk_level", city_type: str = "city_type") -> DataFrame:
    """Areas with a ``recommendations`` map: category to list of actions in their fixed order."""
    kb = recommendation_rows(areas.sparkSession)
    lists = kb.groupBy("kb_level", "audience", "category", "category_pos").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "item"))), lambda x: x["item"]).alias("items")
    )
    entries = F.array_sort(F.collect_list(F.struct("category_pos", "category", "items")))
    maps = lists.groupBy("kb_level", "audience").agg(
        F.map_from_entries(F.transform(entries, lambda e: F.struct(e["category"], e["items"]))).alias("recommendations")
    )
    maps = F.broadcast(maps)  # eight rows
    match = (known_level(areas[level]) == maps["kb_level"]) & (_audience(areas[city_type]) == maps["audience"])
    return areas.join(maps, match, "left").drop("kb_level", "audience")
