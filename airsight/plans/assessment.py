"""Area assessment: score, level, recommendations and report for a table (or stream) of areas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airsight import config as cfg
from airsight.functions import risk
from airsight.functions.report import assemble, report_sections
from airsight.operators.advice import with_recommendation_text

FACTORS = list(cfg.RISK_WEIGHTS)


def assess(
    areas: DataFrame,
    city_type: str = "city_type",
    city_confidence: str = "city_confidence",
    health: str = "health_impact",
    health_confidence: str = "health_confidence",
    pollution: str = "pollution_level",
    predicted: str | None = None,
    trend: str | None = "trend",
    gaps: str = "reference",
    keep: tuple[str, ...] = ("area_id",),
) -> DataFrame:
    """Unified assessment per area; row-local, so it also runs on a streaming table."""
    next_level = F.col(predicted) if predicted else F.lit(None).cast("double")
    direction = F.col(trend) if trend else F.lit("stable")
    plain = areas.select(
        *keep,
        F.col(city_type).alias("city_type"),
        F.round(F.col(city_confidence) * 100, 1).alias("city_type_confidence"),
        F.col(health).alias("health_impact"),
        F.round(F.col(health_confidence) * 100, 1).alias("health_impact_confidence"),
        F.round(pollution, 2).alias("pollution_level"),
        risk.pollution_severity(F.col(pollution)).alias("pollution_severity"),
        F.when(next_level != 0, F.round(next_level, 2)).alias("predicted_pollution"),
        direction.alias("trend"),
        F.col(pollution).alias("_level"),
    )
    scored = risk.with_risk_score(plain, "_level", "health_impact", "city_type", "trend").drop("_level")
    levelled = scored.withColumns({
        "risk_level": risk.risk_level(F.col("risk_score"), gaps), "risk_color": risk.risk_color(F.col("risk_score"), gaps),
    })
    summary = F.concat(
        "risk_level", F.lit(" risk area — "), "city_type", F.lit(" classification with "),
        F.lower("pollution_severity"), F.lit(" pollution levels and "), F.lower("health_impact"),
        F.lit(" health impact."),
    )
    return levelled.withColumn("summary", summary)


def factor_contributions(assessed: DataFrame, keep: tuple[str, ...] = ("area_id",)) -> DataFrame:
    """Long form: one row per area and factor with score, weight and weighted contribution."""
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("factor"), F.col(name).alias("score"), F.lit(w).alias("weight"),
            risk.factor_contribution(F.col(name), name).alias("contribution"),
        )
        for name, w in cfg.RISK_WEIGHTS.items()
    ])
    return assessed.select(*keep, F.inline(rows))


def reports(assessed: DataFrame, generated_at: Column, keep: tuple[str, ...] = ("area_id",)) -> DataFrame:
    """One markdown report per area, with its sections as separate columns."""
    sections = report_sections(generated_at)
    texts = with_recommendation_text(assessed).select(*keep, *[c.alias(n) for n, c in sections.items()])
    return texts.withColumn("report", assemble({s: F.col(s) for s in sections}))
