"""Report sections as text expressions over an assessment row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airsight import advice_text as text
from airsight import config as cfg
from airsight.functions.text import capitalize, fill, fixed


def report_sections(generated_at: Column) -> dict[str, Column]:
    """Section name to text; expects the columns written by ``plans.assessment.assess``
    plus ``recommendations_text``."""
    city, health, level = F.col("city_type"), F.col("health_impact"), F.col("risk_level")
    severity, trend = F.col("pollution_severity"), capitalize(F.col("trend"))
    score = fixed(F.col("risk_score"), 1)
    city_conf, health_conf = fixed(F.col("city_type_confidence"), 1), fixed(F.col("health_impact_confidence"), 1)
    predicted = F.coalesce(
        F.when(F.col("predicted_pollution") != 0, fixed(F.col("predicted_pollution"), 2)), F.lit("N/A")
    )
    conclusion = F.lit("")
    for name, advice in text.CONCLUSION_ADVICE.items():
        conclusion = F.when(level == name, advice).otherwise(conclusion)
    factors = {name: fixed(F.col(name), 1) for name in cfg.RISK_WEIGHTS}
    parts = {
        name.replace("_factor", "_part"): fixed(F.col(name) * F.lit(w), 1) for name, w in cfg.RISK_WEIGHTS.items()
    }

    def choose(condition: Column, yes: str, no: str) -> Column:
        return F.when(condition, yes).otherwise(no)

    return {
        "header": fill(text.HEADER, now=F.date_format(generated_at, "MMMM dd, yyyy 'at' HH:mm")),
        "executive_summary": fill(
            text.EXECUTIVE_SUMMARY, city=city, city_conf=city_conf, score=score, level=level, severity=severity,
            trend=trend, health=health, health_conf=health_conf,
            advice=choose(level.isin("Alert", "Critical"), text.SUMMARY_URGENT, text.SUMMARY_CALM),
        ),
        "air_quality": fill(
            text.AIR_QUALITY, pollution=fixed(F.col("pollution_level"), 1), severity=severity, trend=trend,
            predicted=predicted, advice=choose(severity.isin("High", "Severe"), text.AIR_HIGH, text.AIR_CALM),
        ),
        "city_classification": fill(
            text.CITY_CLASSIFICATION, city=city, city_conf=city_conf,
            advice=choose(city == "Industrial", text.CITY_INDUSTRIAL, text.CITY_OTHER),
        ),
        "health_impact": fill(
            text.HEALTH_IMPACT, health=health, health_conf=health_conf,
            advice=choose(health.isin("High", "Severe", "Very High"), text.HEALTH_HIGH, text.HEALTH_CALM),
        ),
        "risk_score": fill(text.RISK_TABLE, score=score, level=level, **factors, **parts),
        "recommendations": F.coalesce("recommendations_text", F.lit(text.RECOMMENDATIONS_NONE)),
        "conclusion": fill(text.CONCLUSION, city=city, level=level, score=score, advice=conclusion),
    }


def assemble(sections: dict[str, Column]) -> Column:
    """One markdown document in the fixed section order."""
    return F.concat_ws(text.SECTION_SEPARATOR, *[sections[s] for s in text.SECTION_ORDER if s in sections])
