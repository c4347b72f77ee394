"""Queries over areas: scores, levels, recommendations and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airsight import advice_text as text
from airsight import config as cfg
from airsight.catalog.adapters import adapter
from airsight.catalog.registry import dec, query, sql
from airsight.functions import risk
from airsight.operators import advice
from airsight.plans import assessment

LABEL = "trim(health_impact)"
HEALTH_SCORE = (
    "CASE " + " ".join(f"WHEN {LABEL} = '{k}' THEN {v}" for k, v in cfg.HEALTH_SCORES.items())
    + " ELSE coalesce(CASE CAST(trunc(try_cast(" + LABEL + " AS DOUBLE)) AS BIGINT) "
    + " ".join(f"WHEN {k} THEN {v}" for k, v in cfg.HEALTH_SCORES.items() if k.isdigit()) + " END, CASE "
    + " ".join(f"WHEN contains(lower({LABEL}), '{k.lower()}') THEN {v}" for k, v in cfg.HEALTH_SCORES.items()) + " ELSE 50.0 END) END"
)
TREND_SCORE = "CASE lower(trim(trend)) WHEN 'improving' THEN 30 WHEN 'worsening' THEN 80 ELSE 50 END"
FACTORS = f"""factors AS (SELECT *,
    least(100, greatest(0, pollution_level / CAST(150 AS DOUBLE) * 100)) AS pf, CAST({HEALTH_SCORE} AS DOUBLE) AS hf,
    CAST(CASE WHEN lower(city_type) = 'industrial' THEN 40 ELSE 10 END AS DOUBLE) AS inf, CAST({TREND_SCORE} AS DOUBLE) AS tf FROM areas)"""
TOTAL = "CAST(0.4 AS DOUBLE) * pf + CAST(0.3 AS DOUBLE) * hf + CAST(0.2 AS DOUBLE) * inf + CAST(0.1 AS DOUBLE) * tf"
SCORED = f"""scored AS (SELECT *, {dec(f'least(100, greatest(0, {TOTAL}))', 2)} AS risk_score, {dec('pf', 2)} AS pollution_factor,
    hf AS health_impact_factor, inf AS industrial_factor, tf AS trend_factor FROM factors)"""
LEVEL = (
    "CASE WHEN risk_score BETWEEN 0 AND 25 THEN 'Safe' WHEN risk_score BETWEEN 26 AND 50 THEN 'Caution' "
    "WHEN risk_score BETWEEN 51 AND 75 THEN 'Alert' WHEN risk_score <= 0 THEN 'Safe' ELSE 'Critical' END"
)
SEVERITY = (
    "CASE WHEN pollution_level >= 0 AND pollution_level < 50 THEN 'Low' WHEN pollution_level >= 50 AND pollution_level < 100 THEN 'Moderate' "
    "WHEN pollution_level >= 100 AND pollution_level < 150 THEN 'High' ELSE 'Severe' END"
)
COLOR = "CASE risk_level WHEN 'Safe' THEN '#22c55e' WHEN 'Caution' THEN '#eab308' WHEN 'Alert' THEN '#f97316' ELSE '#ef4444' END"
ASSESSED = f"""assessed AS (SELECT area_id, city_type, {dec('confidence * 100', 1)} AS city_type_confidence, health_impact,
    {dec('(1 - confidence) * 100', 1)} AS health_impact_confidence, {dec('pollution_level', 2)} AS pollution_level, pollution_severity,
    CASE WHEN area_id % 5 <> 0 THEN {dec('pollution_level * 1.1', 2)} END AS predicted_pollution, trend, risk_score, pollution_factor,
    health_impact_factor, industrial_factor, trend_factor, risk_level, {COLOR} AS risk_color,
    concat(risk_level, ' risk area — ', city_type, ' classification with ', lower(pollution_severity), ' pollution levels and ',
           lower(health_impact), ' health impact.') AS summary
    FROM (SELECT *, {LEVEL} AS risk_level, {SEVERITY} AS pollution_severity FROM scored))"""
ASSESSED_PARTS = ("areas", FACTORS, SCORED, ASSESSED)


def assessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    areas = adapter(spark, sf_dir, "areas").withColumns({
        "health_confidence": 1 - F.col("confidence"),
        "predicted": F.when(F.col("area_id") % 5 != 0, F.col("pollution_level") * 1.1).otherwise(0.0),
    })
    return assessment.assess(areas, city_confidence="confidence", predicted="predicted")


@query("health_score", sql(f"SELECT area_id, health_impact, CAST({HEALTH_SCORE} AS DOUBLE) AS score FROM areas", "areas"))
def health_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter(spark, sf_dir, "areas").select(
        "area_id", "health_impact", risk.health_score(F.col("health_impact")).alias("score")
    )


@query("risk_score", sql(
    "SELECT area_id, risk_score, pollution_factor, health_impact_factor, industrial_factor, trend_factor FROM scored", "areas", FACTORS, SCORED
))
def risk_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    areas = adapter(spark, sf_dir, "areas")
    scored = risk.with_risk_score(areas, "pollution_level", "health_impact", "city_type", "trend")
    return scored.select("area_id", "risk_score", *cfg.RISK_WEIGHTS)


@query("risk_level", sql(
    f"SELECT area_id, risk_score, risk_level, {COLOR} AS risk_color, closed_level FROM (SELECT *, {LEVEL} AS risk_level, "
    "CASE WHEN risk_score <= 25 THEN 'Safe' WHEN risk_score <= 50 THEN 'Caution' WHEN risk_score <= 75 THEN 'Alert' ELSE 'Critical' END AS closed_level FROM scored)",
    "areas", FACTORS, SCORED,
))
def risk_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = F.col("risk_score")
    return risk_score(spark, sf_dir).select(
        "area_id", "risk_score", risk.risk_level(score).alias("risk_level"), risk.risk_color(score).alias("risk_color"),
        risk.risk_level(score, "contiguous").alias("closed_level"),
    )


@query("pollution_severity", sql(f"SELECT area_id, pollution_level, {SEVERITY} AS severity FROM areas", "areas"))
def pollution_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter(spark, sf_dir, "areas").select(
        "area_id", "pollution_level", risk.pollution_severity(F.col("pollution_level")).alias("severity")
    )


@query("assessment", sql("SELECT * FROM assessed", *ASSESSED_PARTS))
def assessment_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assessed(spark, sf_dir)


@query("factor_contributions", sql(
    " UNION ALL ".join(
        f"SELECT area_id, '{f}' AS factor, {f} AS score, CAST({w} AS DOUBLE) AS weight, {dec(f'{f} * CAST({w} AS DOUBLE)', 2)} AS contribution FROM assessed"
        for f, w in cfg.RISK_WEIGHTS.items()
    ),
    *ASSESSED_PARTS,
))
def factor_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assessment.factor_contributions(assessed(spark, sf_dir))


# --- recommendations ----------------------------------------------------------


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


ADVICE = "advice(audience, category, category_pos, level, pos, item) AS (VALUES " + ", ".join(
    f"('{audience}', '{category}', {order}, '{level}', {i}, {_quoted(item)})"
    for order, (category, (audience, levels, *_)) in enumerate(text.CATEGORIES.items(), start=1)
    for level, items in levels.items()
    for i, item in enumerate(items, start=1)
) + ")"
MATCH = "x.level = a.risk_level AND (x.audience = 'all' OR (x.audience = 'industrial') = (lower(a.city_type) = 'industrial'))"


@query("recommendations", sql(
    f"SELECT area_id, risk_level, city_type, category, CAST(category_pos AS BIGINT) AS category_pos, CAST(pos AS BIGINT) AS pos, item FROM assessed a JOIN advice x ON {MATCH}", *ASSESSED_PARTS, ADVICE
))
def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return advice.recommend(assessed(spark, sf_dir).select("area_id", "risk_level", "city_type"))


PRIORITY = "priority(level, badge, timeframe) AS (VALUES " + ", ".join(
    f"('{k}', {_quoted(v[1])}, {_quoted(v[2])})" for k, v in text.PRIORITIES.items()
) + ")"
DISPLAY = "display(category, title, icon) AS (VALUES " + ", ".join(
    f"('{c}', {_quoted(m[2])}, {_quoted(m[3])})" for c, m in text.CATEGORIES.items()
) + ")"


@query("recommendation_display", sql(
    f"""SELECT a.area_id, a.risk_level, p.badge, p.timeframe, x.category, d.title, d.icon, CAST(x.pos AS BIGINT) AS pos, x.item
        FROM assessed a JOIN advice x ON {MATCH} LEFT JOIN display d ON d.category = x.category LEFT JOIN priority p ON p.level = a.risk_level""",
    *ASSESSED_PARTS, ADVICE, PRIORITY, DISPLAY,
))
def recommendation_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = advice.with_category_display(advice.with_priority(recommendations(spark, sf_dir)))
    return shown.select("area_id", "risk_level", "badge", "timeframe", "category", "title", "icon", "pos", "item")


# --- reports ------------------------------------------------------------------


def _filled(template: str, **values: str) -> str:
    """SQL concat of a template whose {names} are SQL expressions."""
    pieces, rest = [], template
    while rest:
        head, brace, tail = rest.partition("{")
        if head:
            pieces.append(_quoted(head))
        if not brace:
            break
        name, _, rest = tail.partition("}")
        pieces.append(values[name])
    return "concat(" + ", ".join(pieces) + ")"


def _shown(expr: str, digits: int) -> str:
    return f"printf('%.{digits}f', {dec(expr, digits)})"


def _either(condition: str, yes: str, no: str) -> str:
    return f"CASE WHEN {condition} THEN {_quoted(yes)} ELSE {_quoted(no)} END"


TREND_TEXT = "concat(upper(left(trend, 1)), lower(substring(trend, 2)))"
COMMON = {
    "city": "city_type", "health": "health_impact", "level": "risk_level", "severity": "pollution_severity", "trend": TREND_TEXT,
    "score": _shown("risk_score", 1), "city_conf": _shown("city_type_confidence", 1), "health_conf": _shown("health_impact_confidence", 1),
}
NOW = "2024-01-31 12:00:00"
SECTIONS = {
    "header": _filled(text.HEADER, now="'January 31, 2024 at 12:00'"),
    "executive_summary": _filled(
        text.EXECUTIVE_SUMMARY, **COMMON, advice=_either("risk_level IN ('Alert', 'Critical')", text.SUMMARY_URGENT, text.SUMMARY_CALM)
    ),
    "air_quality": _filled(
        text.AIR_QUALITY, **COMMON, pollution=_shown("pollution_level", 1),
        predicted=f"CASE WHEN predicted_pollution <> 0 THEN {_shown('predicted_pollution', 2)} ELSE 'N/A' END",
        advice=_either("pollution_severity IN ('High', 'Severe')", text.AIR_HIGH, text.AIR_CALM),
    ),
    "city_classification": _filled(
        text.CITY_CLASSIFICATION, **COMMON, advice=_either("city_type = 'Industrial'", text.CITY_INDUSTRIAL, text.CITY_OTHER)
    ),
    "health_impact": _filled(
        text.HEALTH_IMPACT, **COMMON, advice=_either("health_impact IN ('High', 'Severe', 'Very High')", text.HEALTH_HIGH, text.HEALTH_CALM)
    ),
    "risk_score": _filled(
        text.RISK_TABLE, **COMMON,
        **{f: _shown(f, 1) for f in cfg.RISK_WEIGHTS},
        **{f.replace("_factor", "_part"): _shown(f"{f} * CAST({w} AS DOUBLE)", 1) for f, w in cfg.RISK_WEIGHTS.items()},
    ),
    "recommendations": "recs",
    "conclusion": _filled(
        text.CONCLUSION, **COMMON,
        advice="CASE risk_level " + " ".join(f"WHEN '{k}' THEN {_quoted(v)}" for k, v in text.CONCLUSION_ADVICE.items()) + " ELSE '' END",
    ),
}
HEADINGS = "headings(category, heading) AS (VALUES " + ", ".join(
    f"('{c}', {_quoted(f'### {m[5]} {m[4]}')})" for c, m in text.CATEGORIES.items()
) + ")"
RECS = f"""recs AS (SELECT area_id, concat({_quoted(text.RECOMMENDATIONS_TITLE)}, chr(10), string_agg(block, chr(10) ORDER BY category_pos), chr(10)) AS recs
    FROM (SELECT a.area_id, x.category_pos, concat(chr(10), h.heading, chr(10), chr(10), string_agg(concat('- ', x.item), chr(10) ORDER BY x.pos)) AS block
          FROM assessed a JOIN advice x ON {MATCH} JOIN headings h ON h.category = x.category GROUP BY a.area_id, x.category_pos, h.heading) GROUP BY area_id)"""
WRITTEN = "written AS (SELECT area_id, " + ", ".join(f"{e} AS {n}" for n, e in SECTIONS.items()) + " FROM assessed JOIN recs USING (area_id))"
WRITTEN = WRITTEN.replace("recs AS recommendations", "recs.recs AS recommendations")
REPORT_PARTS = (*ASSESSED_PARTS, ADVICE, HEADINGS, RECS, WRITTEN)


def written(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assessment.reports(assessed(spark, sf_dir), F.lit(NOW).cast("timestamp_ntz"))


@query("report_sections", sql("SELECT * FROM written", *REPORT_PARTS))
def report_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(spark, sf_dir).drop("report")


@query("report_markdown", sql(
    f"SELECT area_id, concat_ws({_quoted(text.SECTION_SEPARATOR)}, {', '.join(text.SECTION_ORDER)}) AS report, 'template' AS method FROM written", *REPORT_PARTS
))
def report_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(spark, sf_dir).select("area_id", "report", F.lit("template").alias("method"))
