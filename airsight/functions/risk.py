"""Risk fusion as column expressions; NULL pollution gives a NULL score."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airsight import config as cfg
from airsight.functions.text import let, strip

_NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def clamp(x: Column, low: float = 0.0, high: float = 100.0) -> Column:
    """Keep x inside [low, high]; NaN and NULL give NULL."""
    return let(
        F.nanvl(x, F.lit(None).cast("double")), lambda v: F.when(v.isNotNull(), F.least(F.lit(high), F.greatest(F.lit(low), v)))
    )


def normalize_pollution(level: Column, reference: float = cfg.AQI_REFERENCE) -> Column:
    return clamp(level / F.lit(reference) * F.lit(100.0))


def _lookup(key: Column, table: dict[str, float]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def health_score(label: Column) -> Column:
    """Exact label, then numeric label cut to its integer part, then the first contained label, else 50."""
    text = strip(label)
    whole = let(
        text, lambda t: F.when(F.rlike(t, F.lit(_NUMBER)), t.try_cast("double").try_cast("bigint").cast("string"))
    )

    def first_contained(lowered: Column) -> Column:
        out = F.lit(cfg.HEALTH_DEFAULT_SCORE)
        for k, v in reversed(cfg.HEALTH_SCORES.items()):
            out = F.when(lowered.contains(k.lower()), F.lit(v)).otherwise(out)
        return out

    # each stage runs only if the one before found nothing
    return F.coalesce(
        _lookup(text, cfg.HEALTH_SCORES), _lookup(whole, cfg.HEALTH_SCORES), let(F.lower(text), first_contained)
    )


def is_industrial(city_type: Column) -> Column:
    return F.lower(city_type) == "industrial"


def trend_score(trend: Column) -> Column:
    return F.coalesce(_lookup(F.lower(strip(trend)), cfg.TREND_SCORES), F.lit(cfg.TREND_SCORES["stable"]))


def risk_factors(
    pollution: Column, health: Column, city_type: Column, trend: Column, reference: float = cfg.AQI_REFERENCE
) -> dict[str, Column]:
    """The four factors on a 0-100 scale, unrounded."""
    return {
        "pollution_factor": normalize_pollution(pollution, reference),
        "health_impact_factor": health_score(health),
        "industrial_factor": F.when(is_industrial(city_type), F.lit(cfg.INDUSTRIAL_SCORE)).otherwise(
            F.lit(cfg.RESIDENTIAL_SCORE)
        ),
        "trend_factor": trend_score(trend),
    }


def weighted_score(factors: dict[str, Column]) -> Column:
    """Weighted sum of the factors, clamped, two decimals."""
    terms = [F.lit(weight) * factors[name] for name, weight in cfg.RISK_WEIGHTS.items()]
    return F.round(clamp(reduce(lambda x, y: x + y, terms)), 2)


def with_risk_score(
    df: DataFrame, pollution: str, health: str, city_type: str, trend: str, reference: float = cfg.AQI_REFERENCE
) -> DataFrame:
    """Adds ``risk_score`` and its factors. The factors get a projection of their own, so each is computed once."""
    raw = {name: f"_{name}" for name in cfg.RISK_WEIGHTS}
    factors = risk_factors(F.col(pollution), F.col(health), F.col(city_type), F.col(trend), reference)
    known = df.withColumns({raw[name]: f for name, f in factors.items()})
    return known.select(
        *df.columns,
        weighted_score({name: F.col(c) for name, c in raw.items()}).alias("risk_score"),
        *[F.round(c, 2).alias(name) for name, c in raw.items()],
    )


def _band(score: Column, field: str, gaps: str) -> Column:
    pick = (lambda level: level) if field == "level" else (lambda level: cfg.RISK_BANDS[level][2])
    if gaps not in ("reference", "contiguous"):
        raise ValueError(f"gaps must be 'reference' or 'contiguous', got {gaps!r}")

    def closed(s: Column) -> Column:
        out = F.lit(pick("Critical"))
        for level in ("Alert", "Caution", "Safe"):
            out = F.when(s <= cfg.RISK_BANDS[level][1], pick(level)).otherwise(out)
        return F.when(s.isNotNull(), out)

    def integer_bands(s: Column) -> Column:
        out = F.when(s <= 0, pick("Safe")).otherwise(pick("Critical"))
        for level, (low, high, _) in reversed(cfg.RISK_BANDS.items()):
            out = F.when(s.between(low, high), pick(level)).otherwise(out)
        return F.when(s.isNotNull(), out)

    return let(score, closed if gaps == "contiguous" else integer_bands)


def risk_level(score: Column, gaps: str = "reference") -> Column:
    """Band name. The integer bands leave gaps such as 25 < s < 26, which fall to Critical;
    ``gaps="contiguous"`` closes them."""
    return _band(score, "level", gaps)


def risk_color(score: Column, gaps: str = "reference") -> Column:
    return _band(score, "color", gaps)


def pollution_severity(aqi: Column) -> Column:
    def bands(v: Column) -> Column:
        out = F.lit("Severe")
        for name, (low, high) in reversed(cfg.SEVERITY_BANDS.items()):
            out = F.when((v >= low) & (v < high), name).otherwise(out)
        return F.when(v.isNotNull(), out)

    return let(aqi, bands)


def factor_contribution(factor: Column, name: str) -> Column:
    return F.round(factor * F.lit(cfg.RISK_WEIGHTS[name]), 2)


def class_name(code: Column) -> Column:
    """Health class code to its name; the code is cut to an integer, unknown codes give NULL."""
    out = F.lit(None).cast("string")
    for k, v in cfg.HEALTH_CLASS_NAMES.items():
        out = F.when(code.cast("int") == k, v).otherwise(out)
    return out
