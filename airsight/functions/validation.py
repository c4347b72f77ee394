"""Row validation: each rule set yields an array of messages, empty when the row is valid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airsight import config as cfg
from airsight.functions.text import fixed, strip


def parse_number(value: Column) -> Column:
    """Number in a text or numeric column, else NULL. ``1d`` and ``1f`` are Java syntax, not numbers."""
    text = F.lower(strip(value.cast("string")))
    java = F.endswith(text, F.lit("d")) | (F.endswith(text, F.lit("f")) & ~F.endswith(text, F.lit("inf")))
    return F.when(~java, value.cast("string").try_cast("double"))


def positive_number_error(value: Column, number: Column, field: str) -> Column:
    shown = F.coalesce(value.cast("string"), F.lit("None"))
    return (
        F.when(number.isNull(), F.concat(F.lit(f"'{field}' must be a number, got: "), shown))
        .when(number < 0, F.concat(F.lit(f"'{field}' must be ≥ 0, got: "), fixed(number, 2)))
    )


def _errors(*messages: Column) -> Column:
    return F.array_compact(F.array(*messages))


def _with_numbers(df: DataFrame, fields: dict[str, str]) -> tuple[DataFrame, dict[str, Column]]:
    """Parse each checked column once, in a projection of its own."""
    parsed = {name: f"_number_{i}" for i, name in enumerate(fields)}
    table = df.withColumns({parsed[name]: parse_number(F.col(f"`{c}`")) for name, c in fields.items()})
    return table, {name: F.col(p) for name, p in parsed.items()}


def check_pollutants(df: DataFrame, fields: dict[str, str], out: str = "errors") -> DataFrame:
    """Rules for the six pollutants; ``fields`` maps pollutant to column. A NULL value counts as absent."""
    table, numbers = _with_numbers(df, fields)
    messages = []
    for name, (top, unit) in cfg.POLLUTANT_LIMITS.items():
        missing = F.lit(f"Missing required pollutant: {name}")
        if name not in fields:
            messages.append(missing)
            continue
        value, number = F.col(f"`{fields[name]}`"), numbers[name]
        high = F.when(
            (number > 2 * top) & ~F.isnan(number),
            F.concat(
                F.lit(f"⚠️ {name} value "), fixed(number, 1),
                F.lit(f" seems unusually high. Typical max: {top} {unit}"),
            ),
        )
        checked = F.coalesce(positive_number_error(value, number, name), high)
        messages.append(F.when(value.isNull(), missing).otherwise(checked))
    return table.select(*df.columns, _errors(*messages).alias(out))


def check_health(df: DataFrame, fields: dict[str, str], out: str = "errors") -> DataFrame:
    """Rules for the 13 health features; ``fields`` maps feature to column. A NULL value counts as absent."""
    table, numbers = _with_numbers(df, fields)
    messages = []
    for name in cfg.HEALTH_FEATURES:
        missing = F.lit(f"Missing required field: {name}")
        if name in fields:
            value = F.col(f"`{fields[name]}`")
            missing = F.when(value.isNull(), missing).otherwise(positive_number_error(value, numbers[name], name))
        messages.append(missing)

    def outside(name: str, low: float, high: float, text: str) -> None:
        if name in fields:
            number = numbers[name]
            bad = ~number.between(low, high) | F.isnan(number)
            messages.append(F.when(bad, F.concat(F.lit(text), number.cast("string"))))

    if "AQI" in fields:
        messages.append(
            F.when((numbers["AQI"] > 500) & ~F.isnan(numbers["AQI"]), "AQI must be between 0 and 500")
        )
    outside("Humidity", 0, 100, "Humidity must be between 0% and 100%, got: ")
    outside("Temperature", -50, 60, "Temperature must be between -50°C and 60°C, got: ")
    return table.select(*df.columns, _errors(*messages).alias(out))


def split_valid(checked: DataFrame, errors: str = "errors") -> tuple[DataFrame, DataFrame]:
    """Valid rows and quarantined rows."""
    return checked.filter(F.size(errors) == 0).drop(errors), checked.filter(F.size(errors) > 0)


def risk_input_errors(pollution: Column, city_type: Column, trend: Column) -> Column:
    shown_city = F.coalesce(city_type, F.lit("None"))
    shown_trend = F.coalesce(trend, F.lit("None"))
    return _errors(
        positive_number_error(pollution, parse_number(pollution), "pollution_level"),
        F.when(
            ~F.coalesce(city_type.isin(cfg.CITY_LABELS), F.lit(False)),
            F.concat(F.lit("city_type must be 'Industrial' or 'Residential', got: "), shown_city),
        ),
        F.when(
            ~F.coalesce(trend.isin(cfg.TRENDS), F.lit(False)),
            F.concat(F.lit("trend must be 'improving', 'stable', or 'worsening', got: "), shown_trend),
        ),
    )


def format_errors(errors: Column) -> Column:
    bullets = F.array_join(F.transform(errors, lambda e: F.concat(F.lit("  • "), e)), "\n")
    return (
        F.when(F.size(errors) == 0, "")
        .when(F.size(errors) == 1, F.concat(F.lit("❌ "), F.element_at(errors, 1)))
        .otherwise(F.concat(F.lit("❌ Please fix the following issues:\n"), bullets))
    )
