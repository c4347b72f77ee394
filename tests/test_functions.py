"""Row-level rules on literal rows."""

import math

import pytest
from pyspark.sql import functions as F

from airsight.functions import prediction, risk, text, validation, vectors
from airsight.operators import advice
from airsight.plans import assessment


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).coalesce(1).select(column).collect()]


def test_risk_level_bands_and_gaps(spark):
    scores = [0.0, 25.0, 25.5, 26.0, 50.99, 51.0, 75.0, 75.01, 76.0, 100.0, -3.0]
    rows = [(s,) for s in scores]
    assert values(spark, rows, "s double", risk.risk_level(F.col("s"))) == [
        "Safe", "Safe", "Critical", "Caution", "Critical", "Alert", "Alert", "Critical", "Critical", "Critical", "Safe",
    ]
    assert values(spark, rows, "s double", risk.risk_level(F.col("s"), "contiguous")) == [
        "Safe", "Safe", "Caution", "Caution", "Alert", "Alert", "Alert", "Critical", "Critical", "Critical", "Safe",
    ]
    with pytest.raises(ValueError):
        risk.risk_level(F.lit(1.0), "other")


def test_pollution_severity(spark):
    rows = [(v,) for v in (-1.0, 0.0, 49.99, 50.0, 100.0, 150.0, 998.0, 999.0, None)]
    assert values(spark, rows, "v double", risk.pollution_severity(F.col("v"))) == [
        "Severe", "Low", "Low", "Moderate", "High", "Severe", "Severe", "Severe", None,
    ]


def test_health_score_stages(spark):
    labels = ["Low", "Very High", "very high", "2", "2.0", " 3 ", "10", "1d", "nan", "", "foo", "-0.5", "Extreme SEVERE", " 2 "]
    got = values(spark, [(s,) for s in labels], "s string", risk.health_score(F.col("s")))
    assert got == [20, 100, 60, 60, 60, 80, 20, 40, 50, 50, 50, 20, 80, 60]


def test_worked_risk_example(spark):
    df = spark.createDataFrame(
        [(1, 127.5, "High", "INDUSTRIAL", "WORSENING "), (2, None, "Low", "Residential", "sideways"), (3, float("nan"), "Low", "x", "")],
        "area_id int, pollution_level double, health_impact string, city_type string, trend string",
    ).withColumns({"city_confidence": F.lit(0.5), "health_confidence": F.lit(0.25)})
    rows = {r["area_id"]: r for r in assessment.assess(df).collect()}
    first = rows[1]
    assert (first["risk_score"], first["risk_level"], first["pollution_factor"], first["trend_factor"]) == (68.0, "Alert", 85.0, 80.0)
    assert first["summary"] == "Alert risk area — INDUSTRIAL classification with high pollution levels and high health impact."
    assert first["city_type_confidence"] == 50.0 and first["predicted_pollution"] is None
    assert rows[2]["risk_score"] is None and rows[3]["risk_score"] is None and rows[2]["trend_factor"] == 50.0


def test_strip_matches_python(spark):
    samples = ["", " \t\n", " a　", "\x1ca b\x1f", "\x85x ", "​keep​", "é  "]
    assert values(spark, [(s,) for s in samples], "s string", text.strip(F.col("s"))) == [s.strip() for s in samples]
    assert values(spark, [(s,) for s in samples], "s string", text.has_content(F.col("s"))) == [bool(s.strip()) for s in samples]
    assert values(spark, [(s,) for s in samples], "s string", text.collapse(F.col("s"))) == [" ".join(s.split()) for s in samples]


def test_token_estimate_and_capitalize(spark):
    assert values(spark, [("",), ("abc",), ("a" * 9,)], "s string", text.token_estimate(F.col("s"))) == [1, 1, 2]
    assert values(spark, [("sTABLE",), ("",)], "s string", text.capitalize(F.col("s"))) == ["Stable", ""]


def test_pollutant_rules(spark):
    fields = {"CO": "a", "NO2": "b", "SO2": "c", "O3": "d", "PM2.5": "e"}
    df = spark.createDataFrame(
        [("60", "800.1", "-1", "x", None), ("60.1", "nan", "1d", " 7 ", "inf")], "a string, b string, c string, d string, e string"
    )
    one, two = [r["errors"] for r in validation.check_pollutants(df, fields).collect()]
    assert one == [
        "⚠️ NO2 value 800.1 seems unusually high. Typical max: 400.0 µg/m³", "'SO2' must be ≥ 0, got: -1.00", "'O3' must be a number, got: x",
        "Missing required pollutant: PM2.5", "Missing required pollutant: PM10",
    ]
    assert two[0] == "⚠️ CO value 60.1 seems unusually high. Typical max: 30.0 mg/m³"
    assert two[1] == "'SO2' must be a number, got: 1d" and len(two) == 4
    ok, bad = validation.split_valid(validation.check_pollutants(df, fields))
    assert ok.count() == 0 and bad.count() == 2


def test_health_rules(spark):
    df = spark.createDataFrame([(500.0, 101.0, -10.0), (500.1, 100.0, 60.0), (1.0, 0.0, 60.5)], "aqi double, h double, t double")
    got = validation.check_health(df, {"AQI": "aqi", "Humidity": "h", "Temperature": "t"})
    kept = [[m for m in r["errors"] if not m.startswith("Missing")] for r in got.collect()]
    assert kept == [
        ["'Temperature' must be ≥ 0, got: -10.00", "Humidity must be between 0% and 100%, got: 101.0"],
        ["AQI must be between 0 and 500"],
        ["Temperature must be between -50°C and 60°C, got: 60.5"],
    ]


def test_risk_rules_and_messages(spark):
    df = spark.createDataFrame([(1.0, "Industrial", "stable"), (-1.0, "industrial", "Stable")], "p double, c string, t string")
    errors = validation.risk_input_errors(F.col("p"), F.col("c"), F.col("t"))
    got = [r["m"] for r in df.select(validation.format_errors(errors).alias("m")).collect()]
    assert got[0] == "" and got[1].startswith("❌ Please fix the following issues:\n  • 'pollution_level' must be ≥ 0, got: -1.00\n  • city_type")


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), ([1000.0, 1001.0],)], "v array<double>")
    assert [r[0] for r in df.select(vectors.l2_normalize(F.col("v"))).collect()][:2] == [[0.6, 0.8], [0.0, 0.0]]
    soft = [r[0] for r in df.select(vectors.softmax(F.col("v"))).collect()]
    assert soft[2] == pytest.approx([1 / (1 + math.e), math.e / (1 + math.e)]) and soft[1] == [0.5, 0.5]
    assert [r[0] for r in df.select(vectors.argmax(F.col("v"))).collect()] == [1, 0, 1]
    assert df.select(vectors.dot(F.col("v"), F.col("v"))).first()[0] == 25.0


def test_prediction_record(spark):
    df = spark.createDataFrame([(["a", "b"], [0.25, 0.75])], "n array<string>, p array<double>")
    r = df.select(prediction.prediction_record(F.col("n"), F.col("p"), "ML", "m").alias("r")).first()["r"]
    assert (r["prediction"], r["confidence"], r["probabilities"]) == ("b", 0.75, {"a": 0.25, "b": 0.75})
    got = df.select(prediction.probability_percent(F.col("n"), F.col("p"))).first()[0]
    assert [tuple(x) for x in got] == [("a", 25.0, False), ("b", 75.0, True)]


def test_recommendations(spark):
    areas = spark.createDataFrame(
        [(1, "Critical", "INDUSTRIAL"), (2, "odd", "Residential"), (3, "Safe", "Residential")], "area_id int, risk_level string, city_type string"
    )
    rows = advice.recommend(areas).collect()
    by = {i: [r["category"] for r in rows if r["area_id"] == i] for i in (1, 2, 3)}
    assert len(by[1]) == 4 + 4 + 5 + 4 + 5 + 3 and "urgent_actions" in by[1] and "traffic_management" not in by[1]
    assert len(by[2]) == 4 + 4 + 4 + 3 + 4 and "industrial_controls" not in by[2]  # unknown level reads as Caution
    assert "urgent_actions" not in by[3]
    mapped = advice.recommendation_map(areas)
    maps = {r["area_id"]: r["recommendations"] for r in mapped.collect()}
    assert mapped.filter("area_id = 1").select(F.map_keys("recommendations")).first()[0] == ["monitoring", "green_infrastructure", "public_health", "policy", "industrial_controls", "urgent_actions"]
    assert len(maps[3]["monitoring"]) == 2
    priority = {r["area_id"]: r["timeframe"] for r in advice.with_priority(areas).collect()}
    assert priority[2] == "Short-term (1-3 months)" and priority[1] == "EMERGENCY (24-48 hours)"
    odd = spark.createDataFrame([("water_supply",)], "category string")
    assert tuple(advice.with_category_display(odd).first()) == ("water_supply", "Water Supply", "📌")


def test_report_text(spark):
    df = spark.createDataFrame(
        [(1, 127.5, "High", "Industrial", "worsening", 0.9, 0.8, 0.0)],
        "area_id int, pollution_level double, health_impact string, city_type string, trend string, city_confidence double, health_confidence double, predicted double",
    )
    assessed = assessment.assess(df, predicted="predicted")
    row = assessment.reports(assessed, F.lit("2024-03-05 07:08:00").cast("timestamp_ntz")).first()
    assert row["header"] == "# 🌍 Environmental Impact Assessment Report\n*Generated: March 05, 2024 at 07:08*\n"
    assert "| Predicted Next Period | N/A |" in row["air_quality"] and "**68.0/100 (Alert level)**" in row["executive_summary"]
    assert "| Pollution Factor | 85.0 | 40% | 34.0 |" in row["risk_score"]
    assert row["recommendations"].startswith("## Mitigation Recommendations\n\n\n### 📡 Monitoring\n\n- Activate full monitoring")
    assert row["report"].count("\n\n---\n\n") == 7


def test_assessment_runs_on_a_stream(spark, tmp_path):
    from airsight.catalog.adapters import adapter

    areas = adapter(spark, "/root/testdata/sf0.001", "areas").withColumns({"city_confidence": F.lit(0.5), "health_confidence": F.lit(0.5)})
    areas.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(areas.schema).parquet(str(tmp_path / "in"))
    scored = advice.recommend(assessment.assess(stream).select("area_id", "risk_level", "city_type", "risk_score"))
    query = scored.writeStream.format("memory").queryName("scored").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    batch = advice.recommend(assessment.assess(areas).select("area_id", "risk_level", "city_type", "risk_score"))
    assert sorted(map(tuple, spark.table("scored").collect()), key=repr) == sorted(map(tuple, batch.collect()), key=repr)
