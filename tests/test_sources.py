"""Readers, writers and logs on small files."""

import json
import math

import pytest
from pyspark.sql import functions as F

from airsight.operators import comparison, profile
from airsight.sources import logs, sinks, tables


def test_city_types(spark, tmp_path):
    (tmp_path / "city.csv").write_text("Date,City,CO,NO2,SO2,O3,PM2.5,PM10,Type\nx,a,1,2,3,4,5,6,Industrial\nx,b,1,,3,4,5,6,Residential\nx,c,1,n/a,3,4,5,6,Industrial\n")
    df = tables.read_city_types(spark, str(tmp_path / "city.csv"))
    assert df.columns == ["CO", "NO2", "SO2", "O3", "PM2.5", "PM10", "Type"] and df.count() == 1
    (tmp_path / "bad.csv").write_text("CO,Type\n1,x\n")
    with pytest.raises(ValueError, match="PM10"):
        tables.read_city_types(spark, str(tmp_path / "bad.csv"))


def test_health_impact(spark, tmp_path):
    names = ["RecordID", *[c for c in __import__("airsight.config", fromlist=["x"]).HEALTH_FEATURES], "HealthImpactClass"]
    rows = [[str(i)] + ["1.5"] * 13 + [c] for i, c in enumerate(["0.0", "4", "2.9", "7", ""])]
    (tmp_path / "h.csv").write_text("\n".join([",".join(names), *[",".join(r) for r in rows]]))
    got = tables.read_health_impact(spark, str(tmp_path / "h.csv")).collect()
    assert sorted((r["RecordID"], r["HealthImpactClass"]) for r in got) == [(0.0, "Very High"), (1.0, "Severe"), (2.0, "Low")]


def test_sensor_series(spark, tmp_path):
    text = "﻿Date,Time,CO(GT),T,dead,Unnamed: 4\n10/3/2004,18:00:00,2.0,-200,,\n11/3/2004,0:00:00,-200,-200, ,\n12/3/2004,1:00:00,4.0,-200,,\n40/3/2004,1:00:00,9.0,-200,,\n"
    (tmp_path / "s.csv").write_text(text, encoding="utf-8")
    df = tables.read_sensor_series(spark, str(tmp_path / "s.csv"))
    assert df.columns == ["Date", "Time", "CO(GT)", "T", "DateTime"]
    # the median comes from all rows, also the one whose date is rejected; the sentinel-only column stays empty
    assert [(r["CO(GT)"], r["T"]) for r in df.orderBy("DateTime").collect()] == [(2.0, None), (4.0, None), (4.0, None)]


def test_audit_of_a_missing_table(spark, tmp_path):
    audit = profile.dataset_audit({"here": spark.range(3), "gone": tables.read_or_none(spark, str(tmp_path / "gone"))})
    assert {r["dataset"]: (r["available"], r["n_rows"]) for r in audit.collect()} == {"here": (True, 3), "gone": (False, None)}


def test_logs_and_histories(spark, tmp_path):
    (tmp_path / "log.json").write_text('{\n "best_model": "a",\n "comparison": [{"model_name": "a", "roc_auc": 0.9, "cv_mean": NaN}, {"model_name": "b", "rmse": 1.5}]\n}')
    rows = {r["model_name"]: r for r in comparison.explode_log(logs.read_metrics_log(spark, str(tmp_path / "log.json"))).collect()}
    assert rows["a"]["roc_auc"] == 0.9 and math.isnan(rows["a"]["cv_mean"]) and rows["b"]["rmse"] == 1.5 and rows["b"]["roc_auc"] is None
    assert logs.read_metrics_log(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "h.json").write_text(json.dumps({"epochs_run": 2, "loss": [1.0, 0.5], "val_loss": [2.0, 1.0]}))
    history = logs.read_history(spark, str(tmp_path / "h.json"))
    assert comparison.history_rows(history.withColumn("run", F.lit(1)), "run", ["loss", "val_loss"]).count() == 2


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "ML", 0.5), ("b", "DL", None)], "model_name string, type string, roc_auc double")
    sinks.write_comparison(df, str(tmp_path / "cmp"))
    sinks.write_comparison(df, str(tmp_path / "reg"), regression=True)
    assert spark.read.csv(str(tmp_path / "cmp"), header=True).columns == df.columns
    assert "type" not in spark.read.csv(str(tmp_path / "reg"), header=True).columns
    sinks.write_best_metrics(df, "b", str(tmp_path / "best"))
    assert spark.read.csv(str(tmp_path / "best"), header=True).first()["model_name"] == "b"
    sinks.write_metadata(spark, {"target": "x", "features": ["a", "b"], "rows": 3, "r2": 0.5}, str(tmp_path / "meta"))
    assert spark.read.json(str(tmp_path / "meta")).first()["features"] == ["a", "b"]
    first = sinks.update_log(spark, df, None, str(tmp_path / "log1"))
    new = spark.createDataFrame([("b", "DL", 0.7), ("c", "ML", 0.1)], df.schema)
    merged = sinks.update_log(spark, new, str(tmp_path / "log1"), str(tmp_path / "log2"))
    assert first.count() == 2 and {r["model_name"]: r["roc_auc"] for r in merged.collect()} == {"a": 0.5, "b": 0.7, "c": 0.1}
    report = spark.createDataFrame([("x", 1.0, 0.5, 0.6, 3.0)], "label string, precision double, recall double, f1 double, support double")
    sinks.write_classification_report(report, "m", str(tmp_path / "rep"))
    assert spark.read.csv(str(tmp_path / "rep"), header=True).columns == ["label", "model", "precision", "recall", "f1-score", "support"]
