"""Domain constants and table schemas.

Every literal below is a fixed value: results are only right with exactly these
numbers and words, so they are stated once here and used everywhere else.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: schemas ----------------------------------------------------
CITY_FEATURES = ["CO", "NO2", "SO2", "O3", "PM2.5", "PM10"]
CITY_TARGET = "Type"
CITY_LABELS = ["Industrial", "Residential"]

HEALTH_ID = "RecordID"
HEALTH_TARGET = "HealthImpactClass"
HEALTH_FEATURES = [
    "AQI", "PM10", "PM2_5", "NO2", "SO2", "O3", "Temperature", "Humidity", "WindSpeed",
    "RespiratoryCases", "CardiovascularCases", "HospitalAdmissions", "HealthImpactScore",
]

SENSOR_TARGETS = ["CO(GT)", "NO2(GT)"]  # preferred target first
SENSOR_COLUMNS = [
    "CO(GT)", "PT08.S1(CO)", "NMHC(GT)", "C6H6(GT)", "PT08.S2(NMHC)", "NOx(GT)", "PT08.S3(NOx)",
    "NO2(GT)", "PT08.S4(NO2)", "PT08.S5(O3)", "T", "RH", "AH",
]
SENTINEL = -200.0

CITY_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType()) for c in CITY_FEATURES] + [T.StructField(CITY_TARGET, T.StringType())]
)
HEALTH_SCHEMA = T.StructType(
    [T.StructField(HEALTH_ID, T.DoubleType())]
    + [T.StructField(c, T.DoubleType()) for c in HEALTH_FEATURES]
    + [T.StructField(HEALTH_TARGET, T.DoubleType())]
)

# --- fixed values: time series ------------------------------------------------
LAGS = [1, 7, 24]
ROLLING_WINDOWS = [24, 168]
LOOK_BACK = 24
TEST_FRACTION = 0.2
CV_FOLDS = 5
SEED = 42
TARGET_COVERAGE = 0.7

# --- fixed values: validation -------------------------------------------------
# pollutant -> (largest typical value, unit)
POLLUTANT_LIMITS = {
    "CO": (30.0, "mg/m³"),
    "NO2": (400.0, "µg/m³"),
    "SO2": (500.0, "µg/m³"),
    "O3": (300.0, "µg/m³"),
    "PM2.5": (500.0, "µg/m³"),
    "PM10": (600.0, "µg/m³"),
}
TRENDS = ["improving", "stable", "worsening"]

# --- fixed values: risk -------------------------------------------------------
AQI_REFERENCE = 150.0
RISK_WEIGHTS = {
    "pollution_factor": 0.4,
    "health_impact_factor": 0.3,
    "industrial_factor": 0.2,
    "trend_factor": 0.1,
}
INDUSTRIAL_SCORE = 40.0
RESIDENTIAL_SCORE = 10.0
TREND_SCORES = {"improving": 30.0, "stable": 50.0, "worsening": 80.0}
# the order matters for the substring stage
HEALTH_SCORES = {
    "0": 20.0, "1": 40.0, "2": 60.0, "3": 80.0, "4": 100.0,
    "Low": 20.0, "Moderate": 40.0, "High": 60.0, "Severe": 80.0, "Very High": 100.0,
}
HEALTH_DEFAULT_SCORE = 50.0
HEALTH_CLASS_NAMES = {0: "Very High", 1: "Moderate", 2: "Low", 3: "High", 4: "Severe"}
# level -> (low, high, colour), both ends inclusive
RISK_BANDS = {
    "Safe": (0, 25, "#22c55e"),
    "Caution": (26, 50, "#eab308"),
    "Alert": (51, 75, "#f97316"),
    "Critical": (76, 100, "#ef4444"),
}
# severity -> [low, high)
SEVERITY_BANDS = {"Low": (0, 50), "Moderate": (50, 100), "High": (100, 150), "Severe": (150, 999)}

# --- fixed values: documents and retrieval ------------------------------------
DOCUMENT_SUFFIXES = ["pdf", "docx", "txt"]
CHUNK_SIZE = 500
CHUNK_OVERLAP = 100
EMBEDDING_DIM = 384
TOP_K = 3
SIMILARITY_THRESHOLD = 0.30
MAX_CONTEXT_CHARS = 2500
REDUCED_TOP_K = 2
REDUCED_CONTEXT_CHARS = 1200
CONFIDENCE_HIGH = 0.65
CONFIDENCE_MEDIUM = 0.40
EXCERPT_CHARS = 200
FINGERPRINT_CHARS = 120
