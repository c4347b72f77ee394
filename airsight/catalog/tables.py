"""Queries over sensor, feature and document tables: cleaning, validation, profiles, time series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airsight import config as cfg
from airsight.catalog.adapters import TABLES, adapter, load
from airsight.catalog.registry import dec, query, snap, sql
from airsight.functions import validation
from airsight.operators import cleaning, profile, splits, timeseries
from airsight.operators.corpus import chunk_documents, document_record, manifest_diff, supported
from airsight.operators.ordered import groups_fit, row_numbers
from airsight.sources.tables import read_or_none

KEY4 = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
K4 = ", ".join(KEY4)
FEATURES = ["f1", "f2", "f3", "f4", "f5"]
WS = r"\s\x0b\x1c-\x1f\x{85}\pZ"  # the oracle engine's spelling of Unicode white space

CLEAN = "clean AS (SELECT series_id, ts, event_id, nullif(reading, -200) AS reading FROM readings)"
FILLED = (
    "filled AS (SELECT series_id, ts, event_id, coalesce(reading, (SELECT median(reading) FROM clean)) AS reading FROM clean)"
)


def filled_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = cleaning.sentinel_to_null(adapter(spark, sf_dir, "readings"), ["reading"])
    return cleaning.impute_medians(clean, ["reading"])


# --- sources and tables -------------------------------------------------------


@query("dataset_audit", "\nUNION ALL\n".join(
    [f"SELECT '{t}' AS dataset, true AS available, (SELECT count(*) FROM {t}) AS n_rows, "
     f"(SELECT count(*) FROM pragma_table_info('{t}')) AS n_columns, "
     f"(SELECT string_agg(name, ',' ORDER BY cid) FROM pragma_table_info('{t}')) AS columns, CAST(NULL AS VARCHAR) AS error"
     for t in TABLES]
    + ["SELECT 'absent', false, NULL, NULL, NULL, 'not found'"]
))
def dataset_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.dataset_audit({t: read_or_none(spark, f"{sf_dir}/{t}.parquet") for t in [*TABLES, "absent"]})


@query("drop_all_null_cols", sql(f"SELECT {K4}, f1, f2, label FROM features", "features"))
def drop_all_null_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = adapter(spark, sf_dir, "features").select(
        *KEY4, "f1", "f2", "label", F.lit(None).cast("double").alias("empty"), F.lit(1).alias("Unnamed: 15")
    )
    return cleaning.drop_all_null_columns(wide)


@query("document_scan", sql(
    "SELECT doc_id, filename, category, sha256(text) AS hash, CAST(strlen(text) AS INTEGER) AS size FROM files", "files"
))
def document_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = adapter(spark, sf_dir, "files").withColumn("path", F.concat_ws("/", "category", "filename"))
    record = document_record(F.col("path"), F.col("text").cast("binary"))
    return docs.filter(supported(F.col("path"))).select("doc_id", *[c.alias(n) for n, c in record.items()])


MANIFESTS = (
    "old AS (SELECT doc_id, sha256(CASE WHEN lang = 'fr' THEN 'stale' ELSE text END) AS hash FROM files WHERE lang <> 'es')",
    "new AS (SELECT doc_id, sha256(text) AS hash FROM files WHERE lang <> 'de')",
)


@query("manifest_diff", sql(
    """SELECT coalesce(old.doc_id, new.doc_id) AS doc_id, old.hash AS old_hash, new.hash AS new_hash,
              CASE WHEN old.hash IS NULL THEN 'added' WHEN new.hash IS NULL THEN 'removed'
                   WHEN old.hash <> new.hash THEN 'changed' ELSE 'same' END AS status
       FROM old FULL OUTER JOIN new ON old.doc_id = new.doc_id""",
    "files", *MANIFESTS,
))
def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = adapter(spark, sf_dir, "files")
    before = F.when(F.col("lang") == "fr", "stale").otherwise(F.col("text"))
    old = docs.filter("lang <> 'es'").select("doc_id", F.sha2(before, 256).alias("hash"))
    new = docs.filter("lang <> 'de'").select("doc_id", F.sha2("text", 256).alias("hash"))
    return manifest_diff(old, new, key="doc_id")


CHUNKS = rf"""chunks AS (
    SELECT doc_id, filename, category, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS chunk_index, chunk
    FROM (SELECT doc_id, filename, category, pos,
                 regexp_replace(substring(text, CAST(pos + 1 AS INTEGER), 500), '^[{WS}]+|[{WS}]+$', '', 'g') AS chunk
          FROM (SELECT *, unnest(range(0, length(text), 400)) AS pos FROM files))
    WHERE chunk <> '')"""


@query("chunk_documents", sql(
    """SELECT doc_id, filename AS source, category, chunk_index, chunk AS text,
              concat(filename, '_chunk_', CAST(chunk_index AS VARCHAR)) AS chunk_id FROM chunks""",
    "files", CHUNKS,
))
def chunk_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_documents(adapter(spark, sf_dir, "files").drop("lang"))


@query("corpus_status", sql(
    """SELECT (SELECT count(*) FROM files) AS documents, (SELECT count(DISTINCT category) FROM files) AS categories,
              count(*) AS chunks, count(*) > 0 AS ready FROM chunks""",
    "files", CHUNKS,
))
def corpus_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = adapter(spark, sf_dir, "files")
    return profile.corpus_status(files, chunk_documents(files))


# --- cleaning -----------------------------------------------------------------


@query("project_drop_null", sql(f"SELECT {K4}, f1, f2, label FROM features WHERE f1 IS NOT NULL AND f2 IS NOT NULL", "features"))
def project_drop_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.project_complete(adapter(spark, sf_dir, "features"), [*KEY4, "f1", "f2", "label"])


@query("sentinel_to_null", sql("SELECT * FROM clean", "readings", CLEAN))
def sentinel_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.sentinel_to_null(adapter(spark, sf_dir, "readings"), ["reading"])


@query("median_impute_global", sql("SELECT * FROM filled", "readings", CLEAN, FILLED))
def median_impute_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filled_readings(spark, sf_dir)


@query("median_impute_fitted", sql(
    f"""SELECT {K4}, coalesce(f1, (SELECT median(f1) FROM features WHERE label <> 'N')) AS f1
        FROM features WHERE label = 'N'""",
    "features",
))
def median_impute_fitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = adapter(spark, sf_dir, "features")
    train, test = features.filter("label <> 'N'"), features.filter("label = 'N'")
    return cleaning.impute_medians(test.select(*KEY4, "f1"), ["f1"], fit_on=train)


@query("class_code_decode", sql(
    """SELECT record_id, class_code, CASE CAST(class_code AS INTEGER) WHEN 0 THEN 'Very High' WHEN 1 THEN 'Moderate'
              WHEN 2 THEN 'Low' WHEN 3 THEN 'High' WHEN 4 THEN 'Severe' END AS label
       FROM health WHERE class_code < 5""",
    "health",
))
def class_code_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.decode_classes(adapter(spark, sf_dir, "health"), "class_code", "label").select(
        "record_id", "class_code", "label"
    )


@query("parse_datetime_sort", sql(
    """SELECT event_id, dt AS "DateTime", row_number() OVER (ORDER BY dt, event_id) AS rn
       FROM (SELECT event_id, try_strptime(concat(d, ' ', t), '%d/%m/%Y %H:%M:%S') AS dt FROM dated) WHERE dt IS NOT NULL""",
    "dated",
))
def parse_datetime_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = cleaning.parse_timestamps(adapter(spark, sf_dir, "dated"), "d", "t")
    return row_numbers(parsed.select("event_id", "DateTime"), [], ["DateTime", "event_id"])


@query("default_missing_features", sql(
    "SELECT record_id, aqi AS \"AQI\", humidity AS \"Humidity\", temperature AS \"Temperature\", "
    + ", ".join(f'CAST(0 AS DOUBLE) AS "{c}"' for c in cfg.HEALTH_FEATURES if c not in ("AQI", "Humidity", "Temperature"))
    + " FROM health",
    "health",
))
def default_missing_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = adapter(spark, sf_dir, "health").select(
        "record_id", F.col("aqi").alias("AQI"), F.col("humidity").alias("Humidity"), F.col("temperature").alias("Temperature")
    )
    return cleaning.with_default_features(given, cfg.HEALTH_FEATURES)


@query("target_coverage", sql(
    f"""SELECT target, preference, coverage, coverage >= 0.7 AS usable FROM (
          SELECT 'f1' AS target, 1 AS preference, {dec('count(f1) / count(*)', 6)} AS coverage FROM features
          UNION ALL SELECT 'f5', 2, {dec('count(f5) / count(*)', 6)} FROM features)""",
    "features",
))
def target_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cleaning.target_coverage(adapter(spark, sf_dir, "features"), ["f1", "absent", "f5"])
    return found.select(
        "target", "preference", snap("coverage", 6).alias("coverage"), (F.col("coverage") >= cfg.TARGET_COVERAGE).alias("usable")
    )


# --- validation ---------------------------------------------------------------


def _pollutant_message(column: str, name: str) -> str:
    top, unit = cfg.POLLUTANT_LIMITS[name]
    number = f"try_cast({column} AS DOUBLE)"
    return (
        f"CASE WHEN {column} IS NULL THEN 'Missing required pollutant: {name}' "
        f"WHEN {number} IS NULL THEN concat('''{name}'' must be a number, got: ', {column}) "
        f"WHEN {number} < 0 THEN concat('''{name}'' must be ≥ 0, got: ', printf('%.2f', {number})) "
        f"WHEN {number} > {2 * top} THEN concat('⚠️ {name} value ', printf('%.1f', {number}), ' seems unusually high. Typical max: {top} {unit}') END"
    )


POLLUTANT_COLUMNS = {"CO": "co", "NO2": "no2", "SO2": "so2", "O3": "o3", "PM2.5": "pm2_5", "PM10": "pm10"}
POLLUTANT_ERRORS = (
    "checked AS (SELECT o_orderkey, list_filter(["
    + ", ".join(_pollutant_message(c, n) for n, c in POLLUTANT_COLUMNS.items())
    + "], lambda x: x IS NOT NULL) AS errors FROM pollutants)"
)


def checked_pollutants(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = adapter(spark, sf_dir, "pollutants")
    return validation.check_pollutants(inputs, POLLUTANT_COLUMNS).select("o_orderkey", "errors")


@query("validate_pollutants", sql(
    "SELECT o_orderkey, len(errors) = 0 AS ok, array_to_string(errors, ' | ') AS errors FROM checked", "pollutants", POLLUTANT_ERRORS
))
def validate_pollutants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked_pollutants(spark, sf_dir).select(
        "o_orderkey", (F.size("errors") == 0).alias("ok"), F.array_join("errors", " | ").alias("errors")
    )


@query("format_errors", sql(
    """SELECT o_orderkey, CASE len(errors) WHEN 0 THEN '' WHEN 1 THEN concat('❌ ', errors[1])
              ELSE concat('❌ Please fix the following issues:', chr(10), '  • ', array_to_string(errors, concat(chr(10), '  • '))) END AS message
       FROM checked""",
    "pollutants", POLLUTANT_ERRORS,
))
def format_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked_pollutants(spark, sf_dir).select("o_orderkey", validation.format_errors(F.col("errors")).alias("message"))


def _health_message(name: str) -> str:
    column = {"AQI": "aqi", "Humidity": "humidity", "Temperature": "temperature"}.get(name)
    if column is None:
        return f"'Missing required field: {name}'"
    return f"CASE WHEN {column} < 0 THEN concat('''{name}'' must be ≥ 0, got: ', printf('%.2f', {column})) END"


@query("validate_health", sql(
    "SELECT record_id, concat_ws(' | ', " + ", ".join(_health_message(n) for n in cfg.HEALTH_FEATURES) + """,
        CASE WHEN aqi > 500 THEN 'AQI must be between 0 and 500' END,
        CASE WHEN humidity NOT BETWEEN 0 AND 100 THEN concat('Humidity must be between 0% and 100%, got: ', printf('%.1f', humidity)) END,
        CASE WHEN temperature NOT BETWEEN -50 AND 60 THEN concat('Temperature must be between -50°C and 60°C, got: ', printf('%.1f', temperature)) END
    ) AS errors FROM health""",
    "health",
))
def validate_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = {"AQI": "aqi", "Humidity": "humidity", "Temperature": "temperature"}
    checked = validation.check_health(adapter(spark, sf_dir, "health"), given)
    return checked.select("record_id", F.array_join("errors", " | ").alias("errors"))


@query("validate_risk_inputs", sql(
    f"""SELECT area_id, concat_ws(' | ',
          CASE WHEN pollution_level < 0 THEN concat('''pollution_level'' must be ≥ 0, got: ', printf('%.2f', {dec('pollution_level', 2)})) END,
          CASE WHEN trend NOT IN ('improving', 'stable', 'worsening') THEN
               concat('trend must be ''improving'', ''stable'', or ''worsening'', got: ', trend) END) AS errors
        FROM areas""",
    "areas",
))
def validate_risk_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = validation.risk_input_errors(F.col("pollution_level"), F.col("city_type"), F.col("trend"))
    return adapter(spark, sf_dir, "areas").select("area_id", F.array_join(errors, " | ").alias("errors"))


# --- profiles -----------------------------------------------------------------


@query("class_distribution", sql(
    f"SELECT label, count(*) AS n, {dec('count(*) * 100.0 / sum(count(*)) OVER ()', 4)} AS percent FROM features GROUP BY label", "features"
))
def class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.class_distribution(adapter(spark, sf_dir, "features"), "label")


@query("dataset_summary", sql(
    f"""SELECT count(*) AS n_rows, CAST(10 AS BIGINT) AS n_columns, count(*) - count(f1) AS missing_total,
               {dec('(count(*) - count(f1)) * 100.0 / (count(*) * 10)', 2)} AS missing_pct FROM features""",
    "features",
))
def dataset_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.dataset_summary(adapter(spark, sf_dir, "features"))


@query("missing_by_column", sql('SELECT \'f1\' AS "column", count(*) - count(f1) AS missing FROM features', "features"))
def missing_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.missing_by_column(adapter(spark, sf_dir, "features"))


def _pair(x: str, y: str) -> str:
    both = f"FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"
    r = f"covar_pop({x}, {y}) / nullif(stddev_pop({x}) {both} * stddev_pop({y}) {both}, 0)"
    return f"SELECT '{x}' AS x, '{y}' AS y, {dec(r, 6)} AS r FROM features"


@query("correlation_matrix", sql("\nUNION ALL ".join(_pair(x, y) for x in FEATURES for y in FEATURES), "features"))
def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.correlation_matrix(adapter(spark, sf_dir, "features"), FEATURES).withColumn("r", snap("r", 6))


BOX = {"min": 0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1}


@query("box_stats", sql(
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, " + ", ".join(f"{dec(f'quantile_cont({c}, {q})', 6)} AS \"{n}\"" for n, q in BOX.items()) + " FROM features"
        for c in FEATURES
    ),
    "features",
))
def box_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.box_stats(adapter(spark, sf_dir, "features"), FEATURES)
    return found.select("feature", *[snap(c, 6).alias(c) for c in BOX])


@query("residual_histogram", sql(
    f"""SELECT CAST(b.bin AS BIGINT) AS bin, {dec('lo + b.bin * (hi - lo) / 60', 4)} AS bin_low, {dec('lo + (b.bin + 1) * (hi - lo) / 60', 4)} AS bin_high,
               coalesce(c.n, 0) AS n
        FROM (SELECT unnest(range(60)) AS bin) b CROSS JOIN lim
        LEFT JOIN (SELECT least(floor((r - lo) / (hi - lo) * 60), 59) AS bin, count(*) AS n FROM res, lim GROUP BY 1) c ON c.bin = b.bin""",
    "forecasts", "res AS (SELECT y_true - y_pred AS r FROM forecasts)", "lim AS (SELECT min(r) AS lo, max(r) AS hi FROM res)",
))
def residual_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = profile.residual_histogram(adapter(spark, sf_dir, "forecasts"), "y_true", "y_pred")
    return bins.withColumns({c: snap(c, 4) for c in ("bin_low", "bin_high")})


@query("actual_vs_predicted", sql(
    f"""SELECT model_name, o_orderkey, rn, y_true, {dec('y_pred', 4)} AS y_pred, {dec('y_true - y_pred', 4)} AS residual,
               {dec('axis_min', 4)} AS axis_min, {dec('axis_max', 4)} AS axis_max
        FROM (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY o_orderdate, o_orderkey) AS rn FROM forecasts),
             (SELECT least(min(y_true), min(y_pred)) AS axis_min, greatest(max(y_true), max(y_pred)) AS axis_max FROM forecasts)
        WHERE rn <= 500""",
    "forecasts",
))
def actual_vs_predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    forecasts = adapter(spark, sf_dir, "forecasts")
    points = profile.first_points(forecasts, ["model_name"], ["o_orderdate", "o_orderkey"], "y_true", "y_pred")
    axis = profile.axis_range(forecasts, "y_true", "y_pred").first()
    return points.select(
        "model_name", "o_orderkey", "rn", "y_true", snap("y_pred", 4).alias("y_pred"), snap("residual", 4).alias("residual"),
        snap(F.lit(axis["axis_min"]), 4).alias("axis_min"), snap(F.lit(axis["axis_max"]), 4).alias("axis_max"),
    )


@query("top_n_importance", sql(
    f"""SELECT feature, importance FROM (
          SELECT concat('supplier_', CAST(l_suppkey AS VARCHAR)) AS feature, {dec('sum(l_extendedprice) / (SELECT sum(l_extendedprice) FROM lineitem)', 6)} AS importance
          FROM lineitem GROUP BY l_suppkey) ORDER BY importance DESC, feature LIMIT 10"""
))
def top_n_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = load(spark, sf_dir, "lineitem")
    sums = lineitem.groupBy("l_suppkey").agg(F.sum("l_extendedprice").alias("s"))
    total = lineitem.agg(F.sum("l_extendedprice").alias("t")).scalar()
    shares = sums.select(
        F.concat(F.lit("supplier_"), F.col("l_suppkey").cast("string")).alias("feature"), snap(F.col("s") / total, 6).alias("importance")
    )
    return profile.top_importances(shares, "feature", "importance", 10)


@query("cv_summary", sql(
    f"""SELECT model_name, {dec('avg(score)', 4)} AS cv_mean, {dec('stddev_pop(score)', 4)} AS cv_std FROM (
          SELECT o_orderstatus AS model_name, CAST(floor((rn - 1) * 5 / n) AS BIGINT) AS fold, {dec('avg(CASE WHEN y_pred > y_true THEN 1.0 ELSE 0.0 END)', 6)} AS score
          FROM (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY (o_orderkey * 7919) % 10007, o_orderkey) AS rn,
                       count(*) OVER (PARTITION BY model_name) AS n FROM forecasts) GROUP BY 1, 2) GROUP BY model_name""",
    "forecasts",
))
def cv_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = splits.stratified_folds(
        adapter(spark, sf_dir, "forecasts"), "model_name", "o_orderkey", order=(F.col("o_orderkey") * 7919) % 10007
    )
    hit = F.when(F.col("y_pred") > F.col("y_true"), 1.0).otherwise(0.0)
    scores = folded.groupBy(F.col("o_orderstatus").alias("model_name"), "fold").agg(snap(F.avg(hit), 6).alias("score"))
    return profile.cv_summary(scores, "score", ["model_name"])


# --- time series --------------------------------------------------------------

W = "OVER (PARTITION BY series_id ORDER BY ts, event_id"


def _roll(n: int) -> str:
    frame = f"{W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return (
        f"{dec(f'avg(reading) {frame}', 6)} AS reading_roll_mean_{n}, max(reading) {frame} AS reading_roll_max_{n}, "
        f"min(reading) {frame} AS reading_roll_min_{n}"
    )


LAGS = ", ".join(f"lag(reading, {n}) {W}) AS reading_lag_{n}" for n in cfg.LAGS)
CALENDAR = "CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, CAST(month(ts) AS INTEGER) AS month"


def _rounded_means(df: DataFrame) -> DataFrame:
    return df.withColumns({f"reading_roll_mean_{n}": snap(f"reading_roll_mean_{n}", 6) for n in cfg.ROLLING_WINDOWS})


@query("lag_features", sql(f"SELECT *, {LAGS} FROM clean", "readings", CLEAN))
def lag_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeseries.lag_features(sentinel_to_null(spark, sf_dir), ["series_id"], ["ts", "event_id"], "reading")


@query("rolling_features", sql(f"SELECT *, {_roll(24)}, {_roll(168)} FROM clean", "readings", CLEAN))
def rolling_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = timeseries.rolling_features(sentinel_to_null(spark, sf_dir), ["series_id"], ["ts", "event_id"], "reading")
    return _rounded_means(rolled)


@query("centered_moving_avg", sql(
    f"""SELECT *, CASE WHEN count(reading) {W} ROWS BETWEEN 84 PRECEDING AND 83 FOLLOWING) = 168
                  THEN {dec(f'avg(reading) {W} ROWS BETWEEN 84 PRECEDING AND 83 FOLLOWING)', 6)} END AS moving_avg FROM filled""",
    "readings", CLEAN, FILLED,
))
def centered_moving_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = timeseries.centered_moving_average(filled_readings(spark, sf_dir), ["series_id"], ["ts", "event_id"], "reading")
    return series.withColumn("moving_avg", snap("moving_avg", 6))


@query("time_features", sql(f"SELECT *, {CALENDAR} FROM readings", "readings"))
def time_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeseries.calendar_features(adapter(spark, sf_dir, "readings"), "ts")


SPLIT = f"""split AS (SELECT series_id, ts, event_id, reading,
    CASE WHEN rn <= train - floor(train * 0.1) THEN 'train' WHEN rn <= train THEN 'validation' ELSE 'test' END AS part
    FROM (SELECT *, row_number() {W}) AS rn, floor(count(*) OVER (PARTITION BY series_id) * 0.8) AS train FROM filled))"""


GAPPY = """gappy AS (SELECT CASE WHEN event_id % 13 = 0 THEN NULL ELSE series_id END AS series_id,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE ts END AS ts, event_id, reading FROM filled)"""


@query("time_split", sql(
    "SELECT * FROM split", "readings", CLEAN, FILLED, GAPPY,
    SPLIT.replace("FROM filled", "FROM gappy").replace("ORDER BY ts, event_id", "ORDER BY ts NULLS FIRST, event_id"),
))
def time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absent series and times take part."""
    gappy = filled_readings(spark, sf_dir).withColumns({
        "series_id": F.when(F.col("event_id") % 13 != 0, F.col("series_id")), "ts": F.when(F.col("event_id") % 11 != 0, F.col("ts")),
    })
    return timeseries.time_split(gappy, ["series_id"], "ts", "event_id", validation_fraction=0.1)


@query("lookback_sequences", sql(
    f"""SELECT series_id, event_id, reading, part, array_to_string(seq, ',') AS sequence
        FROM (SELECT *, list(CAST(reading AS VARCHAR)) {W} ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS seq FROM split)
        WHERE len(seq) = 24""",
    "readings", CLEAN, FILLED, SPLIT,
))
def lookback_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    fits = groups_fit(adapter(spark, sf_dir, "readings"), ["series_id"])
    split = timeseries.time_split(filled_readings(spark, sf_dir), ["series_id"], "ts", "event_id", validation_fraction=0.1, fits=fits)
    sequences = timeseries.lookback_sequences(split, ["series_id"], ["ts", "event_id"], ["reading"], fits=fits)
    steps = F.transform("sequence", lambda s: s["reading"].cast("string"))
    return sequences.select("series_id", "event_id", "reading", "part", F.array_join(steps, ",").alias("sequence"))


@query("aq_feature_table", sql(
    f"SELECT * FROM (SELECT *, {LAGS}, {_roll(24)}, {_roll(168)}, {CALENDAR} FROM filled) WHERE reading_lag_24 IS NOT NULL",
    "readings", CLEAN, FILLED,
))
def aq_feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    fits = groups_fit(adapter(spark, sf_dir, "readings"), ["series_id"])
    table = timeseries.feature_table(filled_readings(spark, sf_dir), ["series_id"], "ts", ["event_id"], "reading", fits=fits)
    return _rounded_means(table)


# --- scaling, encoding, splits ------------------------------------------------

SCALED = ["f1", "f2", "f5"]


@query("standardize", sql(
    f"SELECT {K4}, " + ", ".join(
        dec(f"({c} - (SELECT avg({c}) FROM features)) / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END FROM features)", 6) + f" AS {c}"
        for c in SCALED
    ) + " FROM features",
    "features",
))
def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = adapter(spark, sf_dir, "features").select(*KEY4, *SCALED)
    return cleaning.fit_standard(table, SCALED).transform(table).withColumns({c: snap(c, 6) for c in SCALED})


@query("minmax_scale", sql(
    f"SELECT {K4}, " + ", ".join(
        dec(f"({c} - (SELECT min({c}) FROM features)) / (SELECT CASE WHEN max({c}) = min({c}) THEN 1 ELSE max({c}) - min({c}) END FROM features)", 6) + f" AS {c}"
        for c in SCALED
    ) + " FROM features",
    "features",
))
def minmax_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = adapter(spark, sf_dir, "features").select(*KEY4, *SCALED)
    return cleaning.fit_min_max(table, SCALED).transform(table).withColumns({c: snap(c, 6) for c in SCALED})


@query("minmax_scale_inverse", sql(
    "SELECT " + ", ".join(["o_orderkey", *[f"{dec(c, 4)} AS {c}" for c in ("predicted", "actual")]]) + " FROM (" +
    "SELECT o_orderkey, y_pred AS predicted, y_true AS actual FROM forecasts WHERE y_pred IS NOT NULL AND y_true IS NOT NULL)",
    "forecasts",
))
def minmax_scale_inverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values scaled to 0 to 1 and back."""
    rows = adapter(spark, sf_dir, "forecasts").select("o_orderkey", F.col("y_pred").alias("predicted"), F.col("y_true").alias("actual"))
    scaler = cleaning.fit_min_max(rows, ["predicted", "actual"])
    return scaler.inverse(scaler.transform(rows)).withColumns({c: snap(c, 4) for c in ("predicted", "actual")})



@query("label_encode", sql(
    f"SELECT {K4}, label, dense_rank() OVER (ORDER BY label) - 1 AS label_index FROM features", "features"
))
def label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = adapter(spark, sf_dir, "features").select(*KEY4, "label")
    return cleaning.encode_labels(table, "label", cleaning.fit_labels(table, "label"), "label_index")


HASHED = """hashed AS (SELECT o_orderkey, label, row_number() OVER (PARTITION BY label ORDER BY (o_orderkey * 7919) % 10007, o_orderkey) AS rn,
    count(*) OVER (PARTITION BY label) AS n FROM labelled)"""
QUOTAS = (
    "shares AS (SELECT label, count(*) AS n, sum(count(*)) OVER () AS total, ceil(sum(count(*)) OVER () * 0.2) AS test FROM labelled GROUP BY label)",
    "floors AS (SELECT label, floor(n * test / total) AS base, test, row_number() OVER "
    "(ORDER BY n * test / total - floor(n * test / total) DESC, label NULLS FIRST) AS place FROM shares)",
    "quotas AS (SELECT label, base + CASE WHEN place <= test - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM floors)",
)


def labelled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter(spark, sf_dir, "labelled")


@query("stratified_split", sql(
    "SELECT o_orderkey, hashed.label, CASE WHEN rn <= quota THEN 'test' ELSE 'train' END AS part FROM hashed JOIN quotas "
    "ON hashed.label IS NOT DISTINCT FROM quotas.label",
    "labelled", HASHED, *QUOTAS,
))
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = (F.col("o_orderkey") * 7919) % 10007
    return splits.stratified_split(labelled_orders(spark, sf_dir), "label", "o_orderkey", order=order)


@query("stratified_folds", sql(
    "SELECT o_orderkey, label, CAST(floor((rn - 1) * 5 / n) AS BIGINT) AS fold FROM hashed", "labelled", HASHED
))
def stratified_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = (F.col("o_orderkey") * 7919) % 10007
    return splits.stratified_folds(labelled_orders(spark, sf_dir), "label", "o_orderkey", order=order)
