"""Queries over predictions: metrics, curves, comparisons, logs and training histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airsight.catalog.adapters import adapter
from airsight.catalog.registry import dec, query, snap, sql
from airsight.functions.prediction import prediction_record as record_of
from airsight.functions.prediction import probability_percent as percent_of
from airsight.functions.vectors import argmax, softmax
from airsight.operators import comparison, metrics
from airsight.operators.profile import cv_summary
from airsight.session import stage
from airsight.sources.logs import parse_records

CLASSES = range(5)
WEIGHTS = [f"w{k}" for k in CLASSES]
TOP = f"greatest({', '.join(WEIGHTS)})"

VOTED = (
    "voted AS (SELECT o_orderkey, o_orderstatus AS model_name, y_true, CASE "
    + " ".join(f"WHEN w{k} = {TOP} THEN {k}" for k in CLASSES)
    + f" END AS y_pred, {' + '.join(WEIGHTS)} AS total, " + ", ".join(WEIGHTS) + " FROM votes)"
)
LONG = (
    "long AS (" + " UNION ALL ".join(
        f"SELECT model_name, {k} AS cls, y_true = {k} AS positive, w{k} / CAST(total AS DOUBLE) AS p FROM voted" for k in CLASSES
    ) + ")"
)


def voted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per prediction with the class probabilities as an array."""
    votes = adapter(spark, sf_dir, "votes")
    total = sum((F.col(w) for w in WEIGHTS[1:]), F.col(WEIGHTS[0]))
    shares = F.array(*[F.col(w) / total.cast("double") for w in WEIGHTS])
    scored = votes.select("o_orderkey", F.col("o_orderstatus").alias("model_name"), "y_true", shares.alias("probabilities"))
    first_best = F.array_position("probabilities", F.array_max("probabilities")) - 1
    return scored.withColumn("y_pred", first_best.cast("int"))


def by_class(predictions: DataFrame) -> DataFrame:
    """One row per prediction and class: is it the true class, and its score."""
    return predictions.select("model_name", "y_true", F.posexplode_outer("probabilities").alias("cls", "p")).select(
        "model_name", "cls", (F.col("y_true") == F.col("cls")).alias("positive"), "p"
    )


# --- regression ---------------------------------------------------------------


def _regression_sql(source: str, digits: int = 4, mape_digits: int = 2) -> str:
    return f"""SELECT model_name, {dec('sqrt(avg((y_true - y_pred) * (y_true - y_pred)))', digits)} AS rmse,
        {dec('avg(abs(y_true - y_pred))', digits)} AS mae, {dec('avg((y_true - y_pred) * (y_true - y_pred))', digits)} AS mse,
        {dec('1 - avg((y_true - y_pred) * (y_true - y_pred)) / var_pop(y_true)', digits)} AS r2,
        {dec('100 * avg(CASE WHEN y_true <> 0 THEN abs((y_true - y_pred) / y_true) END)', mape_digits)} AS mape
        FROM {source} GROUP BY model_name"""


@query("regression_metrics", sql(_regression_sql("forecasts"), "forecasts"))
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.regression_metrics(adapter(spark, sf_dir, "forecasts"), "y_true", "y_pred", ["model_name"])


@query("regression_metrics_precise", sql(_regression_sql("forecasts", 6, 4), "forecasts"))
def regression_metrics_precise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the digits of a sequence model's report."""
    return metrics.regression_metrics(adapter(spark, sf_dir, "forecasts"), "y_true", "y_pred", ["model_name"], digits=6, mape_digits=4)


@query("softmax_of_votes", sql(
    "SELECT o_orderkey, " + ", ".join(f"{dec(f'exp((w{k} - {TOP}) / 10.0::DOUBLE) / total', 6)} AS p{k}" for k in CLASSES) + ", top FROM ("
    + f"SELECT *, {' + '.join(f'exp((w{k} - {TOP}) / 10.0::DOUBLE)' for k in CLASSES)} AS total, y_pred AS top FROM (SELECT o_orderkey, y_pred, "
    + ", ".join(WEIGHTS) + " FROM voted))",
    "votes", VOTED,
))
def softmax_of_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities and class of raw scores."""
    raw = adapter(spark, sf_dir, "votes").select("o_orderkey", F.array(*[F.col(w) / F.lit(10.0) for w in WEIGHTS]).alias("raw"))
    shares = raw.select("o_orderkey", softmax(F.col("raw")).alias("p"), argmax(F.col("raw")).cast("int").alias("top"))
    return shares.select("o_orderkey", *[snap(F.col("p")[k], 6).alias(f"p{k}") for k in CLASSES], "top")


# --- classification -----------------------------------------------------------


def _class_ctes(by: str) -> tuple[str, ...]:
    keys = f"{by}, " if by else ""
    on = f"a.{by} = b.{by} AND " if by else ""
    return (
        f"labels AS (SELECT {keys}y_true AS label FROM voted UNION SELECT {keys}y_pred FROM voted)",
        f"""per AS (SELECT {'a.' + keys if by else ''}a.label, count(CASE WHEN b.y_true = a.label AND b.y_pred = a.label THEN 1 END) AS tp,
              count(CASE WHEN b.y_true = a.label THEN 1 END) AS support, count(CASE WHEN b.y_pred = a.label THEN 1 END) AS called
              FROM labels a JOIN voted b ON {on}(b.y_true = a.label OR b.y_pred = a.label) GROUP BY ALL)""",
        f"""rates AS (SELECT *, CASE WHEN called > 0 THEN tp / called ELSE 0 END AS p,
              CASE WHEN support > 0 THEN tp / support ELSE 0 END AS r FROM per)""",
        "scores AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM rates)",
    )


WEIGHTED = {c: f"sum({e} * support) / sum(support)" for c, e in {"precision": "p", "recall": "r", "f1": "f"}.items()}
METRICS_SQL = (
    f"SELECT model_name, {dec('sum(tp) / sum(support)', 4)} AS accuracy, "
    + ", ".join(f"{dec(e, 4)} AS {c}_weighted" for c, e in WEIGHTED.items())
    + " FROM scores GROUP BY model_name"
)


@query("classification_metrics", sql(METRICS_SQL, "votes", VOTED, *_class_ctes("model_name")))
def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.classification_metrics(voted(spark, sf_dir), "y_true", "y_pred", ["model_name"])


@query("confusion_matrix", sql(
    """SELECT a.label AS y_true, b.label AS y_pred, count(v.o_orderkey) AS n
       FROM labels a CROSS JOIN labels b LEFT JOIN voted v ON v.y_true = a.label AND v.y_pred = b.label GROUP BY 1, 2""",
    "votes", VOTED, _class_ctes("")[0],
))
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_matrix(voted(spark, sf_dir), "y_true", "y_pred")


def _report_row(label: str, p: str, r: str, f: str, support: str) -> str:
    return f"SELECT '{label}' AS label, {dec(p, 6)} AS precision, {dec(r, 6)} AS recall, {dec(f, 6)} AS f1, {dec(support, 6)} AS support FROM scores"


ACCURACY = "sum(tp) / sum(support)"


@query("classification_report", sql(
    f"""SELECT CAST(label AS VARCHAR) AS label, {dec('p', 6)} AS precision, {dec('r', 6)} AS recall, {dec('f', 6)} AS f1, {dec('support', 6)} AS support FROM scores
        UNION ALL {_report_row('accuracy', ACCURACY, ACCURACY, ACCURACY, ACCURACY)}
        UNION ALL {_report_row('macro avg', 'avg(p)', 'avg(r)', 'avg(f)', 'sum(support)')}
        UNION ALL {_report_row('weighted avg', *WEIGHTED.values(), 'sum(support)')}""",
    "votes", VOTED, *_class_ctes(""),
))
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = metrics.classification_report(voted(spark, sf_dir), "y_true", "y_pred")
    return report.select("label", *[snap(c, 6).alias(c) for c in ("precision", "recall", "f1", "support")])


AUC = (
    "ranks AS (SELECT model_name, cls, positive, rank() OVER w + (count(*) OVER (PARTITION BY model_name, cls, p) - 1) / 2.0 AS r "
    "FROM long WINDOW w AS (PARTITION BY model_name, cls ORDER BY p))",
    "auc AS (SELECT model_name, cls, count(CASE WHEN positive THEN 1 END) AS support, "
    "(sum(CASE WHEN positive THEN r END) - count(CASE WHEN positive THEN 1 END) * (count(CASE WHEN positive THEN 1 END) + 1) / 2) "
    "/ (CAST(count(CASE WHEN positive THEN 1 END) AS DOUBLE) * count(CASE WHEN NOT positive THEN 1 END)) AS auc FROM ranks GROUP BY model_name, cls)",
)


@query("roc_auc_ovr", sql(
    f"""SELECT model_name, cls, support, {dec('auc', 6)} AS auc, {dec('sum(auc * support) OVER (PARTITION BY model_name) / sum(support) OVER (PARTITION BY model_name)', 4)} AS roc_auc
        FROM auc""",
    "votes", VOTED, LONG, *AUC,
))
def roc_auc_ovr(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = metrics.roc_auc_by_class(by_class(voted(spark, sf_dir)), "cls", "positive", "p", ["model_name"])
    return per.join(metrics.weighted_auc(per, ["model_name"]), "model_name").withColumn("auc", snap("auc", 6))


@query("binary_auc", sql(
    f"""SELECT model_name, CASE WHEN pos > 0 AND neg > 0 THEN {dec('(rank_sum - pos * (pos + 1) / 2) / (CAST(pos AS DOUBLE) * greatest(neg, 1))', 4)} END AS roc_auc
        FROM (SELECT model_name, count(CASE WHEN y_true = 1 THEN 1 END) AS pos, count(CASE WHEN y_true = 0 THEN 1 END) AS neg,
                     sum(CASE WHEN y_true = 1 THEN r ELSE 0 END) AS rank_sum
              FROM (SELECT model_name, y_true, rank() OVER w + (count(*) OVER (PARTITION BY model_name, p1) - 1) / 2.0 AS r
                    FROM "binary" WHERE y_true IS NOT NULL WINDOW w AS (PARTITION BY model_name ORDER BY p1)) GROUP BY model_name)""",
    "binary",
).replace("binary AS (", '"binary" AS ('))
def binary_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUC of the positive class per model; unlabelled rows do not count, and a model with one side only has none."""
    rows = adapter(spark, sf_dir, "binary").select("model_name", "p1", F.lit(1).alias("cls"), (F.col("y_true") == 1).alias("positive"))
    return metrics.weighted_auc(metrics.roc_auc_by_class(rows, "cls", "positive", "p1", ["model_name"]), ["model_name"])


ROC = (
    "points AS (SELECT cls, p, count(CASE WHEN positive THEN 1 END) AS pos, count(CASE WHEN NOT positive THEN 1 END) AS neg FROM long GROUP BY cls, p)",
    """cum AS (SELECT cls, pos, neg, sum(pos) OVER w AS tps, sum(neg) OVER w AS fps, row_number() OVER w AS place,
         lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg,
         sum(pos) OVER (PARTITION BY cls) AS np, sum(neg) OVER (PARTITION BY cls) AS nn FROM points WINDOW w AS (PARTITION BY cls ORDER BY p DESC))""",
    """corners AS (SELECT cls, CAST(fps AS DOUBLE) / CAST(nn AS DOUBLE) AS x, CAST(tps AS DOUBLE) / CAST(np AS DOUBLE) AS y FROM cum
         WHERE place = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
         UNION ALL SELECT DISTINCT cls, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM points)""",
    "ends AS (SELECT cls, x, min(y) AS low, max(y) AS high FROM corners GROUP BY cls, x)",
    "grid AS (SELECT DISTINCT x FROM ends)",
    """known AS (SELECT c.cls, g.x, e.low, e.high, CASE WHEN e.x IS NOT NULL THEN g.x END AS hit
         FROM grid g CROSS JOIN (SELECT DISTINCT cls FROM ends) c LEFT JOIN ends e ON e.cls = c.cls AND e.x = g.x)""",
    """around AS (SELECT x, high, last_value(hit IGNORE NULLS) OVER b AS x0, last_value(high IGNORE NULLS) OVER b AS y0,
         first_value(hit IGNORE NULLS) OVER f AS x1, first_value(low IGNORE NULLS) OVER f AS y1 FROM known
         WINDOW b AS (PARTITION BY cls ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                f AS (PARTITION BY cls ORDER BY x ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""",
    "curve AS (SELECT x, avg(CASE WHEN high IS NOT NULL THEN high ELSE y0 + (y1 - y0) * (x - x0) / (x1 - x0) END) AS y FROM around GROUP BY x)",
    "area AS (SELECT sum(a) AS auc FROM (SELECT (x - lag(x) OVER (ORDER BY x)) * (y + lag(y) OVER (ORDER BY x)) / 2 AS a FROM curve))",
)


@query("roc_curve_macro", sql(
    f"SELECT {dec('x', 6)} AS fpr, {dec('y', 6)} AS mean_tpr, (SELECT {dec('auc', 6)} FROM area) AS auc FROM curve",
    "votes", VOTED, LONG, *ROC,
))
def roc_curve_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = metrics.roc_curve_macro(by_class(voted(spark, sf_dir)), "cls", "positive", "p")
    area = metrics.curve_area(curve).first()["auc"]
    return curve.select(snap("fpr", 6).alias("fpr"), snap("mean_tpr", 6).alias("mean_tpr"), snap(F.lit(area), 6).alias("auc"))


@query("prediction_record", sql(
    f"""SELECT o_orderkey, CAST(y_pred AS VARCHAR) AS prediction, {dec(f'{TOP} / CAST(total AS DOUBLE)', 6)} AS confidence, 'ML' AS model_type,
        'votes' AS model_name, """ + ", ".join(f"{dec(f'w{k} / CAST(total AS DOUBLE)', 6)} AS p{k}" for k in CLASSES) + " FROM voted",
    "votes", VOTED,
))
def prediction_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*[F.lit(str(k)) for k in CLASSES])
    rows = voted(spark, sf_dir).select("o_orderkey", record_of(names, F.col("probabilities"), "ML", "votes").alias("r"))
    return rows.select(
        "o_orderkey", "r.prediction", snap("r.confidence", 6).alias("confidence"), "r.model_type", "r.model_name",
        *[snap(F.col("r.probabilities")[str(k)], 6).alias(f"p{k}") for k in CLASSES],
    )


@query("probability_percent", sql(
    " UNION ALL ".join(
        f"SELECT o_orderkey, '{k}' AS cls, {dec(f'w{k} / CAST(total AS DOUBLE) * 100', 1)} AS percent, w{k} = {TOP} AS is_top FROM voted" for k in CLASSES
    ),
    "votes", VOTED,
))
def probability_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*[F.lit(str(k)) for k in CLASSES])
    return voted(spark, sf_dir).select("o_orderkey", F.inline(percent_of(names, F.col("probabilities"))))


# --- comparison and logs ------------------------------------------------------

FOLDS = (
    f"folds AS (SELECT model_name, (o_orderkey * 7919) % 10007 % 5 AS fold, {dec('avg(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END)', 6)} AS score "
    "FROM voted WHERE model_name <> 'P' GROUP BY 1, 2)",
    f"cv AS (SELECT model_name, {dec('avg(score)', 4)} AS cv_mean, {dec('stddev_pop(score)', 4)} AS cv_std FROM folds GROUP BY model_name)",
)
COMPARED = (
    f"metrics AS ({METRICS_SQL})",
    f"areas_under AS (SELECT model_name, {dec('sum(auc * support) / sum(support)', 4)} AS roc_auc FROM auc GROUP BY model_name)",
    """compared AS (SELECT model_name, CASE WHEN model_name = 'P' THEN 'DL' ELSE 'ML' END AS type, accuracy, precision_weighted, recall_weighted,
         f1_weighted, roc_auc, cv_mean, cv_std FROM metrics JOIN areas_under USING (model_name) LEFT JOIN cv USING (model_name))""",
)
COMPARED_PARTS = ("votes", VOTED, LONG, *_class_ctes("model_name"), *AUC, *FOLDS, *COMPARED)


def compared_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of three models; only the ML ones have cross-validation scores."""
    rows = voted(spark, sf_dir)
    scored = metrics.classification_metrics(rows, "y_true", "y_pred", ["model_name"]).join(
        metrics.weighted_auc(
            metrics.roc_auc_by_class(by_class(rows), "cls", "positive", "p", ["model_name"]), ["model_name"]
        ),
        "model_name",
    )
    fold = ((F.col("o_orderkey") * 7919) % 10007 % 5).alias("fold")
    hit = F.when(F.col("y_true") == F.col("y_pred"), 1.0).otherwise(0.0)
    folds = rows.filter("model_name <> 'P'").groupBy("model_name", fold).agg(snap(F.avg(hit), 6).alias("score"))
    ml = scored.join(cv_summary(folds, "score", ["model_name"]), "model_name").withColumn("type", F.lit("ML"))
    dl = scored.filter("model_name = 'P'").withColumn("type", F.lit("DL"))
    return stage(comparison.comparison([ml, dl], "roc_auc"), "comparison")  # one row per model, read several times


@query("model_comparison", sql("SELECT * FROM compared", *COMPARED_PARTS))
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared_models(spark, sf_dir)


@query("best_model", sql(
    """SELECT 'classifier' AS task, (SELECT model_name FROM compared ORDER BY roc_auc DESC, f1_weighted DESC, accuracy DESC, model_name LIMIT 1) AS best_model
       UNION ALL SELECT 'classifier in training', (SELECT model_name FROM compared ORDER BY roc_auc DESC, f1_weighted DESC, cv_std NULLS FIRST, model_name LIMIT 1)
       UNION ALL SELECT 'regressor', (SELECT model_name FROM regressors ORDER BY rmse, r2 DESC, model_name LIMIT 1)
       UNION ALL SELECT 'regressor in training', (SELECT model_name FROM regressors ORDER BY r2 DESC, model_name = '5-LOW' DESC, model_name LIMIT 1)""",
    *COMPARED_PARTS, "forecasts", f"regressors AS ({_regression_sql('forecasts')})",
))
def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    classifiers, regressors = compared_models(spark, sf_dir), stage(regression_metrics(spark, sf_dir), "regressors")
    winners = {
        "classifier": comparison.best_classifier(classifiers),
        "classifier in training": comparison.best_classifier_in_training(classifiers),
        "regressor": comparison.best_regressor(regressors),
        "regressor in training": comparison.best_regressor_in_training(regressors, "5-LOW"),
    }
    rows = None
    for task, best in winners.items():
        row = best.select(F.lit(task).alias("task"), "best_model")
        rows = row if rows is None else rows.unionByName(row)
    return rows


STATUS_METRICS = (
    "by_status AS (SELECT o_orderstatus, model_name, y_true, y_pred FROM forecasts)",
    "log AS (" + " UNION ALL ".join(
        f"SELECT '{s}' AS log, * FROM ({_regression_sql('by_status')})".replace("FROM by_status", f"FROM by_status WHERE o_orderstatus = '{s}'")
        for s in "FOP"
    ) + ")",
)


@query("metrics_log_explode", sql("SELECT * FROM log", "forecasts", *STATUS_METRICS))
def metrics_log_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = metrics.regression_metrics(adapter(spark, sf_dir, "forecasts"), "y_true", "y_pred", ["o_orderstatus", "model_name"])
    record = F.struct("model_name", "rmse", "mae", "mse", "r2", "mape")
    # one record per model
    logs = scored.groupBy(F.col("o_orderstatus").alias("log")).agg(F.to_json(F.collect_list(record)).alias("text"))
    parsed = logs.select("log", parse_records(F.col("text")).alias("comparison"))
    return comparison.explode_log(parsed).select("log", "model_name", "rmse", "mae", "mse", "r2", "mape")


@query("metrics_upsert", sql(
    """SELECT model_name, rmse, mae, mse, r2, mape, 'kept' AS origin FROM log WHERE log = 'F' AND model_name NOT IN ('2-HIGH', '3-MEDIUM')
       UNION ALL SELECT model_name, rmse, mae, mse, r2, mape, 'new' FROM log WHERE log = 'O' AND model_name IN ('2-HIGH', '3-MEDIUM')
       UNION ALL SELECT 'first seen', rmse, mae, mse, r2, mape, 'new' FROM log WHERE log = 'O' AND model_name = '5-LOW'""",
    "forecasts", *STATUS_METRICS,
))
def metrics_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = metrics.regression_metrics(adapter(spark, sf_dir, "forecasts"), "y_true", "y_pred", ["o_orderstatus", "model_name"])
    old = scored.filter("o_orderstatus = 'F'").drop("o_orderstatus").withColumn("origin", F.lit("kept"))
    new = scored.filter("o_orderstatus = 'O' AND model_name IN ('2-HIGH', '3-MEDIUM', '5-LOW')").drop("o_orderstatus")
    renamed = new.replace({"5-LOW": "first seen"}, subset=["model_name"]).withColumn("origin", F.lit("new"))
    return comparison.upsert(old, renamed)


# --- training histories -------------------------------------------------------


def histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per user with parallel loss arrays, at most 24 epochs each."""
    epochs = adapter(spark, sf_dir, "epochs")
    ordered = F.array_sort(F.collect_list(F.struct("h", snap("val_loss", 4).alias("val_loss"), "train_loss")))
    return epochs.groupBy("run_id").agg(ordered.alias("e")).select(
        "run_id", F.col("e.val_loss").alias("val_loss"), F.col("e.train_loss").alias("train_loss")
    )


STEPS = f"steps AS (SELECT run_id, row_number() OVER (PARTITION BY run_id ORDER BY h) AS epoch, {dec('val_loss', 4)} AS val_loss, train_loss FROM epochs)"


@query("history_to_rows", sql("SELECT run_id, epoch, val_loss, train_loss FROM steps", "epochs", STEPS))
def history_to_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparison.history_rows(histories(spark, sf_dir), "run_id", ["val_loss", "train_loss"])


@query("best_epoch", sql(
    """SELECT g.run_id, max(CASE WHEN improved THEN epoch END) AS best_epoch, min(val_loss) AS best_loss, max(epoch) AS stop_epoch,
              bool_or(epoch - last_best >= 10) AS stopped_early
       FROM gaps g JOIN (SELECT run_id, min(CASE WHEN epoch - last_best >= 10 THEN epoch END) AS stop FROM gaps GROUP BY run_id) s USING (run_id)
       WHERE s.stop IS NULL OR epoch <= s.stop GROUP BY g.run_id""",
    "epochs", STEPS,
    """marks AS (SELECT *, coalesce(val_loss < min(val_loss) OVER (PARTITION BY run_id ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true)
         AS improved FROM steps)""",
    "gaps AS (SELECT *, max(CASE WHEN improved THEN epoch END) OVER (PARTITION BY run_id ORDER BY epoch) AS last_best FROM marks)",
))
def best_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparison.best_epoch(histories(spark, sf_dir), "run_id")
