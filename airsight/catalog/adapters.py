"""Domain inputs derived from the given tables.

Each adapter is one SELECT that Spark SQL and the oracle engine both understand, over views named
like the tables. Nothing is sampled or cut: every adapter covers its whole table. Odd values
(sentinels, NULLs, unknown labels, zero targets) are planted so that the operators meet them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]

ADAPTERS = {
    # several sensor series with a sentinel for missing values
    "readings": """
        SELECT event_type AS series_id, ts, event_id,
               CASE WHEN event_id % 17 = 0 THEN CAST(-200 AS DOUBLE) ELSE value END AS reading
        FROM events""",
    # one row per area
    "areas": """
        SELECT c_custkey AS area_id, c_acctbal / CAST(50 AS DOUBLE) AS pollution_level,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'Low' WHEN 'MACHINERY' THEN 'very high'
                    WHEN 'HOUSEHOLD' THEN '2.0' WHEN 'FURNITURE' THEN 'Very High' ELSE 'unknown' END AS health_impact,
               CASE WHEN c_nationkey % 2 = 0 THEN 'Industrial' ELSE 'Residential' END AS city_type,
               CASE c_custkey % 4 WHEN 0 THEN 'improving' WHEN 1 THEN ' Stable ' WHEN 2 THEN 'worsening'
                    ELSE 'sideways' END AS trend,
               CAST((c_custkey * 7919) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS confidence
        FROM customer""",
    # numeric matrix with NULLs, a constant column and a class
    "features": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               CASE WHEN l_partkey % 19 = 0 THEN CAST(NULL AS DOUBLE) ELSE l_quantity END AS f1,
               l_extendedprice AS f2, l_discount AS f3, l_tax AS f4, CAST(5 AS DOUBLE) AS f5, l_returnflag AS label
        FROM lineitem""",
    # binary labels with tied scores
    "scored": """
        SELECT doc_id, quality AS y_true, CAST((doc_id * 7919) % 50 AS DOUBLE) / CAST(50 AS DOUBLE) AS p1,
               CASE WHEN (doc_id * 7919) % 50 >= 25 THEN 1 ELSE 0 END AS y_pred
        FROM labels""",
    # binary scores per model: unlabelled rows, and one model that saw positives only
    "binary": """
        SELECT doc_id, concat('m', CAST(doc_id % 4 AS VARCHAR(20))) AS model_name,
               CASE WHEN doc_id % 4 = 3 THEN 1 WHEN doc_id % 9 = 0 THEN CAST(NULL AS INTEGER) ELSE quality END AS y_true,
               CAST((doc_id * 7919) % 50 + 10 * quality AS DOUBLE) / CAST(60 AS DOUBLE) AS p1
        FROM labels""",
    # two features that decide a binary label, but for some noise
    "customers": """
        SELECT c_custkey, c_acctbal AS balance, CAST((c_custkey * 7919) % 1000 AS DOUBLE) AS visits,
               CASE WHEN c_acctbal + (c_custkey * 7919) % 1000 * 3 + (c_custkey * 31) % 700 > 6000 THEN 'high' ELSE 'low' END AS label
        FROM customer""",
    # labels for splits, some absent
    "labelled": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN CAST(NULL AS VARCHAR(20)) ELSE o_orderpriority END AS label FROM orders""",
    # five classes with unnormalised scores, the true class favoured
    "votes": """
        SELECT o_orderkey, o_orderstatus, CAST(substring(o_orderpriority, 1, 1) AS INT) - 1 AS y_true,
               (o_orderkey * 93) % 100 + CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 61 ELSE 1 END AS w0,
               (o_orderkey * 124 + 17) % 100 + CASE substring(o_orderpriority, 1, 1) WHEN '2' THEN 61 ELSE 1 END AS w1,
               (o_orderkey * 155 + 34) % 100 + CASE substring(o_orderpriority, 1, 1) WHEN '3' THEN 61 ELSE 1 END AS w2,
               (o_orderkey * 186 + 51) % 100 + CASE substring(o_orderpriority, 1, 1) WHEN '4' THEN 61 ELSE 1 END AS w3,
               (o_orderkey * 217 + 68) % 100 + CASE substring(o_orderpriority, 1, 1) WHEN '5' THEN 61 ELSE 1 END AS w4
        FROM orders""",
    # actual and predicted values (in thousands) with zero targets, per model
    "forecasts": """
        SELECT o_orderkey, o_orderpriority AS model_name, o_orderdate, o_orderstatus,
               CASE WHEN o_orderkey % 23 = 0 THEN CAST(0 AS DOUBLE) ELSE o_totalprice / CAST(1000 AS DOUBLE) END AS y_true,
               o_totalprice * (CAST(90 AS DOUBLE) + o_orderkey % 21) / CAST(100000 AS DOUBLE) AS y_pred
        FROM orders""",
    # files of a corpus
    "files": """
        SELECT doc_id, concat('doc_', CAST(doc_id AS VARCHAR(20)), '.txt') AS filename, source AS category, lang, text
        FROM documents""",
    # text inputs: absent, negative, not a number, too high
    "pollutants": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 29 = 0 THEN 'n/a' ELSE CAST(o_orderkey % 70 AS VARCHAR(20)) END AS co,
               CAST(o_orderkey % 900 AS VARCHAR(20)) AS no2, CAST(o_orderkey % 1100 - 20 AS VARCHAR(20)) AS so2,
               CASE WHEN o_orderkey % 31 = 0 THEN CAST(NULL AS VARCHAR(20)) ELSE CAST(o_orderkey % 650 AS VARCHAR(20)) END AS o3,
               CAST(o_orderkey % 1010 AS VARCHAR(20)) AS pm2_5, CAST(o_orderkey % 1210 AS VARCHAR(20)) AS pm10
        FROM orders""",
    # health inputs out of bounds, class codes with an unmapped one
    "health": """
        SELECT o_orderkey AS record_id, CAST(o_orderkey % 520 AS DOUBLE) AS aqi, CAST(o_orderkey % 110 AS DOUBLE) AS humidity,
               CAST(o_orderkey % 130 - 60 AS DOUBLE) AS temperature, CAST(o_orderkey % 6 AS DOUBLE) AS class_code
        FROM orders""",
    # day-first text dates, some impossible
    "dated": """
        SELECT event_id, concat(CAST(1 + event_id % 31 AS VARCHAR(20)), '/', CAST(1 + event_id % 13 AS VARCHAR(20)), '/2004') AS d,
               concat(CAST(event_id % 24 AS VARCHAR(20)), ':00:00') AS t
        FROM events""",
    # every vector asks and answers, but for absent ones; absent sources and categories, texts that several vectors share
    "vectors": """
        SELECT vec_id, CASE WHEN vec_id % 37 = 5 THEN NULL ELSE embedding END AS embedding,
               CASE WHEN vec_id % 11 = 3 THEN CAST(NULL AS VARCHAR(20)) ELSE concat('doc_', CAST(vec_id % 40 AS VARCHAR(20)), '.txt') END AS source,
               CASE WHEN vec_id % 13 = 4 THEN CAST(NULL AS VARCHAR(20)) WHEN label % 2 = 0 THEN 'Air' ELSE 'Water' END AS category,
               CASE WHEN vec_id % 3 = 0 THEN label ELSE vec_id END AS text_id
        FROM embeddings""",
    # answers with citations, some not retrieved
    "answers": """
        SELECT vec_id AS query_id,
               concat('See [doc_', CAST(vec_id % 40 AS VARCHAR(20)), '.txt] and [Guide.pdf], not [note].') AS answer
        FROM embeddings""",
    # training runs with one loss per hour of the day as epoch
    "epochs": """
        SELECT user_id AS run_id, hour(ts) AS h, avg(value) AS val_loss, min(value) AS train_loss
        FROM events GROUP BY user_id, hour(ts)""",
}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def adapter(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The adapter's SELECT run by Spark over the parquet files of ``sf_dir``."""
    sql = ADAPTERS[name]
    tables = {t: load(spark, sf_dir, t) for t in TABLES if f" {t}" in sql}
    for t in tables:
        sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}")
    return spark.sql(sql, **tables)
