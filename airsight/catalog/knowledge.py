"""Queries over vectors and documents: retrieval, citations and prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airsight import advice_text as text
from airsight.catalog.adapters import adapter
from airsight.catalog.assessments import ASSESSED_PARTS, _quoted, assessed
from airsight.catalog.registry import dec, query, snap, sql
from airsight.catalog.tables import WS
from airsight.functions.vectors import l2_normalize as unit
from airsight.functions.vectors import norm
from airsight.operators import corpus, retrieval
from airsight.session import stage

# every vector is a query against all vectors
TOPK = f"""topk AS (SELECT query_id, vec_id, rank, {dec('greatest(0, sim)', 4)} AS similarity FROM (
    SELECT query_id, vec_id, sim, row_number() OVER (PARTITION BY query_id ORDER BY round(sim, 10) DESC, vec_id) AS rank FROM (
      SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])) AS sim
      FROM vectors q CROSS JOIN vectors c WHERE q.embedding IS NOT NULL AND c.embedding IS NOT NULL)) WHERE rank <= 3 AND greatest(0, sim) >= 0.3)"""
FOUND = """found AS (SELECT t.query_id, t.vec_id, t.rank, t.similarity, v.source, v.category, d.text
    FROM topk t JOIN vectors v USING (vec_id) JOIN documents d ON d.doc_id = v.text_id)"""
FOUND_PARTS = ("vectors", TOPK, FOUND)


def topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = adapter(spark, sf_dir, "vectors")
    queries = vectors.select(F.col("vec_id").alias("query_id"), "embedding")
    return retrieval.vector_topk(queries, vectors, "query_id", "vec_id")


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter(spark, sf_dir, "files").select(F.col("doc_id").alias("text_id"), "text")


def _hits(spark: SparkSession, sf_dir: str, texts: DataFrame) -> DataFrame:
    vectors = adapter(spark, sf_dir, "vectors").select("vec_id", "source", "category", "text_id")
    return topk(spark, sf_dir).join(vectors, "vec_id").join(texts, "text_id").drop("text_id")


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retrieved chunks with source, category and text."""
    return _hits(spark, sf_dir, _texts(spark, sf_dir))


def found_condensed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retrieved chunks with what a context needs of their texts, each text condensed once."""
    return _hits(spark, sf_dir, retrieval.condensed(_texts(spark, sf_dir)))


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retrieved chunks kept as a table, for steps that read them more than once."""
    return stage(found(spark, sf_dir), "retrieved")


@query("l2_normalize", sql(
    f"""SELECT vec_id, i, {dec('x / sqrt(sum(x * x) OVER (PARTITION BY vec_id))', 6)} AS x,
               {dec('sqrt(sum(x * x) OVER (PARTITION BY vec_id))', 6)} AS length
        FROM (SELECT vec_id, CAST(i AS INTEGER) AS i, CAST(embedding[i + 1] AS DOUBLE) * (vec_id % 7 + 1) AS x
              FROM (SELECT vec_id, embedding, unnest(range(len(embedding))) AS i FROM vectors WHERE embedding IS NOT NULL))""",
    "vectors",
))
def l2_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = adapter(spark, sf_dir, "vectors").filter("embedding IS NOT NULL").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double") * (F.col("vec_id") % 7 + 1)).alias("v")
    )
    sized = scaled.select("vec_id", snap(norm(F.col("v")), 6).alias("length"), unit(F.col("v")).alias("u"))
    return sized.select("vec_id", "length", F.posexplode_outer("u").alias("i", "x")).withColumn("x", snap("x", 6))


@query("vector_topk_pruned", sql(
    """SELECT count(*) AS queries, CAST(sum(least(5, others)) AS BIGINT) AS exact_pairs, TRUE AS recall_reached
       FROM (SELECT vec_id, (SELECT count(*) FROM vectors WHERE embedding IS NOT NULL) AS others FROM vectors WHERE vec_id % 50 = 0 AND embedding IS NOT NULL)""",
    "vectors",
))
def vector_topk_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recall of the pruned search for the ids divisible by 50 against all vectors, measured against the exact search."""
    vectors = adapter(spark, sf_dir, "vectors").select("vec_id", "embedding")
    asked = vectors.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    pairs = lambda search: stage(search(asked, vectors, "query_id", "vec_id", k=5, threshold=-1.0).select("query_id", "vec_id"), "pairs")
    exact, pruned = pairs(retrieval.vector_topk), pairs(retrieval.vector_topk_pruned).withColumn("found", F.lit(True))
    met = exact.join(pruned, ["query_id", "vec_id"], "left")
    return met.agg(
        F.count_distinct("query_id").alias("queries"), F.count("*").alias("exact_pairs"), (F.count("found") >= 0.9 * F.count("*")).alias("recall_reached")
    )


EMBEDDING = """
    tokens AS (
        SELECT digest, CAST(('0x' || left(md5(t), 8))::BIGINT % 384 AS INTEGER) AS place
        FROM (SELECT digest, unnest(regexp_extract_all(lower(text), '[^\\x20\\x09-\\x0D]+')) AS t
              FROM (SELECT DISTINCT sha256(text) AS digest, text FROM files WHERE text IS NOT NULL))),
    held AS (SELECT digest, place, count(*) AS tf FROM tokens GROUP BY digest, place),
    idf AS (SELECT place, ln(((SELECT count(DISTINCT text) FROM files) + 1.0::DOUBLE) / (count(*) + 1)) AS idf FROM held GROUP BY place),
    weighed AS (SELECT digest, place, tf * idf AS w FROM held JOIN idf USING (place))"""


@query("text_embedding", sql(
    f"""SELECT digest, place, {dec('w / sqrt(total)', 5)} AS value
        FROM (SELECT digest, place, w, sum(w * w) OVER (PARTITION BY digest) AS total FROM weighed) WHERE w > 0""",
    "files", EMBEDDING,
))
def text_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashed, weighed unit vectors of every distinct text of the corpus, one row per non-zero component."""
    vectors = corpus.hashing_vectors(adapter(spark, sf_dir, "files"), "text", 384)
    return vectors.select("digest", "place", snap("value", 5).alias("value"))


@query("vector_topk", sql("SELECT * FROM topk", "vectors", TOPK))
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk(spark, sf_dir)


@query("retrieval_confidence", sql(
    f"""SELECT v.vec_id AS query_id, {dec('avg(t.similarity)', 6)} AS avg_similarity,
               CASE WHEN avg(t.similarity) >= 0.65 THEN 'High' WHEN avg(t.similarity) >= 0.4 THEN 'Medium' ELSE 'Low' END AS confidence
        FROM vectors v LEFT JOIN topk t ON t.query_id = v.vec_id GROUP BY v.vec_id""",
    "vectors", TOPK,
))
def retrieval_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries = adapter(spark, sf_dir, "vectors").select(F.col("vec_id").alias("query_id"))
    return retrieval.retrieval_confidence(queries, topk(spark, sf_dir), "query_id")


STRIP = rf"'^[{WS}]+|[{WS}]+$', '', 'g'"
SOURCES = f"""sources AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, rank) AS position,
    source AS filename, category, {dec('similarity', 3)} AS similarity,
    concat(regexp_replace(left(text, 200), {STRIP}), CASE WHEN length(text) > 200 THEN ' …' ELSE '' END) AS excerpt
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id, source ORDER BY similarity DESC, rank) AS r
          FROM (SELECT * REPLACE (coalesce(source, 'unknown') AS source, coalesce(category, 'General') AS category) FROM found)) WHERE r = 1)"""


@query("citation_sources", sql("SELECT * FROM sources", *FOUND_PARTS, SOURCES))
def citation_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.citation_sources(found(spark, sf_dir), "query_id")


CITED = r"cited AS (SELECT query_id, unnest(list_distinct(regexp_extract_all(answer, '\[([^\[\]]+?\.[a-zA-Z]{2,5})\]', 1))) AS cited FROM answers)"
UNKNOWN = "unknown AS (SELECT query_id, cited FROM cited WHERE NOT EXISTS (SELECT 1 FROM found f WHERE f.query_id = cited.query_id AND f.source = cited.cited))"


@query("hallucinated_citations", sql("SELECT * FROM unknown", *FOUND_PARTS, "answers", CITED, UNKNOWN))
def hallucinated_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.uncited_sources(adapter(spark, sf_dir, "answers"), found(spark, sf_dir), "query_id")


@query("citation_result", sql(
    """SELECT a.query_id, a.answer, coalesce((SELECT string_agg(concat(filename, '=', CAST(similarity AS VARCHAR)), ', ' ORDER BY position) FROM sources s WHERE s.query_id = a.query_id), '') AS sources,
              CASE WHEN m.avg >= 0.65 THEN 'High' WHEN m.avg >= 0.4 THEN 'Medium' ELSE 'Low' END AS confidence,
              (SELECT string_agg(cited, ', ' ORDER BY cited) FROM cited c WHERE c.query_id = a.query_id) AS cited,
              coalesce((SELECT string_agg(cited, ', ' ORDER BY cited) FROM unknown u WHERE u.query_id = a.query_id), '') AS not_retrieved, 'local' AS model
       FROM answers a LEFT JOIN (SELECT query_id, avg(similarity) AS avg FROM found GROUP BY query_id) m ON m.query_id = a.query_id""",
    *FOUND_PARTS, SOURCES, "answers", CITED, UNKNOWN,
))
def citation_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = retrieval.citation_result(adapter(spark, sf_dir, "answers"), stored(spark, sf_dir), "query_id", "local")
    shown = F.transform("sources", lambda s: F.concat(s["filename"], F.lit("="), s["similarity"].cast("string")))
    return rows.select(
        "query_id", "answer", F.coalesce(F.array_join(shown, ", "), F.lit("")).alias("sources"), "confidence",
        F.array_join("cited", ", ").alias("cited"), F.array_join("not_retrieved", ", ").alias("not_retrieved"), "model",
    )


# --- prompts ------------------------------------------------------------------

COLLAPSED = rf"trim(regexp_replace(text, '[{WS}]+', ' ', 'g'))"


def _context(source: str, suffix: str, budget: int) -> tuple[str, ...]:
    return (
        f"""unique{suffix} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id, mark ORDER BY similarity DESC, rank) AS r
             FROM (SELECT *, left({COLLAPSED}, 120) AS mark FROM {source})) WHERE r = 1 AND mark <> '')""",
        f"""heads{suffix} AS (SELECT *, concat('[', CAST(entry_no AS VARCHAR), '] ', source, ':', chr(10)) AS head FROM (
             SELECT query_id, coalesce(source, 'unknown') AS source, {COLLAPSED} AS body, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, rank) AS entry_no FROM unique{suffix}))""",
        f"""spent{suffix} AS (SELECT *, {budget} - coalesce(sum(length(head) + length(body)) OVER
             (PARTITION BY query_id ORDER BY entry_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room FROM heads{suffix})""",
        f"""entries{suffix} AS (SELECT query_id, entry_no, source, concat(head, CASE WHEN length(body) > room THEN concat(left(body, CAST(room AS BIGINT)), '…') ELSE body END) AS entry
             FROM spent{suffix} WHERE room > 0)""",
        f"""blocks{suffix} AS (SELECT u.query_id, u.chunks_used, b.context, b.context_chars
             FROM (SELECT query_id, count(*) AS chunks_used FROM unique{suffix} GROUP BY query_id) u
             LEFT JOIN (SELECT query_id, string_agg(entry, chr(10) || chr(10) ORDER BY entry_no) AS context, CAST(sum(length(entry)) AS BIGINT) AS context_chars
                        FROM entries{suffix} GROUP BY query_id) b USING (query_id))""",
    )


@query("dedup_chunks", sql("SELECT query_id, vec_id, rank, similarity, source, category, text FROM \"unique\"".replace('"unique"', "unique_"), *FOUND_PARTS, *_context("found", "_", 2500)[:1]))
def dedup_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.dedup_chunks(found(spark, sf_dir), "query_id")


@query("context_budget", sql("SELECT * FROM entries_", *FOUND_PARTS, *_context("found", "_", 2500)[:4]))
def context_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.context_entries(found_condensed(spark, sf_dir), "query_id")


QUESTIONS = """questions AS (SELECT v.vec_id AS query_id, concat('  Which limits apply near ', coalesce(v.source, 'here'), '? ') AS question,
    a.city_type, a.health_impact, a.pollution_level, a.risk_level, CASE WHEN v.vec_id % 3 = 0 THEN NULL ELSE a.trend END AS trend,
    CASE WHEN v.vec_id % 3 = 1 THEN 'forest' END AS model_name
    FROM vectors v JOIN assessed a ON a.area_id = v.vec_id)"""


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question per vector about the area of the same id."""
    areas = assessed(spark, sf_dir).select(
        F.col("area_id").alias("query_id"), "city_type", "health_impact", "pollution_level", "risk_level", "trend"
    )
    asked = adapter(spark, sf_dir, "vectors").select(
        F.col("vec_id").alias("query_id"), F.concat(F.lit("  Which limits apply near "), F.coalesce("source", F.lit("here")), F.lit("? ")).alias("question")
    )
    return asked.join(areas, "query_id").withColumns({
        "trend": F.when(F.col("query_id") % 3 != 0, F.col("trend")),
        "model_name": F.when(F.col("query_id") % 3 == 1, "forest"),
    })


def _fields(labels: dict[str, str], joiner: str, separator: str) -> str:
    have = ("city_type", "health_impact", "pollution_level", "risk_level", "trend", "model_name")
    parts = [f"CASE WHEN {f} IS NOT NULL THEN concat('{label}{joiner}', CAST({f} AS VARCHAR)) END" for f, label in labels.items() if f in have]
    return f"concat_ws('{separator}', {', '.join(parts)})"


@query("enrich_query", sql(
    f"SELECT query_id, concat('Prediction context — ', {_fields(text.ENRICHMENT_FIELDS, ': ', '; ')}, chr(10), chr(10), question) AS enriched FROM questions",
    "vectors", *ASSESSED_PARTS, QUESTIONS,
))
def enrich_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.enrich_query(questions(spark, sf_dir)).select("query_id", "enriched")


def _prompt_sql(suffix: str, with_prediction: bool) -> str:
    line = f"concat('Prediction: ', {_fields(text.PREDICTION_LINE, '=', ', ')}, chr(10), chr(10)), " if with_prediction else ""
    return f"""SELECT query_id, system, user_text AS "user", context_chars, chunks_used, length(system) + length(user_text) AS total_chars,
          greatest(1, (length(system) + length(user_text)) // 4) AS est_tokens, greatest(1, length(system) // 4) AS system_tokens,
          greatest(1, length(user_text) // 4) AS user_tokens
        FROM (SELECT q.query_id, {_quoted(text.SYSTEM_PROMPT)} AS system,
                concat({line}'RETRIEVED CONTEXT:', chr(10), coalesce(b.context, '{text.NO_DOCUMENTS}'), chr(10), chr(10), 'QUESTION: ', trim(question), {_quoted(text.QUESTION_TASK)}) AS user_text,
                coalesce(b.context_chars, 0) AS context_chars, coalesce(b.chunks_used, 0) AS chunks_used
              FROM questions q LEFT JOIN blocks{suffix} b USING (query_id))"""


@query("prompt_table", sql(
    _prompt_sql("_", True), *FOUND_PARTS, *_context("found", "_", 2500), *ASSESSED_PARTS, QUESTIONS
))
def prompt_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.prompt_table(questions(spark, sf_dir), found_condensed(spark, sf_dir), "query_id")


@query("prompt_table_reduced", sql(
    _prompt_sql("_", False), *FOUND_PARTS,
    "few AS (SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, rank) AS n FROM found) WHERE n <= 2)",
    *_context("few", "_", 1200), *ASSESSED_PARTS, QUESTIONS,
))
def prompt_table_reduced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.reduced_prompt_table(questions(spark, sf_dir), found_condensed(spark, sf_dir), "query_id")
