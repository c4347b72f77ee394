"""One query per operator, with production parameters over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airsight.llm import chat, decontamination, exact_dedup, hard_negatives, line_dedup, main_text, mixing, ngram_join, prefix_trie, quality
from airsight.llm import substring_dedup, toxicity, warc
from airsight.llm.common import table
from airsight.llm.registry import ORACLES, QUERIES, query  # noqa: F401  (the entry module reads the registry here)

LINE_SQL = f"""
WITH lines AS (
    SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
    FROM documents),
totals AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
often AS (
    SELECT l.source, l.bare FROM (SELECT DISTINCT doc_id, source, trim(line, ' ' || chr(9) || chr(13)) AS bare FROM lines) l
    JOIN totals t ON t.source IS NOT DISTINCT FROM l.source
    WHERE bare <> '' GROUP BY l.source, l.bare, t.pages
    HAVING count(*) >= {line_dedup.MIN_PAGES} AND count(*) > CAST({line_dedup.RATIO} AS DOUBLE) * t.pages),
marked AS (
    SELECT l.doc_id, l.line, l.pos, o.bare IS NOT NULL AS gone FROM lines l
    LEFT JOIN often o ON o.source IS NOT DISTINCT FROM l.source AND o.bare = trim(l.line, ' ' || chr(9) || chr(13)))
SELECT d.doc_id, d.source, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       coalesce(string_agg(m.line, chr(10) ORDER BY m.pos) FILTER (NOT gone), '') AS text
FROM documents d JOIN marked m USING (doc_id) GROUP BY d.doc_id, d.source"""

EXACT_SQL = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id, count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents"""

WARC_SQL = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS head FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {warc.REVISIT_BYTES} AND page_id <> head THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {warc.REVISIT_BYTES} AND page_id <> head THEN head END AS refers_to
FROM q"""


# CRC-32 has no SQL function: the reflected polynomial, bit by bit over the digits
TRIE_SQL = f"""
WITH numbered AS (
    SELECT conv_id, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k, length(coalesce(text, '')) AS chars,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                              sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS own
    FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
    SELECT conv_id, conv_id - conv_id % {prefix_trie.BLOCK} AS donor,
           xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
               lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)
           % {prefix_trie.HEADS} AS h
    FROM (SELECT DISTINCT conv_id FROM numbered)),
turns AS (
    SELECT i.conv_id, n.own AS place, n.k, n.chars, 0 AS part FROM ids i JOIN numbered n ON n.conv_id = i.donor AND n.own <= i.h
    UNION ALL
    SELECT i.conv_id, n.own, n.k, n.chars, 1 FROM ids i JOIN numbered n ON n.conv_id = i.conv_id AND n.own > i.h),
rebuilt AS (
    SELECT i.conv_id, coalesce(list(t.k ORDER BY part, place) FILTER (t.k IS NOT NULL), []) AS ks,
           coalesce(list(t.chars ORDER BY part, place) FILTER (t.k IS NOT NULL), []) AS chars
    FROM ids i LEFT JOIN turns t USING (conv_id) GROUP BY i.conv_id),
prefixes AS (
    SELECT conv_id, d AS depth, len(ks) AS n, sha256(array_to_string(ks[1:d], ',')) AS node,
           CASE WHEN d > 0 THEN sha256(array_to_string(ks[1:d - 1], ',')) END AS parent, coalesce(chars[d], 0) AS chars
    FROM (SELECT conv_id, ks, chars, unnest(range(len(ks) + 1)) AS d FROM rebuilt)),
nodes AS (
    SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(parent) AS parent, any_value(chars) AS chars,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
    FROM prefixes GROUP BY node, depth),
children AS (SELECT parent, depth - 1 AS depth, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent, depth),
sums AS (
    SELECT a.node, a.depth, sum((n.n_convs - 1) * n.chars) AS saved, count(*) FILTER (c.n IS NULL) AS leaves
    FROM nodes n JOIN prefixes a ON a.conv_id = n.conv_id AND a.depth <= n.depth LEFT JOIN children c ON c.parent = n.node AND c.depth = n.depth
    GROUP BY a.node, a.depth)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, s.leaves AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.node = n.node AND s.depth = n.depth LEFT JOIN children c ON c.parent = n.node AND c.depth = n.depth
LEFT JOIN nodes p ON p.node = n.parent AND p.depth = n.depth - 1"""

NEGATIVES_SQL = f"""
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor({hard_negatives.SCALE} * CAST(x AS DOUBLE))) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
    SELECT anchor_id, other AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {hard_negatives.POSITIVES}),
ranked AS (
    SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
           other AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scores USING (anchor_id)
    WHERE NOT same AND {hard_negatives.WINDOW[0]} * positive_score <= 100 * score AND 100 * score <= {hard_negatives.WINDOW[1]} * positive_score)
SELECT * FROM ranked WHERE rank <= {hard_negatives.NEGATIVES}"""


@query("op1_warc", WARC_SQL)
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages")).drop("target_uri", "warc_date")


@query("op2_chat_windows")
def op2_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    return chat.read_back(chat.format_conversations(turns.union(planted)), together=True)


@query("op5_line_dedup", LINE_SQL)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs)


@query("op7_exact_dedup", EXACT_SQL)
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).drop("n_chunks")


@query("op8_mixing")
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op9_ngram_join")
def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


@query("op3_decontamination")
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op4_substring_dedup")
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.drop_repeated_spans(docs)


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op11_prefix_trie", TRIE_SQL)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query("op12_hard_negatives", NEGATIVES_SQL)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label")
    )
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


@query("op13_main_text")
def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_text(table(spark, sf_dir, "pages"))
