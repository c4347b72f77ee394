"""Exact deduplication by content-defined chunk recipes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airsight.llm.common import whole
from airsight.session import lookup

#: Characters a chunk has at least and at most, unless the text ends.
CHUNK_CHARS = (256, 4096)
#: Where a chunk may end: behind one in a few of the sentence and line ends, told by the two characters before the mark.
CUT = r"(?<=[02468bdfhjlnprtvxz][0-4a-mA-M][.!?\n])"


def chunks(text: Column, sizes: tuple[int, int] = CHUNK_CHARS) -> Column:
    """Array of chunks that concatenate to ``text``.

    A chunk ends at the first ``CUT`` after the least size. Cuts depend on the characters before them and are rarer than that size, so
    equal passages soon fall into equal chunks again after an edit before them. Where no such place comes, the largest size cuts.
    """
    least, most = sizes
    return F.regexp_extract_all(whole(text), F.lit(rf"(?s).{{{least},{most}}}?{CUT}|.{{{most}}}|.+"), F.lit(0))


def _identifiers(pieces: Column, wide: bool) -> Column:
    if wide:
        return F.transform(pieces, lambda c: F.sha2(c, 256))
    return F.transform(pieces, lambda c: F.xxhash64(c))


def identifiers_collide(docs: DataFrame, text: str = "text", sizes: tuple[int, int] = CHUNK_CHARS) -> bool:
    """Verify the 64-bit chunk identifiers: does any of them stand for chunks of different content?

    Every chunk is counted once per identifier with the least and greatest SHA-256 under it. Tasks aggregate first, and only
    identifiers and digests are shuffled, never the chunks.
    """
    each = docs.select(F.explode(chunks(F.col(text), sizes)).alias("chunk"))
    each = each.select(F.xxhash64("chunk").alias("id"), F.unhex(F.sha2("chunk", 256)).alias("digest"))
    per_id = each.groupBy("id").agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
    return not per_id.filter(F.col("low") != F.col("high")).isEmpty()


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", sizes: tuple[int, int] = CHUNK_CHARS) -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, ``n_chunks``.

    Each text becomes a recipe, the ordered list of the identifiers of its chunks. Identifiers are verified first
    (``identifiers_collide``); should one ever stand for two contents, all identifiers are 256 bits wide instead. Texts
    are equal exactly when their recipes are, so recipes are grouped and joined, and no text is moved.

    Of equal texts the row with the largest id stays. Null and empty texts are equal to each other: their recipe is empty.
    Rows that repeat an id and its text are one document and carry the same answer. A null id is less than any other;
    a group of null ids only keeps them. No rows give no rows. Other columns are ignored, whatever their names.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    wide = identifiers_collide(docs, "text", sizes)
    recipes = docs.select(
        "doc_id", _identifiers(chunks(F.col("text"), sizes), wide).alias("recipe"), F.sha2(whole(F.col("text")), 256).alias("text_sha256")
    )
    groups = recipes.groupBy("recipe").agg(F.max("doc_id").alias("top_id"), F.count("*").alias("n"))
    repeated = lookup(groups.filter("n > 1"), "repeated-recipes")  # most recipes are single and need no partner in the join
    keep_id = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("top_id"))
    return recipes.join(repeated, "recipe", "left").select(
        "doc_id", keep_id.alias("keep_id"), F.coalesce("n", F.lit(1)).alias("group_size"), F.col("doc_id").eqNullSafe(keep_id).alias("kept"), "text_sha256",
        F.size("recipe").cast("long").alias("n_chunks"),
    )
