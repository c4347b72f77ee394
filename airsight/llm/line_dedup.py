"""Line deduplication by the share of a site's pages that carry a line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airsight.llm.common import fresh, text_key, whole
from airsight.session import lookup

#: A line is boilerplate of a site if more than this share of the site's pages carry it.
RATIO = 0.1
#: And if this many pages of the site do: the share says nothing on a site of few pages.
MIN_PAGES = 5


def lines(text: Column) -> Column:
    return F.split(whole(text), "\n", -1)


def _stripped(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def _line_id(line: Column) -> Column:
    """Identity of a stripped line: two independent hashes, 96 bits; null for a blank line."""
    bare = _stripped(line)
    return F.when(bare != "", F.struct(F.xxhash64(bare).alias("a"), F.hash(bare).alias("b")))


def boilerplate(
    docs: DataFrame, site: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES, copies_count: bool = True
) -> DataFrame:
    """Per site: ``site``, ``site_pages`` and ``boilerplate``, the array of ids of its boilerplate lines.

    A page counts once for a line, however often it repeats it. Counting aggregates inside the tasks first, and only
    hashes are shuffled, so a site with a third of all pages is no hot group. The array is small by proof: a site
    whose pages have L distinct lines on average has fewer than L / ratio lines beyond the ratio. Without ``copies_count`` pages of a
    site with the very same text are one page, so that no group of copies makes its own lines boilerplate.
    """
    pages = docs.select(F.col(site).alias("site"), F.col(text).alias("text"), F.array_distinct(F.transform(lines(F.col(text)), _line_id)).alias("ids"))
    if not copies_count:  # ids travel, texts do not
        pages = pages.groupBy("site", text_key(F.col("text")).alias("key")).agg(F.first("ids").alias("ids"))
    # the null id counts the pages themselves: every page has it exactly once
    each = pages.select("site", F.explode(F.array_distinct(F.concat("ids", F.array(F.lit(None).cast("struct<a:bigint,b:int>"))))).alias("id"))
    counted = each.groupBy("site", "id").agg(F.count("*").alias("n"))
    totals = counted.filter("id IS NULL").select(F.col("site").alias("total_site"), F.col("n").alias("site_pages"))
    often = counted.filter(F.col("id").isNotNull() & (F.col("n") >= min_pages))
    frequent = often.join(lookup(totals, "site-pages"), F.col("site").eqNullSafe(F.col("total_site")))
    frequent = frequent.filter(F.col("n") > ratio * F.col("site_pages"))
    return frequent.groupBy("site").agg(F.max("site_pages").alias("site_pages"), F.sort_array(F.collect_list("id")).alias("boilerplate"))


def drop_boilerplate(
    docs: DataFrame, site: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES, copies_count: bool = True
) -> DataFrame:
    """``docs`` with the boilerplate lines of each site cut from ``text``, and the columns ``n_lines`` and ``n_dropped``.

    A line is what stands between line feeds, compared without spaces, tabs and carriage returns around it. Blank lines are never
    dropped; the other lines stay as they are, in order. No document goes: one that is all boilerplate is left with an
    empty text. A null site is a site of its own, a null text has no line and stays null, no rows give no rows. Repeated
    rows count as pages each, or once without ``copies_count``. A text of any length is cut in one piece. Extra columns pass through; ``n_lines`` and ``n_dropped`` get underscores in
    front where the input has such names.
    """
    mine, theirs = fresh("boilerplate", docs.columns), fresh("boilerplate_site", docs.columns)
    n_lines, n_dropped, left = (fresh(c, docs.columns) for c in ("n_lines", "n_dropped", "kept"))
    found = lookup(boilerplate(docs, site, text, ratio, min_pages, copies_count), "boilerplate")
    found = found.select(F.col("site").alias(theirs), F.col("boilerplate").alias(mine))
    kept = F.filter(lines(F.col(text)), lambda x: ~F.coalesce(F.array_contains(F.col(mine), _line_id(x)), F.lit(False)))
    before = F.when(F.col(text).isNull(), 0).otherwise(F.size(lines(F.col(text)))).cast("long")
    joined = docs.join(found, F.col(site).eqNullSafe(F.col(theirs)), "left")
    marked = joined.withColumn(left, F.when(F.col(mine).isNotNull() & F.col(text).isNotNull(), kept))
    columns = [
        F.when(F.col(left).isNull(), F.col(text)).otherwise(F.array_join(left, "\n")).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns
    ]
    dropped = F.when(F.col(left).isNull(), 0).otherwise(F.size(lines(F.col(text))) - F.size(left)).cast("long")
    return marked.select(*columns, before.alias(n_lines), dropped.alias(n_dropped))
