"""Exact deduplication and line deduplication against plain Python, and the queries against their SQL."""

import hashlib
import random
import re
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from airsight.llm import exact_dedup, line_dedup
from airsight.llm.queries import ORACLES, QUERIES

sys.path.insert(0, str(Path(__file__).parent.parent))
from compare import differences, oracle_connection  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), oracle_connection(SF_DIR), ORACLES[name]) == []


def exact_rows():
    rng = random.Random(1)
    texts = ["".join(rng.choices("ab .é\n😀", k=n)) for n in (1, 511, 513, 4096, 5000, 60_000)] + ["x" * 9000, "", None]
    rows = [(i, rng.choice(texts), "r") for i in range(80)]
    rows += [(3, rows[3][1], "r"), (None, texts[1], "r"), (None, "only null ids", "r"), (None, "only null ids", "r"), (500, texts[4] + " ", "r"), (501, texts[4].upper(), "r")]
    return rows


@pytest.mark.parametrize("collide", [False, True])
def test_exact_groups(spark, monkeypatch, collide):
    if collide:
        monkeypatch.setattr(exact_dedup, "identifiers_collide", lambda *a: True)
    rows = exact_rows()
    ids = {}
    for i, t, _ in rows:
        ids.setdefault(t or "", []).append(i)
    want = []
    for i, t, _ in rows:
        mine = ids[t or ""]
        keep = max((x for x in mine if x is not None), default=None)
        want.append((i, keep, len(mine), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    found = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string, recipe string").repartition(4))
    assert sorted((tuple(r)[:5] for r in found.collect()), key=repr) == sorted(want, key=repr)
    assert exact_dedup.exact_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_chunks_concatenate_and_follow_content(spark):
    rows = spark.createDataFrame(exact_rows(), "doc_id long, text string, recipe string")
    parts = rows.select("text", exact_dedup.chunks(F.col("text")).alias("c")).collect()
    assert all("".join(r["c"]) == (r["text"] or "") and all(len(x) <= 4096 for x in r["c"]) for r in parts)
    rng = random.Random(3)
    text = "".join(" ".join(f"w{rng.randrange(999)}" for _ in range(9)) + ". " for _ in range(900))
    one, two = [r["c"] for r in spark.createDataFrame([(text,), ("new " * 100 + text,)], "t string").select(exact_dedup.chunks(F.col("t")).alias("c")).collect()]
    assert len(set(one) - set(two)) < len(one) / 2  # chunks fall together again behind the insertion


def test_colliding_identifiers_are_seen(spark, monkeypatch):
    docs = spark.createDataFrame(exact_rows(), "doc_id long, text string, recipe string")
    assert not exact_dedup.identifiers_collide(docs)
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: F.lit(1))
    assert exact_dedup.identifiers_collide(docs)


def line_rows():
    rng = random.Random(2)
    rows = []
    for i in range(200):
        site = rng.choice(["a", "a", "a", "b", None, "tiny" if i < 8 else "a"])
        own = [f"line {rng.randrange(10_000)}" for _ in range(rng.randrange(0, 6))]
        if rng.random() < 0.4:
            own.insert(rng.randrange(len(own) + 1), rng.choice(["  menu\t", "menu", "menu\r"]))
        if rng.random() < 0.05:
            own += ["rare"] * 9
        rows.append((i, rng.choice(["\n", "\n\n"]).join(own), site, "x"))
    return rows + [(300, None, "a", "x"), (301, "", "a", "x"), (302, "menu", "a", "x"), (302, "menu", "a", "x"), (None, "menu\nmore", "b", "x")]


def test_boilerplate_lines(spark):
    rows = line_rows()
    pages, count = {}, {}
    for _, text, site, _ in rows:
        pages[site] = pages.get(site, 0) + 1
        for bare in {x.strip(" \t\r") for x in (text or "").split("\n")} - {""}:
            count[site, bare] = count.get((site, bare), 0) + 1
    gone = {k for k, n in count.items() if n >= 5 and n > 0.1 * pages[k[0]]}
    want = []
    for i, text, site, _ in rows:
        kept = [x for x in (text or "").split("\n") if (site, x.strip(" \t\r")) not in gone]
        n = len(text.split("\n")) if text is not None else 0
        want.append((i, None if text is None else "\n".join(kept), site, n, n - len(kept) if n else 0))
    found = line_dedup.drop_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string, n_lines string").repartition(4))
    assert found.columns == ["doc_id", "text", "source", "n_lines", "_n_lines", "n_dropped"]
    got = [(r["doc_id"], r["text"], r["source"], r["_n_lines"], r["n_dropped"]) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and {s for s, _ in gone} >= {"a", "b", None}
    assert line_dedup.drop_boilerplate(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


def test_copies_that_count_once_keep_their_lines(spark):
    copied = "first line\nsecond line\nmenu"
    rows = [(i, copied, "a", "x") for i in range(40)] + [(100 + i, f"own {i}\nmenu", "a", "x") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_lines string")
    every = {r["doc_id"]: r["text"] for r in line_dedup.drop_boilerplate(docs).collect()}
    once = {r["doc_id"]: r["text"] for r in line_dedup.drop_boilerplate(docs, copies_count=False).collect()}
    assert every[0] == "" and once[0] == "first line\nsecond line" and once[100] == every[100] == "own 0"
    plan = line_dedup.drop_boilerplate(docs, copies_count=False)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_native_plans(spark):
    """No Python in the plans of the native operators."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for frame in (exact_dedup.exact_dedup(docs), line_dedup.drop_boilerplate(docs)):
        assert not re.search("Python|Pandas|Arrow", frame._jdf.queryExecution().executedPlan().toString())
