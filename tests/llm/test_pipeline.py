"""The pipeline against plain Python on a fixture with planted cases, and each stage on odd rows."""

import random
import re
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path[:0] = [str(Path(__file__).parents[2]), str(Path(__file__).parent)]

import corpus_pipeline as p  # noqa: E402
from airsight.llm import mixing  # noqa: E402
from test_ngram_join import brute as all_pairs, grams  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BAD = {"vile", "foul"}


def tables():
    """Documents with toxic words, menus, exact and near copies and benchmark items; every fifth text of the first 600 is toxic."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([8, 20])))) for i in range(6)]
    texts, labels = [], []
    for i in range(600):
        w = rng.choices(words, k=rng.choice([12, 60, 200]))
        if i % 5 == 0:
            for at in rng.sample(range(len(w)), 3):
                w[at] = rng.choice(["Vile,", "vile", "FOUL."])
        elif i % 31 == 1:
            w[5:5] = rng.choice(items)[1].split(" ")
        lines = [" ".join(w[k : k + 9]) for k in range(0, len(w), 9)]
        if i % 4 == 1:
            lines.insert(rng.randrange(len(lines) + 1), "  home contact about\t")
        texts.append("\n".join(lines))
        labels.append((i, 1, int(i % 5 == 0)))
    for i in range(600, 660):  # copies of clean texts, half of them with one word changed
        w = texts[rng.choice([1, 2, 3, 4, 6, 7])].split(" ")
        if i % 2:
            w[rng.randrange(len(w))] = f"new{i}"
        texts.append(" ".join(w))
    rows = [(i, t, "en", ["a", "a", "b", None][i % 4], len(t)) for i, t in enumerate(texts)]
    rows += [(900, None, None, None, None), (901, "", "en", "b", 0), (902, "w5 " * 30_000, "en", "c", 90_000), (None, "no id here at all", None, "a", None)]
    rows += [(2, texts[2], "en", "b", 1)]  # an id with its text again
    return rows, items, labels


def expected(rows, items):
    """(doc_id, size, source) of what reaches the mix."""
    rows = [r for r in rows if not BAD & {x.strip(".,").lower() for x in (r[1] or "").split()}]
    pages, count = {}, {}
    for site, text in {(r[3], r[1] or "") for r in rows}:  # copies count once
        pages[site] = pages.get(site, 0) + 1
        for bare in {x.strip(" \t\r") for x in (text or "").split("\n")} - {""}:
            count[site, bare] = count.get((site, bare), 0) + 1
    gone = {k for k, n in count.items() if n >= 5 and n > 0.1 * pages[k[0]]}
    rows = [(r[0], None if r[1] is None else "\n".join(x for x in r[1].split("\n") if (r[3], x.strip(" \t\r")) not in gone), r[3]) for r in rows]
    head = {(d, top) for d, _, _, _, top in all_pairs([r[:2] for r in rows])}
    once = {(r[0], r[1] or ""): r for r in rows if r[0] is not None and (r[0], r[0]) in head or r[0] is None}
    tests = [grams(t) for _, t in items]
    clean = [r for r in once.values() if not any(len(g & grams(r[1])) >= 0.8 * len(g) for g in tests)]
    return sorted(((r[0], len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")), r[2]) for r in clean), key=repr), gone, len(rows), len(once)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, items, labels = tables()
    out = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return str(out)


def test_pipeline_equals_brute_force(spark, folder):
    rows, items, _ = tables()
    want, gone, after_lines, after_join = expected(rows, items)
    assert after_lines < 560 and after_join < after_lines - 50 and len(want) < after_join - 5 and {b for _, b in gone} == {"home contact about"}
    found = p.run(spark, folder).collect()
    assert sorted(((r["doc_id"], r["size"], r["source"]) for r in found), key=repr) == want
    sizes = {}
    for _, n, source in want:
        sizes[source] = sizes.get(source, 0) + n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = dict(zip(order, mixing.water_fill([sizes[s] for s in order], [float(1 + i % 3) for i in range(len(order))])))
    for s in order:
        mine = [r for r in found if r["source"] == s]
        assert all(r["source_size"] == sizes[s] and r["target"] == pytest.approx(targets[s]) and 0 <= r["taken"] <= 3 * r["size"] for r in mine)
        assert abs(sum(r["taken"] for r in mine) - targets[s]) <= 4 * mixing.BLOCK_WORDS
    assert sorted(map(repr, p.run(spark, folder).collect())) == sorted(map(repr, found))


@pytest.mark.parametrize("name, step", p.STAGES)
def test_stage_on_odd_rows(spark, folder, name, step):
    docs = p.table(spark, folder, "documents")
    odd = docs.withColumns({c: F.lit("x") for c in ("score", "size", "boilerplate", "key", "item_id", "n_lines", "covered")})
    blank = docs.limit(40).select("doc_id", *[F.lit(None).cast(t).alias(c) for c, t in docs.dtypes if c != "doc_id"])
    no_ids = docs.limit(40).withColumn("doc_id", F.lit(None).cast("long"))
    for rows, least in ((odd, 300), (blank, 1), (no_ids, 1), (docs.limit(0), 0)):
        out = step(spark, rows, folder)
        if name != "mixing":
            assert set(p.COLUMNS) <= set(out.columns) and {c: t for c, t in out.dtypes if c in p.COLUMNS} == dict(docs.dtypes)
        n = out.count()
        assert n >= least and (least or n == 0)


def test_empty_tables_around(spark, folder, tmp_path):
    for name in ("documents", "benchmark", "labels"):
        p.table(spark, folder, name).limit(0 if name != "documents" else 30).write.parquet(f"{tmp_path}/{name}.parquet")
    assert 0 < p.run(spark, str(tmp_path)).count() <= 30


def test_stages_pass_the_columns_on(spark, folder):
    assert [name for name, _ in p.STAGES] == ["toxicity", "line_dedup", "ngram_join", "decontamination", "mixing"]
    docs = p.table(spark, folder, "documents")
    assert all(step(spark, docs, folder).columns == docs.columns for _, step in p.STAGES[:-1])
