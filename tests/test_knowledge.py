"""Documents and retrieval against direct computations."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from airsight.operators import corpus, retrieval
from airsight.sources import documents, sinks, versions


def chunks_by_hand(text, size, overlap):
    step = size if overlap >= size else size - overlap
    return [c for c in (text[i : i + size].strip() for i in range(0, len(text), step)) if c] if text.strip() else []


@pytest.mark.parametrize("size,overlap", [(500, 100), (10, 3), (10, 9), (7, 7), (4, 9), (9, 0)])
def test_chunks(spark, size, overlap):
    texts = ["", " \n\t ", "a" * 1, *["ab " * n for n in (133, 134, 167, 300)], "x" * 399, "x" * 400, "x" * 401, "x" * 500, "x" * 501, "x" * 900,
             "a" * 300 + " " * 500 + "b" * 300, "😀é" * 350, "line\r\nline\x85 end　" * 30]
    df = spark.createDataFrame([(i, f"d{i}.txt", "c", t) for i, t in enumerate(texts)], "id int, filename string, category string, text string")
    got = corpus.chunk_documents(df, size=size, overlap=overlap).orderBy("id", "chunk_index").collect()
    for i, t in enumerate(texts):
        mine = [r for r in got if r["id"] == i]
        assert [r["text"] for r in mine] == chunks_by_hand(t, size, overlap)
        assert [r["chunk_id"] for r in mine] == [f"d{i}.txt_chunk_{j}" for j in range(len(mine))]


def test_chunk_size_must_be_positive(spark):
    with pytest.raises(ValueError):
        corpus.chunk_documents(spark.createDataFrame([("a", "b", "c")], "filename string, category string, text string"), size=0)


def nearest_by_hand(queries, rows, k, threshold):
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    sims = unit(queries) @ unit(rows).T
    out = {}
    for q, line in enumerate(sims):
        order = sorted(range(len(line)), key=lambda i: (-round(line[i], 10), i))[:k]
        out[q] = [(i, round(max(0.0, line[i]), 4)) for i in order if max(0.0, line[i]) >= threshold]
    return out


@pytest.mark.parametrize("limit", [None, "2000"])
def test_vector_topk(spark, limit):
    rng = np.random.default_rng(7)
    rows = rng.normal(size=(90, 8))
    rows[30:60] = rows[3]  # a third of the corpus is one vector
    queries = np.vstack([rows[:20] + 0.01, -rows[3:4]])
    corpus_df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "id long, embedding array<double>").repartition(6)
    query_df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(queries)], "q long, embedding array<double>")
    if limit:
        spark.conf.set("airsight.maxBroadcastBytes", limit)
    got = retrieval.vector_topk(query_df, corpus_df, "q", "id", k=5, threshold=0.3).orderBy("q", "rank").collect()
    spark.conf.unset("airsight.maxBroadcastBytes")
    mine = {q: [(r["id"], r["similarity"]) for r in got if r["q"] == q] for q in range(len(queries))}
    assert mine == nearest_by_hand(queries, rows, 5, 0.3)


def test_few_pairs_are_ranked(monkeypatch):
    """Beside the rows that set the floor, only pairs near a query's best are ranked; ties and copies go to the smaller id, in any order of adding."""
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(6000, 16))
    rows[1000:1500] = rows[7]
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    asked, keys = rows[:200], rng.permutation(6000)
    ranked, rank = [], retrieval._Best._rank
    monkeypatch.setattr(retrieval._Best, "_rank", lambda self, q, c, *rest: ranked.append(len(q)) or rank(self, q, c, *rest))
    monkeypatch.setattr(retrieval._Best, "cells", 50_000)
    best = retrieval._Best(200, 3)
    for part in np.array_split(np.arange(6000), 4):
        best.add(asked, rows[part], keys[part])
    shown = np.round(asked @ rows.T, 10)
    expected = [keys[np.lexsort((keys, -line))[:3]].tolist() for line in shown]
    assert best.keys.tolist() == expected and 0 < sum(ranked) < 200 * 6000 / 20


@pytest.mark.parametrize("limit", [None, "20000"])
def test_pruned_search_against_exact(spark, limit):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(25, 16)) * 2
    rows = centres[rng.integers(0, 25, 1200)] + rng.normal(size=(1200, 16))
    rows[::3] = centres[0] + rng.normal(size=(400, 16)) * 0.2  # a third of the corpus is one hot cell
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)] + [(5000, None), (None, rows[0].tolist()), (5001, [0.0] * 16)], "id long, embedding array<double>")
    asked = df.select(F.col("id").alias("q"), "embedding").repartition(5)
    if limit:
        spark.conf.set("airsight.maxBroadcastBytes", limit)
    try:
        exact, pruned, whole = (
            {tuple(r) for r in found.select("q", "id", "similarity").collect()}
            for found in (
                retrieval.vector_topk(asked, df, "q", "id", k=5, threshold=0.3),
                retrieval.vector_topk_pruned(asked, df, "q", "id", k=5, threshold=0.3),
                retrieval.vector_topk_pruned(asked, df, "q", "id", k=5, threshold=0.3, cells=10, probes=10),
            )
        )
    finally:
        spark.conf.unset("airsight.maxBroadcastBytes")
    assert whole == exact and len(exact) > 5000
    assert len(exact & pruned) >= 0.95 * len(exact) and len(pruned) <= len(exact)
    assert retrieval.vector_topk_pruned(asked, df.limit(0), "q", "id").count() == 0
    assert retrieval.vector_topk_pruned(asked.limit(0), df, "q", "id").count() == 0


@pytest.mark.parametrize("n", [400, 4000])
def test_probes_follow_from_recall(spark, n):
    """Noise without groups is the hard case: few probes would lose most neighbours, and more cells ask for more probes."""
    rows = np.random.default_rng(n).normal(size=(n, 12))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "id long, embedding array<double>")
    asked = df.filter("id % 4 = 0").select(F.col("id").alias("q"), "embedding")
    cells = retrieval.fit_cells(asked, df, "q", "id", k=5, calibration=150)
    exact, pruned = (
        {(r["q"], r["id"]) for r in found.collect()}
        for found in (
            retrieval.vector_topk(asked, df, "q", "id", k=5, threshold=-1.0), retrieval.vector_topk_pruned(asked, df, "q", "id", k=5, threshold=-1.0, fitted=cells)
        )
    )
    assert len(exact & pruned) >= 0.9 * len(exact) and 8 <= cells.probes <= len(cells.centres) == round(n**0.5)
    assert retrieval.fit_cells(asked.limit(0), df, "q", "id").probes == 1 and len(retrieval.fit_cells(asked, df.limit(0), "q", "id").centres) == 1


def test_vector_topk_with_text_ids_and_few_rows(spark):
    corpus_df = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [2.0, 0.0])], "id string, embedding array<double>")
    queries = spark.createDataFrame([("q", [1.0, 0.0])], "q string, embedding array<double>")
    assert [(r["id"], r["rank"]) for r in retrieval.vector_topk(queries, corpus_df, "q", "id").orderBy("rank").collect()] == [("a", 1), ("b", 2)]
    assert retrieval.vector_topk(queries.filter("false"), corpus_df, "q", "id").count() == 0


def context_by_hand(chunks, budget):
    """Straight reading of the packing rule: number, cut at the remaining budget, stop when it is used up."""
    seen, unique = set(), []
    for c in sorted(chunks, key=lambda c: (-c[1], c[2])):
        mark = " ".join(c[0].split())[:120]
        if mark and mark not in seen:
            seen.add(mark)
            unique.append(c)
    used, entries = 0, []
    for i, c in enumerate(unique, start=1):
        body = " ".join(c[0].split())
        room = budget - used
        if room <= 0:
            break
        entry = f"[{i}] {c[3]}:\n" + (body[:room] + "…" if len(body) > room else body)
        entries.append(entry)
        used += len(entry)
    return "\n\n".join(entries), used, len(unique)


@pytest.mark.parametrize("budget", [0, 1, 15, 40, 300])
def test_context(spark, budget):
    rng = np.random.default_rng(budget)
    rows = []
    for q in range(25):
        for rank in range(int(rng.integers(0, 60 if q == 0 else 6))):
            words = " \n ".join("w" * int(n) for n in rng.integers(1, 9, int(rng.integers(0, 12))))
            rows.append((q, rank, float(rng.integers(0, 4)) / 4, f"s{rank % 3}", words))
    df = spark.createDataFrame(rows, "q int, rank int, similarity double, source string, text string")
    got = {r["q"]: r for r in retrieval.context_blocks(df, "q", budget).collect()}
    for q in range(25):
        text, used, unique = context_by_hand([(r[4], r[2], r[1], r[3]) for r in rows if r[0] == q], budget)
        assert (q in got) == (unique > 0)
        if unique:
            assert (got[q]["context"] or "", got[q]["context_chars"] or 0, got[q]["chunks_used"]) == (text, used, unique)


@pytest.fixture
def found(spark):
    return spark.createDataFrame(
        [(1, 1, 0.9, "a.pdf", "Air", "x " * 150), (1, 2, 0.9, "a.pdf", "Air", "other"), (1, 3, 0.5, "b.txt", "Air", "text"), (2, 1, 0.41, "c.txt", "Soil", "only")],
        "q int, rank int, similarity double, source string, category string, text string",
    )


def test_citations(spark, found):
    answers = spark.createDataFrame([(1, "[a.pdf] and [zz.docx], [a.pdf] [no suffix] [x[y.md]"), (2, "none"), (3, "[a.pdf]")], "q int, answer string")
    rows = {r["q"]: r for r in retrieval.citation_result(answers, found, "q", "m").collect()}
    assert [(s["filename"], s["similarity"]) for s in rows[1]["sources"]] == [("a.pdf", 0.9), ("b.txt", 0.5)]
    assert rows[1]["sources"][0]["excerpt"] == ("x " * 100).strip() + " …"
    assert (rows[1]["confidence"], rows[2]["confidence"], rows[3]["confidence"]) == ("High", "Medium", "Low")
    assert rows[1]["cited"] == ["a.pdf", "y.md", "zz.docx"] and rows[1]["not_retrieved"] == ["y.md", "zz.docx"]
    assert rows[3]["sources"] is None and rows[3]["not_retrieved"] == ["a.pdf"] and rows[2]["cited"] == []
    left = retrieval.uncited_sources(answers, found, "q").collect()
    assert sorted(map(tuple, left)) == [(1, "y.md"), (1, "zz.docx"), (3, "a.pdf")]


def test_prompts(spark, found):
    asked = spark.createDataFrame([(1, " why? ", "Industrial", None), (3, "how", None, None)], "q int, question string, city_type string, trend string")
    full = {r["q"]: r for r in retrieval.prompt_table(asked, found, "q").collect()}
    assert full[1]["user"].startswith("Prediction: Area=Industrial\n\nRETRIEVED CONTEXT:\n[1] a.pdf:\nx x")
    assert "\n\nQUESTION: why?\n\nProvide: 1)" in full[1]["user"] and full[1]["chunks_used"] == 3
    assert full[3]["user"].startswith("RETRIEVED CONTEXT:\nNo relevant documents found.\n\nQUESTION: how") and full[3]["context_chars"] == 0
    assert full[1]["total_chars"] == len(full[1]["system"]) + len(full[1]["user"]) and full[1]["est_tokens"] == full[1]["total_chars"] // 4
    small = {r["q"]: r for r in retrieval.reduced_prompt_table(asked, found, "q").collect()}
    assert small[1]["chunks_used"] == 2 and small[1]["user"].startswith("RETRIEVED CONTEXT:")
    enriched = {r["q"]: r["enriched"] for r in retrieval.enrich_query(asked).collect()}
    assert enriched == {1: "Prediction context — Area type: Industrial\n\n why? ", 3: "how"}


def test_folder_scan_index_and_refresh(spark, tmp_path):
    base = tmp_path / "Knowledge Base"
    (base / "Air" / "deep").mkdir(parents=True)
    (base / "Air" / "deep" / "One+x.TXT").write_text("café " * 200, encoding="utf-8")
    (base / "Air" / "latin.txt").write_bytes("café".encode("latin-1"))
    (base / "top.txt").write_text(" ")
    (base / "skip.md").write_text("no")
    (base / "scan.pdf").write_bytes(b"%PDF")
    scanned = {r["path"]: r for r in documents.scan_documents(spark, str(base)).collect()}
    assert set(scanned) == {"Air/deep/One+x.TXT", "Air/latin.txt", "top.txt", "scan.pdf"}
    assert scanned["Air/deep/One+x.TXT"]["category"] == "Air" and scanned["top.txt"]["category"] == "General" and scanned["scan.pdf"]["size"] == 4
    docs = documents.read_text_documents(spark, str(base))
    texts = {r["path"]: r["text"] for r in docs.collect()}
    assert texts["Air/latin.txt"] == "café" and texts["top.txt"] == " " and texts["Air/deep/One+x.TXT"].startswith("café café")

    encode = lambda chunks: corpus.encode_with(chunks, lambda ts: np.array([[len(t), 1.0] for t in ts]))
    chunks = corpus.chunk_documents(docs.select("path", "filename", "category", "text"), key="path")
    sinks.write_index(encode(chunks), str(tmp_path / "index"), "path")
    sinks.write_manifest(docs, str(tmp_path / "manifest"))
    index = sinks.read_index(spark, str(tmp_path / "index"), "path")
    assert index.count() == 4 and sinks.read_index(spark, str(tmp_path / "none")) is None
    assert all(abs(sum(x * x for x in r["embedding"]) - 1) < 1e-6 for r in index.collect())

    (base / "Air" / "latin.txt").write_text("new text")
    (base / "top.txt").unlink()
    (base / "Air" / "two.txt").write_text("fresh")
    spark.catalog.clearCache()
    later = documents.read_text_documents(spark, str(base))
    diff = corpus.manifest_diff(sinks.read_manifest(spark, str(tmp_path / "manifest")), later)
    assert {r["path"]: r["status"] for r in diff.collect()} == {
        "Air/deep/One+x.TXT": "same", "Air/latin.txt": "changed", "Air/two.txt": "added", "top.txt": "removed",
    }
    assert corpus.needs_rebuild(diff, index) and corpus.needs_rebuild(diff, None) and not corpus.needs_rebuild(diff.filter("status = 'same'"), index)
    fresh = corpus.refresh_index(index, later.select("path", "filename", "category", "text"), diff, "path", encode)
    whole = encode(corpus.chunk_documents(later.select("path", "filename", "category", "text"), key="path"))
    key = lambda df: sorted((r["chunk_id"], r["text"], tuple(r["embedding"])) for r in df.collect())
    assert key(fresh) == key(whole) and fresh.count() == 5


def test_index_versions(spark, tmp_path, monkeypatch):
    """Refresh in place, parts that are named and not copied, a refresh that is killed, old versions cleared."""
    path, encoded = str(tmp_path / "index"), []

    def encode(chunks):
        encoded.append(chunks.select("path").distinct().count())
        return corpus.encode_with(chunks, lambda ts: np.array([[len(t), 1.0] for t in ts]))

    def docs(**texts):
        rows = [(k, str(hash(t)), t, f"{k}.txt", "General") for k, t in texts.items()]
        return spark.createDataFrame(rows, "path string, hash string, text string, filename string, category string")

    def texts():
        return sorted((r["path"], r["text"]) for r in sinks.read_index(spark, path, "path").collect())

    assert sinks.read_index(spark, path, "path") is None
    assert sinks.refresh_index(spark, path, docs(a="one", b="two", blank=" "), "path", encode) == {"added": 3}
    assert texts() == [("a", "one"), ("b", "two")]
    assert sinks.refresh_index(spark, path, docs(a="one", b="two", blank=" "), "path", encode) == {"same": 3} and len(encoded) == 1
    assert sinks.refresh_index(spark, path, docs(a="one", b="2", c="three"), "path", encode) == {"same": 1, "changed": 1, "added": 1, "removed": 1}
    assert texts() == [("a", "one"), ("b", "2"), ("c", "three")] and encoded == [2, 2]
    first = {r["_part"] for r in versions.current(spark, path).filter("path = 'a'").collect()}
    assert len(list((tmp_path / "index" / "parts").iterdir())) == 2 and len(first) == 1

    def killed(frame):
        raise InterruptedError

    with pytest.raises(InterruptedError):  # before anything is written
        sinks.refresh_index(spark, path, docs(z="new"), "path", killed)
    number = versions.commit(spark, path, "path", sinks.read_index(spark, path, "path").limit(1))
    (tmp_path / "index" / "versions" / f"{number:012d}" / "_SUCCESS").unlink()  # killed while the version was written
    assert texts() == [("a", "one"), ("b", "2"), ("c", "three")]

    more = encode(corpus.chunk_documents(docs(d="four").drop("hash"), key="path"))
    assert sinks.write_index(sinks.read_index(spark, path, "path").unionByName(more), path, "path") == number + 1  # the index from its own rows
    assert texts() == [("a", "one"), ("b", "2"), ("c", "three"), ("d", "four")]
    assert versions.vacuum(spark, path, keep=1) > 0 and len(list((tmp_path / "index" / "parts").iterdir())) == 1
    assert len(texts()) == 4 and sinks.refresh_index(spark, path, docs(), "path", encode)["removed"] == 4 and texts() == []


def test_hashing_encoder(spark):
    df = spark.createDataFrame([("air quality report",), ("water quality",), ("traffic",)], "text string")
    model = corpus.fit_hashing_encoder(df)
    got = [r["embedding"] for r in corpus.encode_hashing(model, df).collect()]
    assert all(len(v) == 384 and abs(sum(x * x for x in v) - 1) < 1e-5 for v in got)


def test_hashing_vectors_against_plain(spark):
    import hashlib
    import math

    texts = ["Air quality air", "air quality air", "Wasser \xc9t\xe9", "", None, "  ", "air", "air", "x " * 3000]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    counts = {}
    for t in {t for t in texts if t and t.split()}:
        at = counts.setdefault(t, {})
        for token in t.lower().split():
            place = int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % 16
            at[place] = at.get(place, 0) + 1
    n = len({t for t in texts if t is not None})
    expected = {}
    for t, at in counts.items():
        w = {p: c * math.log((n + 1) / (sum(p in o for o in counts.values()) + 1)) for p, c in at.items()}
        size = math.sqrt(sum(x * x for x in w.values()))
        expected[t] = [w.get(p, 0.0) / size for p in range(16)]
    found = corpus.embed_hashing(rows, "text", 16).collect()
    assert len(found) == len(texts)
    for r in found:
        assert r["embedding"] == pytest.approx(expected.get(r["text"], [0.0] * 16), abs=1e-6)


def test_tokens_are_counted_where_texts_are_read(spark, monkeypatch):
    """What is shuffled has a row per text, not one per token or place; white space other than ASCII parts no tokens."""
    import hashlib

    texts = ["a\x0bb\x0cc\u00a0d\u2003e\x1cf\x85g \u0130x \u03a3\u03a3", "one two three four", "one two three four", "", None]
    kept, keep = [], corpus.stage
    monkeypatch.setattr(corpus, "stage", lambda df, label: kept.append(keep(df, label)) or kept[-1])
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    places = {(r["digest"], r["place"]) for r in corpus.hashing_vectors(rows, "text", 64).collect()}
    assert kept[0].count() == 3
    native = rows.selectExpr("sha2(text, 256) AS digest", r"explode(regexp_extract_all(lower(text), '[^\\x20\\x09-\\x0D]+', 0)) AS t").collect()
    assert len({r["t"] for r in native}) == 9
    assert places == {(r["digest"], int(hashlib.md5(r["t"].encode()).hexdigest()[:8], 16) % 64) for r in native}


def test_cited_pattern(spark):
    answer = "See [A b.pdf] [x.toolong] [y.c1] [z.txt]"
    assert re.findall(r"\[([^\[\]]+?\.[a-zA-Z]{2,5})\]", answer) == ["A b.pdf", "z.txt"]
    assert spark.createDataFrame([(answer,)], "a string").select(retrieval.cited_names(F.col("a"))).first()[0] == ["A b.pdf", "z.txt"]
