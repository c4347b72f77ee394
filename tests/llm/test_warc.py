"""Archives: both ARC versions parsed by declared lengths, and an exact round trip through WARC."""

import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from airsight.llm import warc

SCHEMA = "page_id long, url string, html string, offset int"
TRAPS = ["\r\n\r\n", "WARC/1.1\r\n", "\n\n", "filedesc://x 0.0.0.0 2024 text/plain 3\n", "é", "HTTP/1.1 200 OK\r\n\r\n", "\x00"]


def pages():
    rng = random.Random(6)
    shared = ["".join(rng.choices(TRAPS, k=400)) + "x" * 900, "y" * 1000, "z" * 999]
    rows = []
    for i in range(230):
        html = rng.choice([None, "", *shared, "".join(rng.choices(TRAPS, k=rng.choice([1, 9, 900])))])
        rows.append((i * 5, rng.choice([None, f"http://h/{i}", "http://h/a b\tc"]), html, 1))
    return rows + [(None, "http://n/", shared[0], 1), (10_000, "http://r/", shared[1], 1), (10_000, "http://r/", shared[1], 1)]


def expected(rows):
    payload = [(r[0], (r[2] or "").encode()) for r in rows]
    top = {}
    for i, p in payload:
        top[p] = max(top.get(p, -1), -1 if i is None else i)
    out = []
    for i, p in payload:
        revisit = len(p) >= 1000 and i != top[p]
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response", top[p] if revisit else None))
    return out


def test_round_trip(spark):
    rows = pages()
    found = warc.archive_pages(spark.createDataFrame(rows, SCHEMA).repartition(3))
    got = sorted((tuple(r)[:5] for r in found.collect()), key=repr)
    want = sorted(expected(rows), key=repr)
    # of two rows with one id and payload, one revisits the other
    want.remove((10_000, 1000, hashlib.sha1(b"y" * 1000).hexdigest(), "response", None))
    want.append((10_000, 1000, hashlib.sha1(b"y" * 1000).hexdigest(), "revisit", 10_000))
    assert got == sorted(want, key=repr)
    assert warc.archive_pages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_small_volumes(spark, tmp_path):
    docs = spark.createDataFrame([r[:3] for r in pages()], "page_id long, url string, html string").repartition(2)
    for version in (1, 2):
        warc.write_arc(docs, f"{tmp_path}/arc/v{version}", version, records=20)
    warc.convert_archives(spark, f"{tmp_path}/arc", f"{tmp_path}/warc", records=30)
    index = warc.arc_index(warc.archives(spark, f"{tmp_path}/arc"))
    assert index.count() == 2 * docs.count() and index.select("version").distinct().count() == 2
    assert index.filter("payload_bytes > 0").select("digest").distinct().count() == docs.filter("html <> ''").select("html").distinct().count()
    back = warc.read_warc(spark, f"{tmp_path}/warc")
    assert back.count() == 2 * docs.count() and back.select("record_id").distinct().count() == back.count()
    for path in (tmp_path / "warc").glob("*.gz"):  # every file is whole: warcinfo first, then full records
        records = list(warc.warc_records(path.read_bytes()))
        assert records[0][0]["warc-type"] == "warcinfo" and len(records) <= 30 and gzip.decompress(path.read_bytes()).endswith(b"\r\n\r\n")
    for path in (tmp_path / "arc").glob("*/*.gz"):
        assert next(warc.arc_records(path.read_bytes()))[2]["URL"].startswith("filedesc://")
    missing = back.filter(F.col("refers_to_id").isNotNull()).join(back.select(F.col("record_id").alias("refers_to_id")), "refers_to_id", "left_anti")
    assert missing.isEmpty()


def test_volumes_end_by_bytes(spark, tmp_path):
    """Small pieces close a volume early; a record longer than a piece is one of its own; nothing is lost or cut."""
    rows = [(i, f"http://h/{i}", "é" * (40_000 if i % 9 == 0 else 300) + str(i)) for i in range(60)]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_arc(docs, f"{tmp_path}/arc", 2, limit=5_000)
    sizes = [len(gzip.decompress(p.read_bytes())) for p in (tmp_path / "arc").glob("*.gz")]
    assert len(sizes) > 3 and max(sizes) <= warc.VOLUME_PIECES * 81_000
    for path in (tmp_path / "arc").glob("*.gz"):
        content = path.read_bytes()
        plain = gzip.decompress(content)
        for offset, version, head, block in warc.arc_records(content):  # offsets that version 2 states are the true ones
            assert version == 2 and int(head["Offset"]) == offset and plain[offset:].startswith(head["URL"].encode())
    warc.convert_archives(spark, f"{tmp_path}/arc", f"{tmp_path}/warc", limit=5_000)
    back = warc.read_warc(spark, f"{tmp_path}/warc").collect()
    assert sorted((r["page_id"], r["payload_digest"]) for r in back) == sorted((i, hashlib.sha1(h.encode()).hexdigest()) for i, _, h in rows)
    assert max(len(gzip.decompress(p.read_bytes())) for p in (tmp_path / "warc").glob("*.gz")) <= warc.VOLUME_PIECES * 82_000


def test_identifiers_do_not_name_the_folder(spark, tmp_path):
    docs = spark.createDataFrame([r[:3] for r in pages()], "page_id long, url string, html string").coalesce(1)
    ids = []
    for run in ("one", "two"):
        warc.write_arc(docs, f"{tmp_path}/{run}/arc", 1, records=40)
        warc.convert_archives(spark, f"{tmp_path}/{run}/arc", f"{tmp_path}/{run}/warc")
        ids.append(sorted((r["record_id"], str(r["refers_to_id"]), r["payload_digest"]) for r in warc.read_warc(spark, f"{tmp_path}/{run}/warc").collect()))
    assert ids[0] == ids[1] and len({i for i, _, _ in ids[0]}) == docs.count()
    # two files of one volume name: still an identifier each
    warc.write_arc(docs, f"{tmp_path}/both/a", 1, records=40)
    warc.write_arc(docs, f"{tmp_path}/both/b", 1, records=40)
    warc.convert_archives(spark, f"{tmp_path}/both", f"{tmp_path}/both-warc")
    back = warc.read_warc(spark, f"{tmp_path}/both-warc")
    assert back.count() == 2 * docs.count() == back.select("record_id").distinct().count()


def test_versions_and_faults():
    one = b"filedesc://a.arc 0.0.0.0 2006 text/plain 71\n1 0 X\nURL IP-address Archive-date Content-type Archive-length\n"
    length = len(one.split(b"\n", 1)[1])
    one = one.replace(b" 71\n", b" %d\n" % length) + b"\ndns:h 1.2.3.4 200609 text/dns 4\na\nb\n\nhttp://h/a b 1.2.3.4 20060102030405 text/html 3\nabc\n"
    found = [(h["URL"], h["Archive-date"], b) for _, _, h, b in warc.arc_records(one)][1:]
    assert found == [("dns:h", "200609", b"a\nb\n"), ("http://h/a b", "20060102030405", b"abc")]
    assert [(o, v) for o, v, _, _ in warc.arc_records(gzip.compress(one))][0] == (0, 1)
    assert warc.iso_date("200609") == "2006-09-01T00:00:00Z" and warc.iso_date("20060102030405") == "2006-01-02T03:04:05Z"
    resource = warc.convert("p", 9, {"URL": "dns:h", "Archive-date": "2006", "IP-address": "1.2.3.4", "Content-type": "text/dns"}, b"a\nb", None)
    (fields, block), = warc.warc_records(resource + b"\r\n\r\n")
    assert fields["warc-type"] == "resource" and fields["content-type"] == "text/dns" and block == b"a\nb"
    with pytest.raises(warc.ArchiveError):
        list(warc.arc_records(one[:-4]))
    with pytest.raises(warc.ArchiveError):
        list(warc.arc_records(b"http://h 1.2.3.4 2006 text/html 1\na\n"))


def test_bytes_that_are_not_utf8_pass(spark, tmp_path):
    raw = spark.createDataFrame([(bytearray(b"\xff\xfe\x00\x80a"),)], "value binary")
    raw.select(F.col("value").cast("string")).write.options(lineSep="\n").text(f"{tmp_path}/raw")
    assert b"".join(p.read_bytes() for p in (tmp_path / "raw").glob("part-*")) == b"\xff\xfe\x00\x80a\n"
