"""Legacy ARC archives converted to WARC: version-specific headers and declared lengths in, synthesised WARC records out."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airsight.session import lookup, stage, staged_path

#: Equal payloads of at least so many bytes are stored once and revisited.
REVISIT_BYTES = 1000
#: Records of a volume at most, with the one that describes it.
VOLUME_RECORDS = 2_000
#: Pieces that a volume is written in, and bytes of records in a piece; a record of more is a piece of its own.
VOLUME_PIECES, PIECE_BYTES = 4, 32 << 20
#: Date of capture where the source has none.
CAPTURED = "20240101000000"

# Fixed values of the archive formats.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
VOLUME_URL = "filedesc://"
ARC_VERSION_LINE = {1: "1 0 airsight", 2: "2 0 airsight"}
WARC_VERSION = "WARC/1.1"
WARC_BETWEEN = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FAST_GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


class ArchiveError(ValueError):
    """A record does not have the form or the length that its header declares."""


def _header_value(text: str) -> str:
    return "".join("%{:02X}".format(ord(c)) if c <= " " or c == "\x7f" else c for c in text)


def http_block(page_id: int | None, payload: bytes) -> bytes:
    own = f"X-Page-Id: {page_id}\r\n" if page_id is not None else ""
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n{own}Content-Length: {len(payload)}\r\n\r\n".encode() + payload


def arc_record(version: int, url: str, kind: str, block: bytes, offset: int, volume: str, ip: str = "0.0.0.0", date: str = CAPTURED, status: str = "200") -> bytes:
    """Header line in the version's layout, then the block; what separates records comes with the writer."""
    middle = "" if version == 1 else f" {status} - - {offset} {volume}"
    return f"{_header_value(url) or '-'} {ip} {date} {kind}{middle} {len(block)}\n".encode() + block


class _Pieces:
    """Records of a task gathered to pieces, one row of the text writer each, and pieces to volumes of ``VOLUME_PIECES``.

    A piece ends after its share of a volume's ``records`` or before the record that would take it over ``limit`` bytes, so a volume has a bound
    in both. ``between`` is what the writer puts behind a row, and what stands between the records of a piece.
    """

    def __init__(self, records: int, limit: int, between: bytes):
        self.most, self.limit, self.between = max(1, records // VOLUME_PIECES), limit, between
        self.held: list[bytes] = []
        self.bytes = self.pieces = 0

    def ends_before(self, size: int) -> bool:
        return bool(self.held) and (len(self.held) >= self.most or self.bytes + size > self.limit)

    def at_volume(self) -> bool:
        """Whether the next record is the first of a volume."""
        return not self.held and self.pieces % VOLUME_PIECES == 0

    def add(self, record: bytes) -> None:
        self.held.append(record)
        self.bytes += len(record)

    def end(self) -> pa.RecordBatch:
        piece = pa.array([self.between.join(self.held)], pa.binary())
        self.held, self.bytes, self.pieces = [], 0, self.pieces + 1
        return pa.RecordBatch.from_arrays([piece], names=["value"])


def _arc_volumes(version: int, records: int, limit: int):
    """(page_id, url, html) to the pieces of volumes, each volume begun by its description."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, pieces, offset, volume = TaskContext.get().partitionId(), _Pieces(records, limit, b"\n"), 0, ""
        for batch in batches:
            for page_id, url, html in zip(*(batch.column(c) for c in ("page_id", "url", "html"))):
                block = http_block(page_id.as_py(), (html.as_py() or "").encode("utf-8", "surrogatepass"))
                if pieces.ends_before(len(block)):
                    yield pieces.end()
                if pieces.at_volume():
                    volume = f"pages-v{version}-{part:06d}-{pieces.pieces // VOLUME_PIECES:06d}.arc"
                    described = f"{ARC_VERSION_LINE[version]}\n{ARC_FIELDS[version]}\n".encode()
                    pieces.add(arc_record(version, f"{VOLUME_URL}{volume}", "text/plain", described, 0, volume))
                    offset = pieces.bytes + 1
                record = arc_record(version, url.as_py() or "about:blank", "text/html", block, offset, volume)
                pieces.add(record)
                offset += len(record) + 1
        if pieces.held:
            yield pieces.end()

    return run


def write_arc(pages: DataFrame, path: str, version: int, records: int = VOLUME_RECORDS, limit: int = PIECE_BYTES) -> None:
    """Write ``pages`` (page_id, url, html) as gzipped ARC volumes of one version, through Spark's text writer.

    A row of the writer is a piece of a volume: records with line feeds between them. The writer puts the line feed behind each piece and begins a
    file after ``VOLUME_PIECES`` of them, in step with the volumes' first records. So volumes have at most ``records`` records, and as many times
    ``limit`` bytes as they have pieces unless single records are longer.
    """
    raw = pages.select("page_id", "url", "html").mapInArrow(_arc_volumes(version, records, limit), "value binary")
    raw.select(F.col("value").cast("string")).write.options(maxRecordsPerFile=VOLUME_PIECES, lineSep="\n", **FAST_GZIP).text(path)


def iso_date(arc_date: str) -> str:
    """WARC date of an ARC date of up to 14 digits; what is missing is the first month, day or second."""
    digits = arc_date if arc_date.isdigit() else CAPTURED
    d = (digits + "00000101000000"[len(digits) :])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:]}Z"


def arc_records(content: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, version, header fields, block) of every record of a gzipped or plain ARC file, one record in memory at a time.

    The volume's first record names the version, which sets the layout of all header lines. Fields are taken from the right, as old URLs
    may have spaces. Blocks have the declared length, whatever line feeds they hold.
    """
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content))) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    version, offset = 0, 0
    while line := stream.readline():
        start, offset = offset, offset + len(line)
        if line in (b"\n", b"\r\n"):  # between records
            continue
        text = line.decode("utf-8", "surrogateescape").rstrip("\r\n")
        length = int(text.rsplit(" ", 1)[-1])
        block = stream.read(length)
        offset += len(block)
        if len(block) != length:
            raise ArchiveError(f"a record at byte {start} declares {length} bytes and has {len(block)}")
        if not version:
            if not text.startswith(VOLUME_URL) or block[:2] not in (b"1 ", b"2 "):
                raise ArchiveError("an ARC file begins with the description of its version")
            version = int(block[:1])
        names = ARC_FIELDS[version].split(" ")
        values = text.rsplit(" ", len(names) - 1)
        if len(values) != len(names):
            raise ArchiveError(f"the header at byte {start} has not the fields of version {version}")
        yield start, version, dict(zip(names, values)), block


def http_parts(block: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields by lower-case name, the header's bytes with the empty line, and the payload; all payload without an HTTP status line."""
    end = block.find(b"\r\n\r\n")
    if not block.startswith(b"HTTP/") or end < 0:
        return {}, b"", block
    lines = block[:end].decode("latin-1").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, block[: end + 4], block[end + 4 :]


def _number(text: str | None) -> int | None:
    return int(text) if text and text.lstrip("-").isdigit() else None


def record_id(volume: str, offset: int) -> str:
    """The identifier that a record at that place of a volume always gets, wherever the volume's file lies."""
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{volume}#{offset}')}"


def _arc_index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, content) to a narrow row per captured record. ``volume`` is the name that the file's first record states."""
    names = ["path", "volume", "offset", "version", "page_id", "url", "date", "payload_bytes", "digest"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            out, volume = [], ""
            for offset, version, head, block in arc_records(content.as_py()):
                if head["URL"].startswith(VOLUME_URL):
                    volume = volume or head["URL"].removeprefix(VOLUME_URL)
                    continue
                fields, _, payload = http_parts(block)
                out.append((path, volume, offset, version, _number(fields.get("x-page-id")), head["URL"], head["Archive-date"], len(payload), hashlib.sha1(payload).hexdigest()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


def archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, content): whole archive files as Spark's reader finds them, one volume a row."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")


def arc_index(files: DataFrame) -> DataFrame:
    return files.mapInArrow(_arc_index, "path string, volume string, offset long, version int, page_id long, url string, date string, payload_bytes long, digest string")


def volume_names(index: DataFrame) -> DataFrame:
    """(path, name) per ARC file with records: the volume's name, and the path with it where several files state one name."""
    files = index.select("path", "volume").distinct()
    shared = files.groupBy("volume").agg(F.count("*").alias("files")).filter("files > 1").select("volume", F.lit(True).alias("shared"))
    name = F.when(F.col("shared"), F.concat_ws("@", "volume", "path")).otherwise(F.col("volume"))
    return files.join(shared, "volume", "left").select("path", name.alias("name"))


def revisits(index: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """(path, revisits) of an index with ``name``: per ARC file the offsets of records that revisit another, with where that one is.

    Of records with equal payloads of at least ``least`` bytes the one with the largest page id is the response, and of several with that id
    the last by name and offset. Payloads are equal by SHA-1 and length. Digests are grouped inside the tasks first; a digest that a third of all
    records share joins by a small table or a split key.
    """
    large = index.filter(F.col("payload_bytes") >= least)
    first = F.max(F.struct("page_id", "name", "offset", "url", "date")).alias("first")
    groups = large.groupBy("digest", "payload_bytes").agg(F.count("*").alias("n"), first).filter("n > 1")
    heads = lookup(groups.select("digest", "payload_bytes", "first"), "payload-heads")
    others = large.join(heads, ["digest", "payload_bytes"]).filter((F.col("name") != F.col("first.name")) | (F.col("offset") != F.col("first.offset")))
    each = others.select("path", F.struct("offset", F.col("first.name").alias("to_name"), F.col("first.offset").alias("to_offset"), F.col("first.url").alias("url"), F.col("first.date").alias("date")).alias("r"))
    return each.groupBy("path").agg(F.collect_list("r").alias("revisits"))  # at most the records of a volume


def warc_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """Header and block; the writer puts the two closing line ends behind it."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return f"{WARC_VERSION}\r\n{lines}\r\n".encode("utf-8", "surrogateescape") + block


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def convert(volume: str, offset: int, head: dict[str, str], block: bytes, to: dict | None) -> bytes:
    """The WARC record of an ARC record: identifier, ISO date, type and digests synthesised, headers of the capture kept.

    A block with an HTTP header becomes a response, or a revisit of ``to`` without its payload; any other becomes a resource.
    """
    fields, http, payload = http_parts(block)
    kind = "resource" if not http else "revisit" if to else "response"
    headers = [
        ("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id(volume, offset)}>"), ("WARC-Date", iso_date(head["Archive-date"])),
        ("WARC-Target-URI", head["URL"]), ("WARC-IP-Address", head["IP-address"]), ("WARC-Payload-Digest", _digest(payload)),
    ]
    if kind == "revisit":
        headers += [
            ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{record_id(to['to_name'], to['to_offset'])}>"),
            ("WARC-Refers-To-Target-URI", to["url"]), ("WARC-Refers-To-Date", iso_date(to["date"])),
        ]
        block = http
    headers += [("WARC-Block-Digest", _digest(block)), ("Content-Type", head["Content-type"] if kind == "resource" else "application/http; msgtype=response")]
    return warc_record(headers, block)


def _warc_volumes(records: int, limit: int):
    """(name, content, revisits) to the pieces of WARC volumes, each volume begun by a warcinfo record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, pieces = TaskContext.get().partitionId(), _Pieces(records, limit, WARC_BETWEEN)
        for batch in batches:
            for name, content, to in zip(batch.column("name").to_pylist(), batch.column("content"), batch.column("revisits").to_pylist()):
                known = {r["offset"]: r for r in to or []}
                for offset, _, head, block in arc_records(content.as_py()):
                    if head["URL"].startswith(VOLUME_URL):
                        continue
                    record = convert(name, offset, head, block, known.get(offset))
                    if pieces.ends_before(len(record)):
                        yield pieces.end()
                    if pieces.at_volume():
                        file = f"pages-{part:06d}-{pieces.pieces // VOLUME_PIECES:06d}.warc"
                        about = b"software: airsight\r\nformat: WARC File Format 1.1\r\n"
                        info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{record_id(f'{name}/{file}', 0)}>"), ("WARC-Date", iso_date(head["Archive-date"])), ("WARC-Filename", file), ("Content-Type", "application/warc-fields")]
                        pieces.add(warc_record(info, about))
                    pieces.add(record)
        if pieces.held:
            yield pieces.end()

    return run


def convert_archives(spark: SparkSession, arc_path: str, warc_path: str, records: int = VOLUME_RECORDS, limit: int = PIECE_BYTES) -> None:
    """Convert all ARC files below ``arc_path`` to gzipped WARC files in ``warc_path``, bounded as ``write_arc`` bounds its volumes.

    A first pass reads only what the records are, to find equal payloads; the second converts file by file and joins each file with the short list
    of its revisits, so that payloads are never shuffled as rows. Tasks hold one volume's compressed bytes, one piece and one record. Record
    identifiers follow from the volume's name and the record's place in it, not from the folder.
    """
    files = archives(spark, arc_path)
    index = stage(arc_index(files), "arc-index")
    names = lookup(volume_names(index), "volume-names")
    found = revisits(index.join(names, "path"))
    per_file = lookup(names.join(found, "path", "left").withColumnRenamed("path", "of_path"), "revisits")
    joined = files.join(per_file, F.col("path") == F.col("of_path")).select("name", "content", "revisits")  # files without records give none
    raw = joined.mapInArrow(_warc_volumes(records, limit), "value binary")
    raw.select(F.col("value").cast("string")).write.options(maxRecordsPerFile=VOLUME_PIECES, lineSep=WARC_BETWEEN.decode(), **FAST_GZIP).text(warc_path)


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields by lower-case name, block) of every record of a gzipped or plain WARC file."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content))) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    while line := stream.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ArchiveError(f"expected a WARC record, found {line[:40]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8", "surrogateescape").rstrip("\r\n").partition(":")
            fields[name.strip().lower()] = value.strip()
        length = int(fields["content-length"])
        block = stream.read(length)
        if len(block) != length:
            raise ArchiveError(f"a record declares {length} bytes and has {len(block)}")
        yield fields, block


def _warc_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, content) to a row per record other than warcinfo; digests of blocks and payloads are verified."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "record_id", "refers_to_id", "target_uri", "warc_date"]
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 6]
    for batch in batches:
        for content in batch.column("content"):
            out = []
            for fields, block in warc_records(content.as_py()):
                if fields["warc-type"] == "warcinfo":
                    continue
                http, _, payload = http_parts(block)
                if fields["warc-block-digest"] != _digest(block) or (fields["warc-type"] != "revisit" and fields["warc-payload-digest"] != _digest(payload)):
                    raise ArchiveError(f"record {fields['warc-record-id']} has not the digest it declares")
                size = _number(http.get("content-length")) if fields["warc-type"] == "revisit" else len(payload)
                digest = base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex()
                out.append((_number(http.get("x-page-id")), size, digest, fields["warc-type"], fields["warc-record-id"], fields.get("warc-refers-to"), fields.get("warc-target-uri"), fields["warc-date"]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """A row per record: page_id, payload_bytes, payload_digest, record_type, record_id, refers_to_id, target_uri, warc_date."""
    kinds = "page_id long, payload_bytes long, payload_digest string, record_type string, record_id string, refers_to_id string, target_uri string, warc_date string"
    return archives(spark, path).mapInArrow(_warc_rows, kinds)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as legacy ARC volumes of both versions, convert them to WARC, and describe what the WARC files hold.

    One row per page: ``page_id``, ``payload_bytes``, ``payload_digest`` (hex), ``record_type``, ``refers_to``, ``target_uri``, ``warc_date``.

    The payload is the html in UTF-8, empty for null. A null URL is written as about:blank, and white space in URLs is percent-encoded. A
    null page id has no header of its own and comes back as null, less than any other. Rows that repeat an id are records each; of
    equal payloads under one id one record is the response. A very long payload is a piece of a volume of its own, in memory once as a
    record; no text is cut. No rows give no rows. Other columns are ignored.
    """
    spark = pages.sparkSession
    arc, warc = staged_path(spark, "arc"), staged_path(spark, "warc")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    for version in ARC_FIELDS:
        half = F.pmod(F.xxhash64(F.coalesce("page_id", F.lit(0)), "url"), F.lit(2)) == version - 1
        write_arc(pages.filter(half), f"{arc}/v{version}", version)
    convert_archives(spark, arc, warc)
    records = stage(read_warc(spark, warc), "warc-index")
    asked = records.filter(F.col("refers_to_id").isNotNull()).select(F.col("refers_to_id").alias("record_id")).distinct()
    heads = lookup(records.join(asked, "record_id").select(F.col("record_id").alias("head"), F.col("page_id").alias("refers_to")), "responses")
    return records.join(heads, F.col("refers_to_id") == F.col("head"), "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri", "warc_date"
    )
