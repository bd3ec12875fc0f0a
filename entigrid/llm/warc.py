"""Legacy web archives (ARC) converted to WARC, and both read back by their declared lengths.

An ARC file begins with a version block whose second line names the version: version 1 records
have the header line ``url ip date type length``, version 2 ``url ip date type result checksum
location offset filename length``. Each record's body is as many bytes as its line declares. The
converter makes WARC records from them: the identifier from the record's place in its file, the
date from the fourteen digits, the type from what the body is, block and payload digests (SHA-1,
base32). Of records with equal payloads of at least ``least`` bytes, that with the largest page id
(ties: the last by place) stays a response, the others become revisits that refer to it.

Archives are gzipped files in the shared folder, written by Spark's text writer with the format's
own record separator, and read as binary files, a record at a time. Defined results: a null html
is the empty payload; a url that is null, empty or has white space is written as
``urn:page:<page_id>`` or with the white space percent-encoded; a null page id has no page header
and is less than all others; repeated rows are records of their own.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from entigrid.llm.common import small, stored
from entigrid.session import scratch_path

CAPTURED = "20000101000000"
FILE_BYTES = 64 << 20

# The header fields of the two ARC versions, and the version block's text.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
PAGE_HEADER = "X-Page-Id"


def _version_block(version: int) -> str:
    body = f"{version} 0 pages\n{' '.join(ARC_FIELDS[version])}\n"
    rest = "text/plain" if version == 1 else "text/plain 200 - - 0 pages.arc"
    return f"filedesc://pages.arc 0.0.0.0 {CAPTURED} {rest} {len(body)}\n{body}\n"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# Writing ARC -----------------------------------------------------------------


def _arc_text(version: int) -> Column:
    """A page as an ARC record; the first of a file comes after the version block."""
    html = F.coalesce("html", F.lit(""))
    page = F.when(F.col("page_id").isNotNull(), F.concat(F.lit(f"{PAGE_HEADER}: "), F.col("page_id").cast("string"), F.lit("\r\n"))).otherwise("")
    body = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(html).cast("string"),
        F.lit("\r\n"),
        page,
        F.lit("\r\n"),
        html,
    )
    own = F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    url = F.when(F.coalesce("url", F.lit("")) == "", own).otherwise(F.regexp_replace("url", r"\s", "%20"))
    middle = f" 0.0.0.0 {CAPTURED} text/html " + ("" if version == 1 else "200 - - 0 pages.arc ")
    record = F.concat(url, F.lit(middle), F.octet_length(body).cast("string"), F.lit("\n"), body)
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    return F.concat(F.when(first, F.lit(_version_block(version))).otherwise(""), record)


def write_arc(pages: DataFrame, version: int, path: str, file_bytes: int = FILE_BYTES) -> str:
    """One gzipped ARC file for each partition; pages(page_id, url, html)."""
    size = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    if size > file_bytes * pages.rdd.getNumPartitions():
        pages = pages.repartition(-(-size // file_bytes))
    pages.select(_arc_text(version).alias("value")).write.option("lineSep", "\n").option("compression", "gzip").text(path)
    return path


# Reading ARC -----------------------------------------------------------------


def _arc_records(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Place, header fields and body of each record, by the fields that the file's version names."""
    stream = gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    fields: list[str] | None = None
    at = 0
    while line := stream.readline():
        start, at = at, at + len(line)
        if not line.strip():
            continue
        values = line.decode("utf-8", "surrogateescape").rstrip("\r\n").split(" ")
        length = int(values[-1])
        body = stream.read(length)
        if len(body) != length:
            raise ValueError(f"a record of {length} bytes ends after {len(body)}")
        at += length
        if fields is None:
            version = int(body.split(b" ", 1)[0])
            fields = ARC_FIELDS[version]
            continue
        if len(values) != len(fields):
            raise ValueError(f"{len(values)} header fields, {len(fields)} expected: {line[:200]!r}")
        yield start, dict(zip(fields, values)), body


def _http(body: bytes) -> tuple[bytes, bytes, str | None]:
    """Head with its blank line, payload, and the page id of an HTTP response."""
    head, blank, payload = body.partition(b"\r\n\r\n")
    if not body.startswith(b"HTTP/") or not blank:
        return b"", body, None
    page = None
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == PAGE_HEADER.lower().encode():
            page = value.strip().decode()
    return head + blank, payload, page


def _name(path: str, place: int) -> str:
    return f"{path.rsplit('/', 1)[-1]}#{place}"


_INDEX = "path string, place long, page_id long, digest string, size long"


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            rows = []
            for place, _, body in _arc_records(content.as_py()):
                _, payload, page = _http(body)
                rows.append((path, place, int(page) if page else None, sha1_base32(payload), len(payload)))
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [c.split()[0] for c in _INDEX.split(", ")])


def _files(spark: SparkSession, paths: list[str]) -> DataFrame:
    own = [spark.read.format("binaryFile").load(p).select("path", "content") for p in paths]
    out = own[0]
    for df in own[1:]:
        out = out.union(df)
    return out


# Converting ------------------------------------------------------------------


def _record_id(name: str) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'arc:' + name)}"


def _warc_record(kind: str, name: str, fields: dict[str, str], body: bytes, first: str | None) -> bytes:
    head, payload, _ = _http(body)
    d = fields["Archive-date"]
    block = head if kind == "revisit" else body
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{_record_id(name)}>",
        f"WARC-Date: {d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z",
        f"WARC-Target-URI: {fields['URL']}",
        f"WARC-IP-Address: {fields['IP-address']}",
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
        f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
        f"Content-Type: {'application/http;msgtype=response' if head else fields['Content-type']}",
        f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        lines[3:3] = [f"WARC-Refers-To: <{_record_id(first)}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(lines).encode("utf-8", "surrogateescape") + b"\r\n\r\n" + block


def _kind(url: str, body: bytes) -> str:
    if body.startswith(b"HTTP/"):
        return "response"
    return "metadata" if url.startswith("metadata:") else "resource"


def _convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content, revisits in zip(batch.column("path").to_pylist(), batch.column("content"), batch.column("revisits").to_pylist()):
            firsts = {r["place"]: r["first"] for r in revisits or []}
            info = b"software: arc to warc\r\nformat: WARC file version 1.1"
            name = path.rsplit("/", 1)[-1]
            out = [
                f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <{_record_id(name)}>\r\nWARC-Date: 2000-01-01T00:00:00Z\r\n"
                f"WARC-Filename: {name}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n".encode() + info
            ]
            size = 0
            for place, fields, body in _arc_records(content.as_py()):
                first = firsts.get(place)
                kind = "revisit" if first is not None else _kind(fields["URL"], body)
                out.append(_warc_record(kind, _name(path, place), fields, body, first))
                size += len(out[-1])
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])


def convert(spark: SparkSession, arcs: list[str], path: str, least: int = 0) -> str:
    """WARC files in ``path`` from the ARC files in the given folders."""
    index = stored(_files(spark, arcs).mapInArrow(_index, _INDEX), "arc-index")
    large = index.filter(F.col("size") >= least)
    firsts = large.groupBy("digest").agg(F.max(F.struct("page_id", "path", "place")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    found = large.join(firsts, "digest").filter("path != first.path OR place != first.place")
    own = F.concat(F.element_at(F.split("first.path", "/"), -1), F.lit("#"), F.col("first.place").cast("string"))
    revisits = stored(found.select("path", "place", own.alias("first")), "revisits")
    listed = revisits.groupBy("path").agg(F.collect_list(F.struct("place", "first")).alias("revisits"))  # within a file
    few = revisits.limit(100_001).count() <= 100_000
    texts = _files(spark, arcs).join(F.broadcast(listed) if few else listed, "path", "left").mapInArrow(_convert, "value binary")
    # the bytes as they are: the writer ends each with the blank lines between records
    texts.select(F.col("value").cast("string")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)
    return path


# Reading WARC ----------------------------------------------------------------

_WARC = "record_id string, record_type string, page_id long, url string, payload_digest string, payload_bytes long, refers string"


def _warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    stream = gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a record: {line[:80]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "surrogateescape").partition(":")
            headers[name.strip().lower()] = value.strip()
        length = int(headers["content-length"])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError(f"a record of {length} bytes ends after {len(block)}")
        yield headers, block


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            rows = []
            for headers, block in _warc_records(content.as_py()):
                kind = headers["warc-type"]
                if kind == "warcinfo":
                    continue
                if headers["warc-block-digest"] != "sha1:" + sha1_base32(block):
                    raise ValueError(f"block digest of {headers['warc-record-id']} differs")
                _, payload, page = _http(block)
                digest, size = headers["warc-payload-digest"].removeprefix("sha1:"), None
                if kind != "revisit":
                    size = len(payload)
                    if digest != sha1_base32(payload):
                        raise ValueError(f"payload digest of {headers['warc-record-id']} differs")
                rows.append((headers["warc-record-id"], kind, int(page) if page else None, headers.get("warc-target-uri"), digest, size, headers.get("warc-refers-to")))
            kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
            columns = list(zip(*rows)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [c.split()[0] for c in _WARC.split(", ")])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to), one row per record.

    A revisit has no payload of its own; its size is that of the response it refers to.
    """
    records = stored(_files(spark, [path]).mapInArrow(_read, _WARC), "warc")
    used = records.filter("record_type = 'revisit'").select(F.col("refers").alias("first")).distinct()
    firsts = records.filter("record_type != 'revisit'").select(
        F.col("record_id").alias("first"), F.col("page_id").alias("first_page"), F.col("payload_bytes").alias("first_bytes"),
    )
    firsts = firsts.join(used, "first", "left_semi")
    return records.join(small(firsts), F.col("refers") == F.col("first"), "left").select(
        "page_id", "url", F.coalesce("payload_bytes", "first_bytes").alias("payload_bytes"), "payload_digest", "record_type", F.col("first_page").alias("refers_to"),
    )


def archived(pages: DataFrame, least: int = 0) -> DataFrame:
    """Pages written as ARC (even page ids version 1, odd ones version 2), converted, and the WARC
    files read back."""
    spark = pages.sparkSession
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    odd = F.coalesce(F.col("page_id") % 2 != 0, F.lit(False))
    arcs = [
        write_arc(pages.filter(~odd), 1, scratch_path(spark, "arc1")),
        write_arc(pages.filter(odd), 2, scratch_path(spark, "arc2")),
    ]
    return read_warc(spark, convert(spark, arcs, scratch_path(spark, "warc"), least))
