"""WARC archives: a writer with revisit records, and a reader that salvages damaged files.

The writer puts one gzip member per record into files that Spark's text sink writes, so any
file system that Spark reaches will do. An empty member, which readers skip, ends each line.
The reader takes plain and compressed files. Where a check fails (version line, headers, length,
block digest, gzip checksum) it looks for the next place at which a record starts, goes on
there, and reports the bytes in between as a gap.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from itertools import takewhile
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palate.llm.common import batches, stage
from palate.operators.staging import staging_path

#: The smallest payload that a revisit record may stand for.
MIN_REVISIT_BYTES = 1000
#: Payload of one archive file, uncompressed.
FILE_BYTES = 48 << 20
#: The fixed 20 bytes of an empty gzip member.
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff03000000000000000000")
GZIP_MAGIC = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/\d\.\d\r?\n")
READ_SCHEMA = "path string, kind string, at long, length long, warc_type string, page_id long, url string, refers_to long, payload_digest string, payload_bytes long, payload binary, reason string, inner_at long, inner_length long"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, html: str | None, digest: bytes, refers_to: int | None, is_revisit: bool, date: str) -> bytes:
    """One record. A null id or url leaves an empty name; a null html is an empty payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if is_revisit:
        block = http + b"\r\n"
    else:
        payload = (html or "").encode()
        block = http + f"Content-Length: {len(payload)}\r\n\r\n".encode() + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {date}",
        *([f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=~-._')}"] if url is not None else []),
        *([f"WARC-Refers-To: {_urn(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] if is_revisit else []),
        f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
        f"WARC-Block-Digest: {_sha1(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> None:
    """Write every row of pages (page_id, url, html) as one record below path.

    Rows with equal payloads of MIN_REVISIT_BYTES or more: those with the largest page_id
    are response records, the others revisit it (of repeated rows, all with the largest id are
    responses). A group without any id has responses only. Digests decide equality. Other columns are ignored. An empty
    table writes no record. A file takes as many records as make up file_bytes of payload at the
    table's mean, as it is read by one task."""
    html = F.coalesce("html", F.lit(""))
    mean = pages.agg(F.avg(F.octet_length(html))).first()[0] or 0
    records_per_file = max(1, int(file_bytes / (mean + 1000)))
    rows = pages.select("page_id", "url", "html", F.sha1(html).alias("digest"), (F.octet_length(html) >= MIN_REVISIT_BYTES).alias("long_enough"))
    shared = rows.filter("long_enough").groupBy("digest").agg(F.max("page_id").alias("first_id"), F.min("page_id").alias("least_id"), F.count("*").alias("n"))
    shared = shared.filter("n > 1").select("digest", "first_id")
    joined = rows.join(shared, "digest", "left").select("page_id", "url", "html", F.unhex("digest").alias("digest"), "first_id", (F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))).alias("is_revisit"))

    def members(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts, 512):
            out = [gzip.compress(record(*row, date), 6, mtime=0) for row in zip(*(c.to_pylist() for c in part.columns), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])

    written = joined.mapInArrow(members, "member binary").select(F.col("member").cast("string").alias("value"))
    written.write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("maxRecordsPerFile", records_per_file).text(path)


def parse_record(data: bytes, at: int) -> tuple[dict | None, int, str]:
    """The record that starts at `at` of uncompressed data: (fields, end, "") or (None, at, why)."""
    version = VERSION.match(data, at)
    if not version:
        return None, at, "no version line"
    blank = re.compile(rb"\r?\n\r?\n").search(data, version.end() - 1)
    if not blank:
        return None, at, "headers do not end"
    head = {}
    for line in data[version.end() : blank.start()].splitlines():
        name, colon, value = line.partition(b":")
        if not colon:
            return None, at, "broken header line"
        head[name.strip().lower()] = value.strip().decode("utf-8", "replace")
    length = head.get(b"content-length", "")
    if not re.fullmatch(r"\d{1,18}", length):
        return None, at, "no length"
    end = blank.end() + int(length)
    if end > len(data):
        return None, at, "block is cut off"
    block = data[blank.end() : end]
    if (digest := head.get(b"warc-block-digest")) and digest.startswith("sha1:") and digest != _sha1(block):
        return None, at, "block digest differs"
    if not (trailer := re.compile(rb"(\r?\n){2}").match(data, end)):
        return None, at, "record does not end"
    body = block.partition(b"\r\n\r\n")[2] if head.get(b"content-type", "").startswith("application/http") else block
    return {"head": head, "payload": body}, trailer.end(), ""


def _fields(path: str, at: int, length: int, parsed: dict) -> dict:
    head = parsed["head"]
    number = lambda name: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", head.get(name, ""))) else None
    digest, kind = head.get(b"warc-payload-digest", ""), head.get(b"warc-type")
    revisit = kind == "revisit"
    if digest.startswith("sha1:") and len(digest) == 37:
        digest = base64.b32decode(digest[5:]).hex()
    else:
        digest = None if revisit else hashlib.sha1(parsed["payload"]).hexdigest()
    url = head.get(b"warc-target-uri")
    return {
        "path": path, "kind": "record", "at": at, "length": length, "warc_type": kind, "page_id": number(b"warc-record-id"),
        "url": None if url is None else unquote(url), "refers_to": number(b"warc-refers-to"), "payload_digest": digest,
        "payload_bytes": None if revisit else len(parsed["payload"]), "payload": None if revisit else parsed["payload"], "reason": None,
    }


def unzip_member(data: bytes, at: int, step: int = 1 << 15) -> tuple[bytes, int, str]:
    """What the gzip member at `at` holds, where it ends, and what is wrong with it. Of a broken or cut member, what
    could be unpacked before that."""
    unzip, plain = zlib.decompressobj(31), []
    while at < len(data):
        before = unzip.copy()
        try:
            plain.append(unzip.decompress(data[at : at + step]))
        except zlib.error as error:
            if step == 1:
                return b"".join(plain), at, f"member is broken: {error}"
            unzip, step = before, max(1, step // 32)  # nearer to the damage in smaller steps
            continue
        at += step
        if unzip.eof:
            return b"".join(plain), min(at, len(data)) - len(unzip.unused_data), ""
    return b"".join(plain), len(data), "member is cut off"


def _in_member(plain: bytes) -> Iterator[tuple[int, int, dict | str]]:
    """(start, length, record or reason) of unpacked bytes: the records, and the ranges that belong to none."""
    at, gap_at, why = 0, 0, ""
    while at < len(plain):
        parsed, end, reason = parse_record(plain, at) if VERSION.match(plain, at) else (None, at, "no record starts here")
        if parsed is not None:
            if at > gap_at:
                yield gap_at, at - gap_at, why
            yield at, end - at, parsed
            at = gap_at = end
            continue
        why = reason if at == gap_at else why
        version = VERSION.search(plain, at + 1)
        at = version.start() if version else len(plain)
    if at > gap_at:
        yield gap_at, at - gap_at, why


def salvage(path: str, data: bytes) -> Iterator[dict]:
    """The records of one file in order, and a row of kind `gap` for each range of bytes that belongs
    to none, with the reason why it was given up. Bytes of records and gaps together cover the file,
    but for empty members between records.

    Inside a gzip member, `inner_at` and `inner_length` say where a record lies in the unpacked bytes; its
    records share the member's `at` and `length`. A range of unpacked bytes without a record is a gap of its own, of
    length 0 in the file. Records unpacked before a member breaks off are kept, also with length 0: the member's
    bytes are a gap."""
    at, gap_at, why = 0, None, ""
    while at < len(data):
        found, inside, end, reason = [], [], at, "no record starts here"
        if data.startswith(GZIP_MAGIC, at):
            plain, then, broken = unzip_member(data, at)
            inside = list(_in_member(plain))
            if broken:  # behind the first failure nothing that was unpacked can be trusted
                inside = list(takewhile(lambda row: isinstance(row[2], dict), inside)) or inside[:1]
            if not any(isinstance(what, dict) for *_, what in inside):
                reason, inside = broken or (inside[0][2] if inside else ""), []
                end = then if not plain and not broken else at
            elif broken:
                reason = broken
            else:
                end = then
        elif VERSION.match(data, at):
            parsed, end, reason = parse_record(data, at)
            found = [parsed] if parsed else []
        if gap_at is not None and (end > at or inside):
            yield {"path": path, "kind": "gap", "at": gap_at, "length": at - gap_at, "reason": why}
            gap_at = None
        for parsed in found:
            yield _fields(path, at, end - at, parsed)
        for inner, length, what in inside:
            if isinstance(what, dict):
                yield _fields(path, at, end - at, what) | {"inner_at": inner, "inner_length": length}
            else:
                yield {"path": path, "kind": "gap", "at": at, "length": 0, "reason": what, "inner_at": inner, "inner_length": length}
        if end > at:
            at = end
            continue
        if gap_at is None:
            gap_at, why = at, reason
        member, version = data.find(GZIP_MAGIC, at + 1), VERSION.search(data, at + 1)
        at = min(member if member >= 0 else len(data), version.start() if version else len(data))
    if gap_at is not None:
        yield {"path": path, "kind": "gap", "at": gap_at, "length": len(data) - gap_at, "reason": why}


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All records and gaps of the WARC files below path (READ_SCHEMA), damaged or not.

    Revisit records have no payload; payload_bytes is null for them. A file is read by one task, so
    files should be of some megabytes, as the writer's are. Empty files give no rows."""
    schema = pa.schema([(f.name, {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[f.dataType.simpleString()]) for f in spark.createDataFrame([], READ_SCHEMA).schema])

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts, 1):
            held, size = [], 0
            for row in salvage(part.column(0)[0].as_py(), part.column(1)[0].as_py() or b""):
                held.append(row)
                size += row.get("payload_bytes") or 0
                if size > 8 << 20:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_pylist(held, schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(read, READ_SCHEMA)


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write pages as archives in the shared folder and read them back, one row per record
    (page_id, payload_bytes, payload_digest, record_type, refers_to, url, path, at). Revisits get
    the length of the response that they refer to, from the archive too."""
    spark = pages.sparkSession
    path = staging_path(spark, "llm-warc")
    write_archives(pages, path)
    back = read_archives(spark, path).filter("kind = 'record'")
    back = stage(back.select("page_id", "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"), "refers_to", "url", "path", "at"), "warc-records")
    answers = back.filter("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("their_bytes"))
    revisits = back.filter("record_type = 'revisit'").join(answers, ["refers_to", "payload_digest"], "left")
    revisits = revisits.withColumn("payload_bytes", F.col("their_bytes")).select(*back.columns)
    return back.filter("record_type <> 'revisit'").unionByName(revisits)
