"""WARC archives: a writer through Spark's text sink and a salvage reader.

The writer makes one record per page. Of pages with equal payloads the one with the smallest page_id is
a response with the payload, the others are revisits that refer to it. Files are WARC/1.1 with a gzip
member per record, so that damage to one does not reach the next, and end after the record with which they
reach ``file_bytes``, which bounds what a reader task has to hold. A bitmap of fixed size tells the pages
whose payload may have copies; only these are joined with the first page of their payload, all others are
written where they are read.

The reader takes any WARC file, plain or of gzip members with one or more records. A record is accepted if its headers,
length, end mark and payload digest are right. After a failed check it searches for the next version
line or gzip member that starts a valid record, goes on there, and logs the bytes in between as a gap.
A file is read whole by one task, member by member, so it has to fit in the memory of a task: files of this
writer do by ``file_bytes``, files of others do if they are of the usual size of up to 1 GB.

A NULL html is an empty payload (and shares it with the empty text); a NULL url is written as an empty
target; a NULL page_id is written as ``null``, read back as NULL, and named as the response only if no
page of its payload has an id. Repeated rows each get a record; rows that repeat the smallest id of
their payload are all responses. An empty table gives an archive without records. Further columns are
not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm.common import by_value
from pagewright.sources.storage import stored

END = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
MAGIC = b"\x1f\x8b"
START = re.compile(rb"WARC/1\.[01]\r\n|\x1f\x8b\x08")
FIELD = re.compile(rb"[!-9;-~]+:|[ \t]")
EMIT_BYTES = 4 << 20
FILE_BYTES = 16 << 20
COPY_BITS = 1 << 24  # of the bitmap of payloads with copies: 2 MB
BITS_PER_ROW = 1 << 15
PIECE = 1 << 16
EMPTY = gzip.compress(b"", mtime=0)
RECORD = (
    "file string, start long, length long, inner long, kind string, reason string, type string, record_id string, "
    "refers_to string, uri string, digest string, payload_bytes long, payload binary"
)


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base 32: every 5 hex digits are 4 letters."""
    digits = F.sha1(payload)
    values = [F.conv(F.substring(digits, 5 * i + 1, 5), 16, 10).cast("int") for i in range(8)]
    at = lambda v, shift: F.shiftright(v, shift).bitwiseAND(F.lit(31)) + 1
    letters = [F.substr(F.lit(BASE32), at(v, s), F.lit(1)) for v in values for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """The records of ``pages`` as text, without their end marks."""
    whole = pages.select(
        F.col(key).alias("id"),
        F.regexp_replace(F.coalesce(F.col(url), F.lit("")), r"[\r\n]+", "%0A").alias("uri"),
        F.coalesce(F.col(html), F.lit("")).alias("payload"),
    )
    whole = whole.withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    firsts = whole.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    firsts = stored(firsts.select("digest", "first"), "copied-payloads")
    # a bitmap row holds BITS_PER_ROW bits; there are as many rows as the constants say, whatever the table
    bit = F.pmod(F.xxhash64("digest"), F.lit(COPY_BITS))
    at = bit % BITS_PER_ROW
    bitmap = firsts.groupBy((bit - at).alias("part")).agg(F.bitmap_construct_agg(at).alias("bits"))
    placed = whole.withColumns({"part": bit - at, "at": at}).join(F.broadcast(bitmap), "part", "left")
    byte = F.conv(F.hex(F.substring(F.col("bits"), F.shiftright("at", 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    set_ = F.call_function("shiftright", byte, (F.col("at") % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    placed = placed.withColumn("may", F.coalesce(set_, F.lit(False))).drop("part", "at", "bits")
    # the join meets copies of one payload on one key, which Spark splits
    joined = placed.filter("may").drop("may").join(firsts, "digest", "left")
    alone = placed.filter("NOT may").drop("may").withColumn("first", F.lit(None).cast(joined.schema["first"].dataType))
    joined = alone.unionByName(joined)
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("payload").cast("string"), F.lit(END),
    )
    joined = joined.withColumn("revisit", revisit)
    block = F.when(F.col("revisit"), http).otherwise(F.concat(http, F.col("payload")))
    joined = joined.withColumn("block", block)
    return joined.select(F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), name("id"),
        F.lit("\r\nWARC-Date: 2020-01-01T00:00:00Z\r\nWARC-Target-URI: "), F.col("uri"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), base32_sha1(F.col("payload").cast("binary")),
        F.when(F.col("revisit"), F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
            name("first"),
        )).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length("block").cast("string"), F.lit(END), F.col("block"),
    ).alias("value"))


def packed(record: bytes) -> bytes:
    """The gzip member of a record, without the zero byte that ends it. That byte is the highest of the
    record's length, so a record of 16 MB or more takes an empty member along, which ends in zeros."""
    member = gzip.compress(record, 6, mtime=0)
    return (member if member.endswith(b"\0") else member + EMPTY)[:-1]


def write_archives(pages: DataFrame, path: str, file_bytes: int = FILE_BYTES, **columns) -> None:
    """Archives of ``pages``; a file ends with the record that takes it to ``file_bytes`` or beyond."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, held = [], 0
        for batch in batches:
            for value in batch.column(0):
                members.append(packed(value.as_py() + END.encode()))
                held += len(members[-1]) + 1
                if held >= file_bytes:
                    yield pa.record_batch([pa.array([b"\0".join(members)], pa.binary())], names=["value"])
                    members, held = [], 0
        if members:
            yield pa.record_batch([pa.array([b"\0".join(members)], pa.binary())], names=["value"])

    files = records(pages, **columns).select(F.col("value").cast("binary")).mapInArrow(run, "value binary")
    # a row is a file; the text sink writes the bytes of a string as they are, the last byte comes from lineSep
    rows = files.select(F.col("value").cast("string")).write.option("lineSep", "\0").option("maxRecordsPerFile", 1)
    rows.option("compression", "none").text(path)


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(b":") for line in head.split(b"\r\n")[1:])
    return {a.strip().lower().decode("latin-1"): b.strip().decode("utf-8", "replace") for a, _, b in pairs}


def parse_record(data: bytes, start: int) -> tuple[dict | None, int, str]:
    """(record, its end, "") or (None, start, reason) for the plain record that should begin at ``start``."""
    if not VERSION.match(data, start):
        return None, start, "no version line"
    top = data.find(b"\r\n\r\n", start)
    if top < 0:
        return None, start, "headers do not end"
    head = data[start:top].split(b"\r\n")[1:]
    if not all(map(FIELD.match, head)):
        return None, start, "headers are broken"
    fields = _fields(data[start:top])
    if not fields.get("content-length", "").isdecimal() or "warc-type" not in fields:
        return None, start, "headers are not complete"
    body = top + 4
    end = body + int(fields["content-length"])
    if data[end : end + 4] != b"\r\n\r\n":
        return None, start, "length is wrong"
    block = data[body:end]
    inner, payload = {}, block
    if fields.get("content-type", "").startswith("application/http"):
        head, mark, payload = block.partition(b"\r\n\r\n")
        if not mark:
            return None, start, "no payload"
        inner = _fields(head)
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    length = len(payload)
    if fields["warc-type"] == "revisit":
        length = int(inner["content-length"]) if inner.get("content-length", "").isdecimal() else None
    elif digest and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        return None, start, "digest is wrong"
    return {
        "type": fields["warc-type"], "record_id": fields.get("warc-record-id"), "refers_to": fields.get("warc-refers-to"),
        "uri": fields.get("warc-target-uri"), "digest": digest or None, "payload_bytes": length, "payload": payload,
    }, end + 4, ""


def unzip(data: bytes, start: int) -> tuple[bytes, int | None]:
    """What can be read of the gzip member at ``start``, and its end if it is whole."""
    member, parts, fed, step = zlib.decompressobj(31), [], start, PIECE
    while not member.eof and fed < len(data):
        before = member.copy()
        try:
            parts.append(member.decompress(data[fed : fed + step]))
            fed += step
        except zlib.error:
            if step == 1:
                return b"".join(parts), None
            # what a failing call has unpacked is lost, so go on from before it in smaller steps
            member, step = before, max(1, step >> 8)
    return b"".join(parts), min(fed, len(data)) - len(member.unused_data) if member.eof else None


def salvage_plain(data: bytes) -> Iterator[dict]:
    """Records and gaps of bytes without gzip members."""
    at = 0
    while at < len(data):
        record, end, reason = parse_record(data, at)
        if record is None:
            marks = (m.start() for m in VERSION.finditer(data, at + 1))
            end = next((m for m in marks if parse_record(data, m)[0] is not None), len(data))
        kind = {"kind": "gap", "reason": reason} if record is None else {"kind": "record", "reason": None}
        yield {"start": at, "length": end - at, **kind, **(record or {})}
        at = end


def _begins_well(data: bytes, start: int) -> bool:
    """Whether a record can be read at ``start``, plain or in the readable part of a gzip member."""
    if data[start : start + 2] != MAGIC:
        return parse_record(data, start)[0] is not None
    return any(r["kind"] == "record" for r in salvage_plain(unzip(data, start)[0]))


def salvage(data: bytes) -> Iterator[dict]:
    """Records and gaps of an archive in file order; together they cover every byte. What comes out of a
    gzip member has the place of the member and its own place ``inner`` in the unpacked bytes. Of a
    damaged member the readable records are kept and the whole member is logged as a gap; an empty member
    has no row."""
    at = 0
    while at < len(data):
        inside: list[dict] = []
        if data[at : at + 2] == MAGIC:
            plain, end = unzip(data, at)
            inside = [{**r, "inner": r["start"]} for r in salvage_plain(plain)]
            good = any(r["kind"] == "record" for r in inside)
            reason = "gzip member is broken" if end is None else "no record in the gzip member"
            if end is not None and (good or not plain):
                yield from ({**r, "start": at, "length": end - at} for r in inside)
                at = end
                continue
        else:
            record, end, reason = parse_record(data, at)
            if record is not None:
                yield {"start": at, "length": end - at, "kind": "record", "reason": None, **record}
                at = end
                continue
        marks = (m.start() for m in START.finditer(data, at + 1))
        end = next((m for m in marks if _begins_well(data, m)), len(data))
        place = {"start": at, "length": end - at}
        yield {**place, "kind": "gap", "reason": reason}
        yield from ({**r, **place} for r in inside if r["kind"] == "record")
        at = end


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records and gaps (``kind``) of the files under ``path``; see RECORD for the columns."""
    names = [f.split()[0] for f in RECORD.split(", ")]
    kinds = {"start": pa.int64(), "length": pa.int64(), "inner": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
    schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                rows, held = [], 0
                for row in salvage(content.as_py()):
                    if not payloads:
                        row["payload"] = None
                    held += 500 + len(row.get("payload") or b"")
                    rows.append({"file": name.as_py(), **row})
                    if held > EMIT_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(run, RECORD)


def page_of(name: Column) -> Column:
    """page_id of a record id."""
    return F.regexp_extract(name, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


by_value(__name__)
