import base64
import gzip
import hashlib
import random
from pathlib import Path

from pyspark.sql import functions as F

from pagewright.llm import warc
from pagewright.sources.storage import scratch_path

SCHEMA = "page_id long, url string, html string, digest string, first string, value string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "d", "f", "v") for r in rows], SCHEMA)


ROWS = [
    (3, "http://a/1", "same"), (1, "http://a/2", "same"), (2, None, "same"), (9, "http://a/\r\nX: y", "WARC/1.0\r\nno record\r\n\r\n"),
    (5, "http://a/e", ""), (4, "http://a/n", None), (7, "u", "ü" * 70000), (7, "u", "ü" * 70000), (None, "v", "same"), (8, "w", "\r\n\r\nx\r\n\r\n"),
]


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_round_trip(spark):
    path = scratch_path(spark, "warc")
    warc.write_archives(pages(spark, ROWS), path, file_bytes=300)
    got = warc.read_archives(spark, path).withColumn("page_id", warc.page_of(F.col("record_id"))).withColumn("first", warc.page_of(F.col("refers_to")))
    rows = got.collect()
    assert {r.kind for r in rows} == {"record"} and len(rows) == len(ROWS)
    want = []
    for i, _, html in ROWS:
        data = (html or "").encode()
        first = min(j for j, _, h in ROWS if j is not None and (h or "") == (html or ""))
        kind = "response" if i == first else "revisit"
        want.append(str((i, len(data), digest(data), kind, None if i == first else first, data if i == first else b"")))
    assert sorted(str((r.page_id, r.payload_bytes, r.digest, r.type, r.first, bytes(r.payload))) for r in rows) == sorted(want)
    empty = scratch_path(spark, "warc")
    warc.write_archives(pages(spark, []), empty)
    assert warc.read_archives(spark, empty).count() == 0


def test_files_end_by_bytes(spark):
    """A file has the record that takes it over the bound, and no more."""
    rng = random.Random(3)
    rows = [(i, f"http://a/{i}", rng.randbytes(rng.choice([100, 30_000])).hex()) for i in range(60)]
    path, bound = scratch_path(spark, "warc"), 50_000
    warc.write_archives(pages(spark, rows).coalesce(2), path, file_bytes=bound)
    got = warc.read_archives(spark, path)
    sizes = got.groupBy("file").agg(F.max(F.col("start") + F.col("length")).alias("size"), F.max("length").alias("last"), F.count("*").alias("n")).collect()
    assert sum(r.n for r in sizes) == 60 and len(sizes) > 10
    assert all(r.size - r.last < bound for r in sizes) and sum(r.size < bound for r in sizes) <= 2


def test_pages_with_copies_alone_are_joined(spark):
    """Every payload with copies has its bit; hardly any other page has."""
    rows = [(i, "u", f"text {i if i % 10 else i % 50}") for i in range(2000)]
    lines = warc.records(pages(spark, rows)).select(F.col("value").alias("v")).collect()
    assert sum("WARC-Type: revisit" in r.v for r in lines) == 200 - 5
    assert len({r.v for r in lines}) == 2000


def record(k, payload):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{k}>\r\nWARC-Payload-Digest: sha1:{digest(payload)}\r\nContent-Type: application/http\r\nContent-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def covered(found, data):
    spans = sorted({(r["start"], r["length"]) for r in found})
    at = 0
    for start, length in spans:
        assert start == at
        at += length
    assert at == len(data)


def test_salvage_after_damage():
    parts = [record(k, f"page {k} WARC/1.0\r\n".encode() * (k + 1)) for k in range(6)]
    broken = bytearray(parts[2])
    broken[-12] ^= 1  # payload no longer fits its digest
    data = b"junk" + parts[0] + parts[1] + bytes(broken) + parts[3] + parts[4][:-9] + parts[5] + b"tail"
    found = list(warc.salvage(data))
    covered(found, data)
    assert [r["record_id"] for r in found if r["kind"] == "record"] == [f"<urn:page:{k}>" for k in (0, 1, 3, 5)]
    gaps = [(r["start"], r["length"], r["reason"]) for r in found if r["kind"] == "gap"]
    assert [g[1] for g in gaps] == [4, len(broken), len(parts[4]) - 9, 4]
    assert gaps[1][2] == "digest is wrong" and gaps[2][2] == "length is wrong"


def test_salvage_of_gzip_members():
    rng = random.Random(4)
    members = [gzip.compress(record(k, rng.randbytes(100000)), mtime=0) for k in range(5)]
    bad = bytearray(members[1])
    bad[len(bad) // 2] ^= 255
    data = members[0] + bytes(bad) + members[2] + members[3][: len(members[3]) // 2] + members[4]
    found = list(warc.salvage(data))
    covered(found, data)
    assert [r["record_id"] for r in found if r["kind"] == "record"] == ["<urn:page:0>", "<urn:page:2>", "<urn:page:4>"]
    assert [r["reason"] for r in found if r["kind"] == "gap"] == ["gzip member is broken"] * 2


def test_salvage_inside_a_member():
    """One member for all records: a bad record in it, and a member cut short after some records."""
    rng = random.Random(5)
    parts = [record(k, rng.randbytes(2000)) for k in range(6)]
    bad = bytearray(parts[2])
    bad[-20] ^= 1
    whole = gzip.compress(b"".join([*parts[:2], bytes(bad), *parts[3:]]), mtime=0)
    found = list(warc.salvage(whole))
    assert [r["kind"] for r in found] == ["record", "record", "gap", "record", "record", "record"]
    assert [r["inner"] for r in found][:3] == [0, len(parts[0]), len(parts[0]) + len(parts[1])]
    short = gzip.compress(b"".join(parts), mtime=0)
    data = short[: len(short) * 2 // 3] + whole
    found = list(warc.salvage(data))
    covered(found, data)
    names = [r["record_id"] for r in found if r["kind"] == "record"]
    assert names[-5:] == [f"<urn:page:{k}>" for k in (0, 1, 3, 4, 5)] and names[:-5] == [f"<urn:page:{k}>" for k in range(len(names) - 5)]
    assert 3 <= len(names) - 5 <= 4


def test_salvage_of_random_damage():
    rng = random.Random(3)
    for _ in range(60):
        parts = [record(k, rng.randbytes(rng.randint(0, 300))) for k in range(8)]
        data = bytearray(b"".join(parts))
        at = rng.randrange(len(data))
        data[at : at + rng.randint(1, 40)] = rng.randbytes(rng.randint(0, 40))
        found = list(warc.salvage(bytes(data)))
        covered(found, data)
        assert sum(r["kind"] == "record" for r in found) >= 6
    assert list(warc.salvage(b"")) == [] and [r["kind"] for r in warc.salvage(b"WARC/1.1\r\n")] == ["gap"]


def test_damage_to_written_archives(spark):
    """Files of write_archives with bytes overwritten or missing lose the records that were hit, and no other."""
    rng = random.Random(8)
    rows = [(k, f"http://a/{k}", " ".join(rng.choice(["one", "two", "ünï", "<p>", str(k)]) for _ in range(rng.randint(0, 2000)))) for k in range(300)]
    path = scratch_path(spark, "warc")
    warc.write_archives(pages(spark, rows).coalesce(1), path)
    files = [f for f in Path(path.removeprefix("file:")).iterdir() if f.name.startswith("part-")]
    total = 0
    for file in files:
        data = file.read_bytes()
        whole = list(warc.salvage(data))
        covered(whole, data)
        total += len(whole)
        assert {r["kind"] for r in whole} <= {"record"}
        assert gzip.decompress(data).count(b"WARC-Record-ID: ") == len(whole)
        for part in (0.02, 0.1, 0.5, 0.9):
            at = int(len(data) * part)
            for bad in (data[:at] + rng.randbytes(16) + data[at + 16 :], data[:at] + data[at + 512 :]):
                found = list(warc.salvage(bad))
                covered(found, bad)
                hit = sum(r["start"] < at + 512 and r["start"] + r["length"] > at for r in whole)
                assert sum(r["kind"] == "record" for r in found) >= len(whole) - hit
    assert total == len(rows)


def test_a_record_over_the_length_byte():
    big = record(1, bytes(1 << 24))
    data = warc.packed(big) + b"\0" + warc.packed(record(2, b"x")) + b"\0"
    assert gzip.decompress(data) == big + record(2, b"x")
    assert [r["record_id"] for r in warc.salvage(data)] == ["<urn:page:1>", "<urn:page:2>"]
