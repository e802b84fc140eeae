"""WARC records in ZIP packages: a writer, and a reader that locates stored members and range-reads records without extraction.

A package holds two stored members: archive/data.warc.gz, a gzip member for each record, and indexes/index.cdxj, a line for each
record with its place in the archive. The reader parses the end record, the ZIP64 records where there are any, and the central
directory; it then reads the index, and of the archive only the ranges that are asked for.

Null payloads are empty payloads. A null page_id stays null, and a record without one refers to none and is referred to by none.
Rows that repeat a page_id each give a record; of equal payloads, all that bear the largest page_id are responses. An empty table
gives an empty result. Only page_id, url and html are read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import Sieve, scratch, written

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
DATE = "2020-01-01T00:00:00Z"

# ---- ZIP


def zip_bytes(members: list[tuple[str, bytes]], force64: bool = False) -> bytes:
    """A ZIP package of stored members. ZIP64 fields are written where sizes, offsets or force64 ask for them."""
    out, directory = bytearray(), bytearray()
    for name, data in members:
        at, n, path = len(out), len(data), name.encode()
        wide = force64 or n > 0xFFFFFFFE
        extra = struct.pack("<HHQQ", 1, 16, n, n) if wide else b""
        small = 0xFFFFFFFF if wide else n
        common = (0x0800, 0, 0, 0x21, zlib.crc32(data), small, small, len(path))
        out += struct.pack("<IHHHHHIIIHH", 0x04034B50, 45 if wide else 20, *common, len(extra)) + path + extra + data
        far = force64 or at > 0xFFFFFFFE
        values = (struct.pack("<QQ", n, n) if wide else b"") + (struct.pack("<Q", at) if far else b"")
        extra = struct.pack("<HH", 1, len(values)) + values if values else b""
        directory += struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45 if extra else 20, *common, len(extra), 0, 0, 0, 0, 0xFFFFFFFF if far else at) + path + extra
    at, n = len(out), len(members)
    out += directory
    if force64 or at > 0xFFFFFFFE or n > 0xFFFE or len(directory) > 0xFFFFFFFE:
        end = len(out)
        out += struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, n, n, len(directory), at) + struct.pack("<IIQI", 0x07064B50, 0, end, 1)
        out += struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    else:
        out += struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, n, n, len(directory), at, 0)
    return bytes(out)


Read = Callable[[int, int], bytes]


def zip_members(read: Read, size: int) -> dict[str, tuple[int, int]]:
    """(offset, length) of the data of each stored member. read(offset, length) gives a range of the package."""
    tail_at = max(0, size - 65_557)
    tail = read(tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    while end >= 0 and (end + 22 > len(tail) or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(b"PK\x05\x06", 0, end)
    if end < 0:
        raise ValueError("no end record: not a ZIP package")
    n, length, at = struct.unpack_from("<HII", tail, end + 10)
    if (n == 0xFFFF or 0xFFFFFFFF in (length, at)) and end + tail_at >= 20:
        magic, _, where, _ = struct.unpack("<IIQI", read(tail_at + end - 20, 20))
        if magic == 0x07064B50:
            record = read(where, 56)
            if record[:4] != b"PK\x06\x06":
                raise ValueError("the ZIP64 locator points to no ZIP64 end record")
            n, length, at = struct.unpack_from("<QQQ", record, 32)
    directory, members, i = read(at, length), {}, 0
    for _ in range(n):
        magic, _, _, flags, method, _, _, _, packed, plain, names, extras, notes, _, _, _, offset = struct.unpack_from("<IHHHHHHIIIHHHHHII", directory, i)
        if magic != 0x02014B50:
            raise ValueError("the central directory is damaged")
        name = directory[i + 46 : i + 46 + names].decode("utf-8" if flags & 0x0800 else "cp437")
        extra, j = directory[i + 46 + names : i + 46 + names + extras], 0
        while j + 4 <= len(extra):
            kind, wide = struct.unpack_from("<HH", extra, j)
            if kind == 1:
                k = j + 4
                if plain == 0xFFFFFFFF:
                    plain, k = struct.unpack_from("<Q", extra, k)[0], k + 8
                if packed == 0xFFFFFFFF:
                    packed, k = struct.unpack_from("<Q", extra, k)[0], k + 8
                if offset == 0xFFFFFFFF:
                    offset = struct.unpack_from("<Q", extra, k)[0]
            j += 4 + wide
        i += 46 + names + extras + notes
        if method == 0 and not flags & 1:
            head = read(offset, 30)
            if head[:4] != b"PK\x03\x04":
                raise ValueError(f"{name} has no local header")
            members[name] = (offset + 30 + sum(struct.unpack_from("<HH", head, 26)), packed)
    return members


# ---- WARC


def digest32(sha1: bytes) -> str:
    return "sha1:" + base64.b32encode(sha1).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record. A revisit has the headers of its response, with the payload's length and digest, and no payload."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    head += [f"WARC-Target-URI: {quote(url or 'about:blank', safe=':/?#[]@!$&()*+,;=%~')}", f"WARC-Payload-Digest: {digest32(hashlib.sha1(payload).digest())}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-ID: {refers_to}"]
    else:
        block += payload
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def fields(lines: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines.decode("utf-8", "replace").split("\r\n")[1:])}


def parsed(raw: bytes) -> dict:
    """What a record holds: its headers, type, page, payload (None for a revisit), and the full payload's length and digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    warc = fields(head)
    block = rest[: int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, page, to = warc["warc-type"], warc.get("x-page-id"), warc.get("x-refers-to-page-id")
    sha1 = base64.b32decode(warc["warc-payload-digest"].removeprefix("sha1:"))
    length = int(fields(http)["content-length"])
    if kind != "revisit" and (length != len(payload) or hashlib.sha1(payload).digest() != sha1):
        raise ValueError(f"the payload of {warc['warc-record-id']} doesn't have its length or digest")
    return {"headers": warc, "type": kind, "page_id": None if page is None else int(page), "payload": None if kind == "revisit" else payload, "payload_bytes": length, "payload_digest": sha1.hex(), "refers_to": None if to is None else int(to)}


# ---- Spark


def with_revisits(pages: DataFrame, least: int = 1000) -> DataFrame:
    """(page_id, url, payload, refers_to): refers_to is the largest page_id with an equal payload of `least` bytes or more.

    Only digests are grouped, with partial maxima. Payloads that others repeat, by a sieve of their digests, are joined with those
    maxima; small ones and single ones are not shuffled. A digest that many pages have is split by adaptive execution, as it is on a
    side that the other has once.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.when(F.length("payload") >= least, F.unhex(F.sha1("payload"))))
    last = rows.filter("digest is not null").groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).filter("n > 1 and last is not null").select("digest", "last")
    last = written(last, "repeated")
    rows = rows.withColumn("shared", Sieve(last.select(F.xxhash64("digest").alias("h"))).column(F.xxhash64("digest")) & F.col("digest").isNotNull())
    own = rows.filter("shared").join(last, "digest", "left").select("page_id", "url", "payload", "last")
    alone = rows.filter("not shared").select("page_id", "url", "payload", F.lit(None).cast("long").alias("last"))
    return own.union(alone).select("page_id", "url", "payload", F.when(F.col("last") > F.col("page_id"), F.col("last")).alias("refers_to"))


def packages(records: DataFrame, most: int = 16_000_000) -> DataFrame:
    """Writes the records (page_id, url, payload, refers_to) to packages of about `most` bytes in the shared folder.

    (path, size) of each package. A task that runs again writes new files; only those of the run that succeeds are listed.
    """
    root = scratch(records.sparkSession, "packages")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)
        store.create_dir(base, recursive=True)

        def put(data: bytearray, index: list[bytes]) -> pa.RecordBatch:
            name, body = f"{base}/{uuid.uuid4().hex}.wacz", zip_bytes([(ARCHIVE, bytes(data)), (INDEX, b"".join(index))])
            with store.open_output_stream(name) as f:
                f.write(body)
            return pa.RecordBatch.from_arrays([pa.array([f"{root}/{name.rpartition('/')[2]}"]), pa.array([len(body)])], ["path", "size"])

        data, index = bytearray(), []
        for b in batches:
            for page_id, url, payload, to in zip(*(c.to_pylist() for c in b.columns), strict=True):
                raw = gzip.compress(record(page_id, url, payload, to), 1, mtime=0)
                index.append(json.dumps({"page": page_id, "offset": len(data), "length": len(raw)}).encode() + b"\n")
                data += raw
                if len(data) >= most:
                    yield put(data, index)
                    data, index = bytearray(), []
        if index:
            yield put(data, index)

    return records.select("page_id", "url", "payload", "refers_to").mapInArrow(run, "path string, size long")


def ranges(listed: DataFrame, most: int = 4_000_000) -> DataFrame:
    """(path, offset, lengths): runs of neighbouring records of about `most` bytes, found by the directory and index of each package."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, size in zip(*(c.to_pylist() for c in b.columns), strict=True):
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_file(name) as f:
                    read = lambda at, n, f=f: f.read_at(n, at)
                    members = zip_members(read, size)
                    start, index = members[ARCHIVE][0], read(*members[INDEX])
                at, lengths, out = None, [], []
                for entry in map(json.loads, index.splitlines()):
                    if at is not None and (start + entry["offset"] != at + sum(lengths) or sum(lengths) >= most):
                        out.append((at, lengths))
                        at = None
                    if at is None:
                        at, lengths = start + entry["offset"], []
                    lengths.append(entry["length"])
                if at is not None:
                    out.append((at, lengths))
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(out)), pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.list_(pa.int64()))], ["path", "offset", "lengths"])

    return listed.select("path", "size").mapInArrow(run, "path string, offset long, lengths array<long>")


def records(parts: DataFrame, with_payload: bool = False) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url[, payload]) of the records in ranges()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, offset, lengths in zip(*(c.to_pylist() for c in b.columns), strict=True):
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_file(name) as f:
                    data, at, rows = memoryview(f.read_at(sum(lengths), offset)), 0, []
                for n in lengths:
                    rows.append(parsed(gzip.decompress(data[at : at + n])))
                    at += n
                get = lambda k, t: pa.array([r[k] for r in rows], t)  # noqa: B023, E731
                out = [get("page_id", pa.int64()), get("payload_bytes", pa.int64()), get("payload_digest", pa.string()), get("type", pa.string()), get("refers_to", pa.int64()), pa.array([r["headers"]["warc-target-uri"] for r in rows])]
                if with_payload:
                    out.append(get("payload", pa.binary()))
                yield pa.RecordBatch.from_arrays(out, names)

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", *["payload"] * with_payload]
    kind = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string" + ", payload binary" * with_payload
    return parts.select("path", "offset", "lengths").mapInArrow(run, kind)


def read_packages(listed: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of the packages (path, size): ranges first, dealt out evenly, then the records."""
    parts = ranges(listed)
    return records(parts.repartition(max(8, listed.sparkSession.sparkContext.defaultParallelism * 4)), with_payload)


def op1_warc(spark, sf_dir: str) -> DataFrame:
    """Whole pages table, written as packages and read back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    listed = written(packages(with_revisits(spark.read.parquet(f"{sf_dir}/pages.parquet"))), "listed")
    return read_packages(listed).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t, strlen(coalesce(html, '')) AS n, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS m FROM pages)
SELECT page_id, n::BIGINT AS payload_bytes, sha1(t) AS payload_digest, CASE WHEN n >= 1000 AND m > page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN n >= 1000 AND m > page_id THEN m END AS refers_to FROM p
"""
