"""Web archives packaged as ZIP files, written and read by byte ranges.

An archive is a ZIP with stored members: `archive/data.warc.gz`, whose WARC records are gzip members of their own, and
`indexes/index.cdxj`, with a line for each record: key, offset and length. The reader takes the end of the file, finds the
end record (and its ZIP64 form), parses the central directory, locates both members by
their local headers, reads the index, and then range-reads records; nothing is extracted. Ranges
of many archives are dealt to tasks evenly, so that one large archive is read by many.

Of records with equal payloads of at least `MIN_PAYLOAD` bytes that with the least page_id is a response and the others
revisit it. Files are named by task attempt and only those that a finished task reports are read, so that lost or repeated
tasks do no harm.

Defined cases: a null html is an empty payload; a null url is empty; a null page_id is a record of its own that nothing
refers to; repeated rows are records of their own; an empty table gives an empty table; other columns are not used.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import groups, shared_dir, stash, table

MIN_PAYLOAD = 100
ARCHIVE_BYTES = 32_000_000
RANGE_BYTES = 2_000_000
#: Ranges that a task reads, where there are many.
RANGES = 64
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Signatures and sizes of the ZIP format.
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
LOCAL_SIZE, CENTRAL_SIZE, END_SIZE, END64_SIZE, LOCATOR64_SIZE = 30, 46, 22, 56, 20
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
DOS_DATE = (44 << 9) | (1 << 5) | 1
WARC_DATE = "2024-01-01T00:00:00Z"


# --- ZIP ------------------------------------------------------------------------------------------


@dataclass
class Member:
    name: str
    method: int
    crc: int
    size: int  # as stored
    full_size: int
    header: int  # offset of the local header


def zip_bytes(members: list[tuple[str, bytes]], zip64: bool = False) -> bytes:
    """A ZIP with stored members; zip64 uses 64-bit fields even where they aren't needed."""
    out, directory = bytearray(), bytearray()
    for name, body in members:
        encoded, crc, at = name.encode(), zlib.crc32(body), len(out)
        wide = zip64 or len(body) >= FULL32 or at >= FULL32
        extra = struct.pack("<HHQQ", 1, 16, len(body), len(body)) if wide else b""
        size = FULL32 if wide else len(body)
        fields = (45 if wide else 20, 0x800, 0, 0, DOS_DATE, crc, size, size, len(encoded), len(extra))
        out += LOCAL + struct.pack("<HHHHHIIIHH", *fields) + encoded + extra + body
        extra = struct.pack("<HHQQQ", 1, 24, len(body), len(body), at) if wide else b""
        fields = (*fields[:9], len(extra))
        directory += CENTRAL + struct.pack("<H", 45) + struct.pack("<HHHHHIIIHH", *fields) + struct.pack("<HHHII", 0, 0, 0, 0, FULL32 if wide else at) + encoded + extra
    start, n = len(out), len(members)
    out += directory
    if zip64 or start >= FULL32 or n >= FULL16:
        at = len(out)
        out += END64 + struct.pack("<QHHIIQQQQ", END64_SIZE - 12, 45, 45, 0, 0, n, n, len(directory), start)
        out += LOCATOR64 + struct.pack("<IQI", 0, at, 1)
        out += END + struct.pack("<HHHHIIH", 0, 0, FULL16, FULL16, FULL32, FULL32, 0)
    else:
        out += END + struct.pack("<HHHHIIH", 0, 0, n, n, len(directory), start, 0)
    return bytes(out)


def wide_fields(extra: bytes, values: list[int]) -> list[int]:
    """Replace values that are all ones by those of the ZIP64 extra field, in order."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            held, place = extra[at + 4 : at + 4 + size], 0
            for i, v in enumerate(values):
                if v == FULL32:
                    values[i] = struct.unpack_from("<Q", held, place)[0]
                    place += 8
            break
        at += 4 + size
    return values


def read_directory(read, size: int) -> dict[str, Member]:
    """The members of a ZIP; read(offset, length) gives bytes. Reads the end and the central directory only."""
    tail_at = max(0, size - END_SIZE - FULL16 - LOCATOR64_SIZE)
    tail = read(tail_at, size - tail_at)
    place = tail.rfind(END)
    while place >= 0 and (place + END_SIZE > len(tail) or place + END_SIZE + struct.unpack_from("<H", tail, place + 20)[0] != len(tail)):  # else in a comment
        place = tail.rfind(END, 0, place)
    if place < 0:
        raise ValueError("no end of central directory")
    _, _, _, count, length, start, _ = struct.unpack_from("<HHHHIIH", tail, place + 4)
    if FULL32 in (length, start) or count == FULL16:
        if tail[place - LOCATOR64_SIZE : place - LOCATOR64_SIZE + 4] != LOCATOR64:
            raise ValueError("no ZIP64 locator")
        at = struct.unpack_from("<Q", tail, place - LOCATOR64_SIZE + 8)[0]
        record = read(at, END64_SIZE)
        if record[:4] != END64:
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<QQQ", record, 32)
    directory, members, at = read(start, length), {}, 0
    for _ in range(count):
        if directory[at : at + 4] != CENTRAL:
            raise ValueError("damaged central directory")
        method, crc, packed, full, n, extra, comment = (struct.unpack_from(f, directory, at + o)[0] for f, o in (("<H", 10), ("<I", 16), ("<I", 20), ("<I", 24), ("<H", 28), ("<H", 30), ("<H", 32)))
        header = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + CENTRAL_SIZE : at + CENTRAL_SIZE + n].decode()
        full, packed, header = wide_fields(directory[at + CENTRAL_SIZE + n : at + CENTRAL_SIZE + n + extra], [full, packed, header])
        members[name] = Member(name, method, crc, packed, full, header)
        at += CENTRAL_SIZE + n + extra + comment
    return members


def data_offset(read, member: Member) -> int:
    """Where a stored member's bytes begin, by its local header."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed")
    head = read(member.header, LOCAL_SIZE)
    if head[:4] != LOCAL:
        raise ValueError("no local header")
    n, extra = struct.unpack_from("<HH", head, 26)
    return member.header + LOCAL_SIZE + n + extra


# --- WARC -----------------------------------------------------------------------------------------


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One gzip member with a response or, if refers_to is given, a revisit."""
    safe = "".join(c if c > " " else f"%{ord(c):02X}" for c in url)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {WARC_DATE}",
        f"WARC-Target-URI: {safe}",
        f"WARC-Payload-Digest: sha256:{digest}",
        *([f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] if refers_to is not None else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return gzip.compress(("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n", compresslevel=6, mtime=0)


def headers_of(block: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in block.decode().split("\r\n")[1:])}


def parsed(member: bytes) -> tuple[int | None, int, str, str, int | None]:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of a record; a response's digest is checked."""
    whole = gzip.decompress(member)
    head, _, rest = whole.partition(b"\r\n\r\n")
    fields = headers_of(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    number = lambda x: int(x[len("<urn:page:") : -1]) if x and x != "<urn:page:>" else None
    if fields["warc-type"] == "response":
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError("a payload does not have its digest")
        size = len(payload)
    else:
        size = int(headers_of(http)["content-length"])
    return number(fields["warc-record-id"]), size, digest, fields["warc-type"], number(fields.get("warc-refers-to"))


def opened(path: str):
    """(file system, path) for any store that Arrow knows; Hadoop's names for S3 are Arrow's s3."""
    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    return fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + colon + rest)


def classified(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, refers_to."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    firsts = rows.filter(F.length("payload") >= MIN_PAYLOAD).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    told = rows.join(firsts, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return told.withColumn("refers_to", F.when(revisit, F.col("first"))).select("page_id", "url", "payload", "digest", "refers_to")


def write_archives(pages: DataFrame, folder: str, zip64: bool = False, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write classified pages; returns path, size and records of each archive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}"
        files, root = opened(folder)
        files.create_dir(root, recursive=True)
        data, lines, number = bytearray(), [], 0

        def close() -> pa.RecordBatch:
            nonlocal number
            body = zip_bytes([(DATA, bytes(data)), (INDEX, "".join(lines).encode())], zip64)
            file = f"{name}-{number:04d}.wacz"
            with files.open_output_stream(f"{root}/{file}") as out:
                out.write(body)
            row = pa.RecordBatch.from_arrays([pa.array([f"{folder}/{file}"]), pa.array([len(body)], pa.int64()), pa.array([len(lines)], pa.int64())], names=["path", "size", "records"])
            data.clear()
            lines.clear()
            number += 1
            return row

        for whole in batches:
            for batch in groups(whole, 2):
                for row in batch.to_pylist():
                    one = record(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"])
                    lines.append(json.dumps({"page": row["page_id"], "offset": len(data), "length": len(one)}) + "\n")
                    data += one
                    if len(data) >= archive_bytes:
                        yield close()
        if lines:
            yield close()

    return stash(pages.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(run, "path string, size bigint, records bigint"), "archives")


def read_archives(archives: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of all records. archives: path, size."""

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, path = opened(row["path"])
                with files.open_input_file(path) as file:
                    read = lambda at, n, file=file: file.read_at(n, at)
                    members = read_directory(read, row["size"])
                    base, index = data_offset(read, members[DATA]), members[INDEX]
                    text = read(data_offset(read, index), index.size)
                if zlib.crc32(text) != index.crc:
                    raise ValueError("damaged index")
                starts, lengths = [], []
                for line in text.decode().splitlines():
                    entry = json.loads(line)
                    if not starts or entry["offset"] + base + entry["length"] - starts[-1] > range_bytes:
                        starts.append(base + entry["offset"])
                        lengths.append([])
                    lengths[-1].append(entry["length"])
                yield pa.RecordBatch.from_arrays([pa.array([row["path"]] * len(starts)), pa.array(starts, pa.int64()), pa.array(lengths, pa.list_(pa.int64()))], names=["path", "start", "lengths"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        for batch in batches:
            for row in batch.to_pylist():
                files, path = opened(row["path"])
                with files.open_input_file(path) as file:
                    body = file.read_at(sum(row["lengths"]), row["start"])
                rows, at = [], 0
                for n in row["lengths"]:
                    rows.append(parsed(body[at : at + n]))
                    at += n
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    ranges = archives.select("path", "size").mapInArrow(plan, "path string, start bigint, lengths array<bigint>")
    # A row stands for range_bytes, so that the number of tasks is told here: rows are too small for Spark to judge by.
    n_ranges = -(-int(archives.agg(F.sum("size")).first()[0] or 0) // range_bytes) + 1
    tasks = min(n_ranges, max(2 * archives.sparkSession.sparkContext.defaultParallelism, n_ranges // RANGES))
    dealt = ranges.repartition(tasks, F.col("path"), F.col("start"))
    return dealt.mapInArrow(fetch, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    return read_archives(write_archives(classified(table(spark, sf_dir, "pages")), folder))


OP6_SQL = """
WITH rows AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, sha256(coalesce(html, '')) AS digest FROM pages
), firsts AS (
  SELECT digest, min(page_id) AS first FROM rows WHERE octet_length(payload) >= 100 GROUP BY digest
)
SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, r.digest AS payload_digest,
  CASE WHEN first IS NOT NULL AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to
FROM rows r LEFT JOIN firsts f ON r.digest = f.digest
"""
