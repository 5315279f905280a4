"""Media columns as content-defined chunks.

A text's bytes, padded to a multiple of 64, become the samples of an 8-bit mono WAV. The media are cut where a rolling gear hash
of the last 32 bytes has zero low bits, so that equal passages give equal chunks wherever they stand. Chunk digests are
deduplicated by Spark joins: each distinct chunk has one owner, the least (medium, place), which alone stores its bytes. A medium's
row in the store holds its ordered chunk list and its own chunks, compressed together. Reading back fetches the chunks of other owners
by digest, checks every chunk's digest, and puts the medium together in order; a mismatch is an error.

Equal texts are one medium. Only digests, places and compressed bytes are shuffled.

Defined cases: a null text is an empty text (64 zero bytes of payload); a null doc_id counts as the least id for ownership
and is returned as null; ids are of any type; repeated rows get equal values; an empty table gives an empty table; very long texts are stored whole (up to
Spark's limit for a value); other columns are not used.
"""

from __future__ import annotations

import bz2
import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_stash, groups, id_of, stash, table
from .minhash import mixed

BLOCK = 64
LEAST, MASK_BITS, MOST = 512, 11, 8192
RATE = 8000


def payload_of(text: bytes) -> bytes:
    return text + bytes(max(BLOCK, -(-len(text) // BLOCK) * BLOCK) - len(text))


def to_wav(payload: bytes) -> bytes:
    """RIFF header for unsigned 8-bit mono samples, then the samples."""
    head = b"RIFF" + struct.pack("<I", 36 + len(payload)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, RATE, RATE, 1, 8)
    return head + b"data" + struct.pack("<I", len(payload)) + payload


def from_wav(media: bytes) -> bytes:
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV")
    at = 12
    while at + 8 <= len(media):
        name, size = media[at : at + 4], struct.unpack("<I", media[at + 4 : at + 8])[0]
        if name == b"data":
            return media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no samples")


def gear_table() -> np.ndarray:
    return (mixed(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def cuts(media: bytes, table: np.ndarray) -> list[int]:
    """The ends of the chunks. The rolling hash h = 2 h + gear[byte] (mod 2**32) is summed by doubling spans of bytes."""
    n = len(media)
    h = table[np.frombuffer(media, dtype=np.uint8)]
    span = 1
    while span < 32:
        h[span:] = h[span:] + (h[:-span] << np.uint32(span))
        span *= 2
    marks = np.flatnonzero((h >> np.uint32(32 - MASK_BITS)) == 0) + 1
    ends, last = [], 0
    while n - last > LEAST:
        i = np.searchsorted(marks, last + LEAST)
        end = min(int(marks[i]) if i < len(marks) else n, last + MOST, n)
        ends.append(end)
        last = end
    if last < n:
        ends.append(n)
    return ends


def chunks_of(media: bytes, table: np.ndarray) -> list[bytes]:
    ends = cuts(media, table)
    return [media[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def feature_of(payload: bytes) -> str:
    """Number, sum and squares of the samples, changes of sign about the middle, and the commonest sample; whole numbers only."""
    x = np.frombuffer(payload, dtype=np.uint8)
    counts = np.bincount(x, minlength=256)
    values, low, peak = np.arange(256), x < 128, int(counts.argmax())
    crossings = int(np.count_nonzero(low[1:] != low[:-1]))
    return f"samples={len(x)};sum={int(counts @ values)};squares={int(counts @ (values * values))};crossings={crossings};peak={peak}x{counts[peak]}"


LISTS = pa.list_(pa.binary())


def key_of(text: bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=16, person=b"medium").digest()


def described(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """doc_id, doc (id without nulls), n_bytes, media_key, digests: one row per document."""
    chosen = docs.select(
        F.col(doc_id).alias("doc_id"), id_of(docs, doc_id).alias("doc"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gear = gear_table()
        for whole in batches:
            for batch in groups(whole, 2):
                texts = [body.as_py() for body in batch.column(2)]
                lists = [[digest(c) for c in chunks_of(to_wav(payload_of(t)), gear)] for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([len(t) for t in texts], pa.int64()), pa.array([key_of(t) for t in texts], pa.binary()), pa.array(lists, LISTS)],
                    names=["doc_id", "doc", "n_bytes", "media_key", "digests"],
                )

    kind, key = (chosen.schema[c].dataType.simpleString() for c in ("doc_id", "doc"))
    return chosen.mapInArrow(run, f"doc_id {kind}, doc {key}, n_bytes bigint, media_key binary, digests array<binary>")


def owners(seen: DataFrame) -> DataFrame:
    """One row per medium: media_key, doc (that holds its text), foreign and lent (places of chunks that another medium owns, or that others need)."""
    firsts = seen.groupBy("media_key").agg(F.min("doc").alias("doc"))
    media = seen.select("media_key", "doc", "digests").join(firsts, ["media_key", "doc"]).dropDuplicates(["media_key", "doc"])
    placed = stash(media.select("media_key", F.posexplode("digests").alias("at", "digest")), "chunk-places")
    held = placed.groupBy("digest").agg(F.min(F.struct("media_key", "at")).alias("owner"), F.count(F.lit(1)).alias("uses")).filter("uses > 1").drop("uses")
    mine = (F.col("owner.media_key") == F.col("media_key")) & (F.col("owner.at") == F.col("at"))
    shared = placed.join(held, "digest").groupBy("media_key").agg(
        F.collect_list(F.when(~mine, F.col("at"))).alias("foreign"), F.collect_list(F.when(mine, F.col("at"))).alias("lent")
    )
    none = F.array().cast("array<int>")
    owned = stash(firsts.join(shared, "media_key", "left").withColumns({"foreign": F.coalesce("foreign", none), "lent": F.coalesce("lent", none)}), "owners")
    drop_stash(placed)
    return owned


def stored(docs: DataFrame, owned: DataFrame, text: str, doc_id: str) -> DataFrame:
    """The store: media_key, digests, lengths, foreign, lent and bytes (own chunks in order, compressed together).

    Media travel compressed, and are stored as they came unless some of their chunks have other owners.
    """
    packed = docs.select(id_of(docs, doc_id).alias("doc"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in groups(whole, 1):
                texts = [x.as_py() for x in batch.column(1)]
                keys = [key_of(t) for t in texts]
                bodies = [bz2.compress(to_wav(payload_of(t))) for t in texts]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(bodies, pa.binary())], names=["doc", "media_key", "bytes"])

    small = packed.mapInArrow(squeeze, f"doc {packed.schema['doc'].dataType.simpleString()}, media_key binary, bytes binary")
    chosen = small.join(owned, ["doc", "media_key"]).dropDuplicates(["doc", "media_key"]).select("media_key", "foreign", "lent", "bytes")
    names = ["media_key", "digests", "lengths", "foreign", "lent", "bytes"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gear = gear_table()
        for batch in batches:
            lists, lengths, bodies = [], [], []
            for foreign, body in zip(batch.column(1), batch.column(3), strict=True):
                away, body = set(foreign.as_py()), body.as_py()
                parts = chunks_of(bz2.decompress(body), gear)
                lists.append([digest(c) for c in parts])
                lengths.append([len(c) for c in parts])
                bodies.append(bz2.compress(b"".join(c for i, c in enumerate(parts) if i not in away)) if away else body)
            columns = [batch.column(0), pa.array(lists, LISTS), pa.array(lengths, pa.list_(pa.int32())), batch.column(1), batch.column(2), pa.array(bodies, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "media_key binary, digests array<binary>, lengths array<int>, foreign array<int>, lent array<int>, bytes binary"
    return stash(chosen.mapInArrow(build, schema), "media-store", "none")


def own_chunks(body: bytes, lengths: list[int], foreign: list[int]) -> dict[int, bytes]:
    """Place to chunk, of a store row's own chunks."""
    away, body, at, out = set(foreign), bz2.decompress(body), 0, {}
    for i, n in enumerate(lengths):
        if i not in away:
            out[i] = body[at : at + n]
            at += n
    return out


def read_back(store: DataFrame) -> DataFrame:
    """media_key and what the medium, put together again, gives: payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256 (both binary), feature."""

    def lend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, parts = [], []
            for row in batch.to_pylist():
                own = own_chunks(row["bytes"], row["lengths"], row["foreign"])
                keys += [row["digests"][i] for i in row["lent"]]
                parts += [zlib.compress(own[i]) for i in row["lent"]]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(parts, pa.binary())], names=["digest", "chunk"])

    lent = store.filter("size(lent) > 0").select("digests", "lengths", "foreign", "lent", "bytes").mapInArrow(lend, "digest binary, chunk binary")
    asked = store.filter("size(foreign) > 0").select("media_key", F.explode("foreign").alias("at"), "digests").select("media_key", "at", F.expr("digests[at]").alias("digest"))
    fetched = asked.join(lent, "digest").groupBy("media_key").agg(F.collect_list(F.struct("at", "chunk")).alias("fetched"))
    none = F.array().cast("array<struct<at: int, chunk: binary>>")
    alone = store.filter("size(foreign) = 0").withColumn("fetched", none)
    mixed_rows = store.filter("size(foreign) > 0").join(fetched, "media_key", "left").withColumn("fetched", F.coalesce("fetched", none))
    names = ["media_key", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    kinds = [pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.string()]

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                parts = own_chunks(row["bytes"], row["lengths"], row["foreign"]) | {x["at"]: zlib.decompress(x["chunk"]) for x in row["fetched"]}
                ordered = [parts.get(i) for i in range(len(row["digests"]))]
                if any(p is None or digest(p) != d for p, d in zip(ordered, row["digests"], strict=True)):
                    raise ValueError("a stored chunk is missing or damaged")
                media = b"".join(ordered)
                payload = from_wav(media)
                rows.append((row["media_key"], len(payload), hashlib.sha256(payload).digest(), zlib.crc32(payload[-BLOCK:]), len(media), hashlib.sha256(media).digest(), feature_of(payload)))
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    columns = ["media_key", "digests", "lengths", "foreign", "bytes", "fetched"]
    schema = "media_key binary, payload_bytes bigint, payload_sha256 binary, tail_crc32 bigint, media_bytes bigint, media_sha256 binary, feature string"
    return alone.select(columns).mapInArrow(restore, schema).unionByName(mixed_rows.select(columns).mapInArrow(restore, schema))


def media_columns(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(documents with their media_key and n_bytes, the store)."""
    seen = stash(described(docs, text, doc_id), "described")
    return seen.select("doc_id", "n_bytes", "media_key"), stored(docs, owners(seen), text, doc_id)


def op4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, store = media_columns(table(spark, sf_dir, "documents").select("doc_id", "text"))
    got = docs.join(read_back(store), "media_key").drop("media_key")
    return got.withColumns({c: F.lower(F.hex(c)) for c in ("payload_sha256", "media_sha256")})


OP4_SQL = r"""
WITH bodies AS (
  SELECT doc_id, encode(coalesce(text, '')) AS body FROM documents
), padded AS (
  SELECT doc_id, octet_length(body) AS n_bytes, body || repeat('\x00'::BLOB, greatest(64, (octet_length(body) + 63) // 64 * 64) - octet_length(body)) AS payload FROM bodies
), sized AS (
  SELECT *, octet_length(payload) AS n, octet_length(payload) + 36 AS m FROM padded
), stored AS (
  SELECT *, 'RIFF'::BLOB || unhex(printf('%02x%02x%02x%02x', m & 255, (m >> 8) & 255, (m >> 16) & 255, m >> 24)) || 'WAVEfmt '::BLOB || unhex('1000000001000100401f0000401f000001000800')
    || 'data'::BLOB || unhex(printf('%02x%02x%02x%02x', n & 255, (n >> 8) & 255, (n >> 16) & 255, n >> 24)) || payload AS media FROM sized
), samples AS (
  SELECT doc_id, k, CAST('0x' || h[k] AS BIGINT) AS v FROM (SELECT doc_id, h, unnest(range(1, CAST(len(h) AS BIGINT) + 1)) AS k FROM (SELECT doc_id, regexp_extract_all(hex(payload), '..') AS h FROM padded))
), counted AS (
  SELECT doc_id, v, count(*) AS c FROM samples GROUP BY doc_id, v
), peaks AS (
  SELECT doc_id, arg_min(v, (-c, v)) AS peak, max(c) AS c FROM counted GROUP BY doc_id
), shape AS (
  SELECT doc_id, sum(v) AS total, sum(v * v) AS squares, count(*) FILTER ((v < 128) <> (before < 128)) AS crossings, list(v ORDER BY k) AS vs
  FROM (SELECT *, lag(v) OVER (PARTITION BY doc_id ORDER BY k) AS before FROM samples) GROUP BY doc_id
), tails AS (
  SELECT doc_id, total, squares, crossings, vs[len(vs) - 63:] AS t FROM shape
)
SELECT s.doc_id, n_bytes, n AS payload_bytes, sha256(payload) AS payload_sha256,
  xor(list_reduce(list_prepend(4294967295, range(512)), lambda acc, k: xor(xor(acc, CASE WHEN k % 8 = 0 THEN t[k // 8 + 1] ELSE 0 END) >> 1, 3988292384 * (xor(acc, CASE WHEN k % 8 = 0 THEN t[k // 8 + 1] ELSE 0 END) & 1))), 4294967295) AS tail_crc32,
  octet_length(media) AS media_bytes, sha256(media) AS media_sha256,
  'samples=' || n || ';sum=' || total || ';squares=' || squares || ';crossings=' || crossings || ';peak=' || peak || 'x' || c AS feature
FROM stored s JOIN tails t ON s.doc_id = t.doc_id JOIN peaks p ON s.doc_id = p.doc_id
"""
