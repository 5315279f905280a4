"""Near-duplicate documents by MinHash, with odd sketches to judge candidates.

A document's word shingles are hashed to 64 bits. MinHash samples of the set are cut into bands for candidate
search and folded into an odd sketch: a bitmap in which each sample flips one bit. The XOR
of two bitmaps has about as many ones as twice the samples that differ, which tells high similarities
precisely; pairs whose count is beyond what the threshold allows (by far more than chance
explains) are dropped. So are pairs for which a second bitmap, in which each shingle flips one bit, shows too large a
symmetric difference (it never shows more than there is). All others are confirmed on the full shingle sets.

Documents with equal sets form a class first, and only the class's least id goes on. Within a band's bucket each
class is first compared with the bucket's least id alone. After joining what was confirmed, only the classes that are
outside the component of their bucket's least id are compared with the bucket's other components, so that large groups of copies
never make all their pairs, and no candidate pair of different components is left out.

Defined cases: null and empty texts have empty sets and are linked with nothing; rows with a null doc_id
are linked with nothing and have a null component; ids are of any type that can be sorted; rows of one id have one component, which all of their texts
are linked into, but `drop_near_copies` judges each row by its own text; an empty table gives an empty table; very long texts are used whole;
other columns are carried along by `drop_near_copies`.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..operators.keyfilter import blocks_for, may_be_among
from .common import coded_words, drop_stash, groups, numbered, stash, table
from .components import components

WORDS, PERCENT, ROWS, BANDS = 3, 85, 5, 30
BITS, SET_BITS = 256, 512
SEED = 20_240_117


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (a bijection)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word shingles; the words are lower-cased (A-Z) bytes."""

    def __init__(self, words: int = WORDS):
        self.words = words

    def __call__(self, texts: pa.BinaryArray) -> Iterator[np.ndarray]:
        """Of each text."""
        import xxhash

        distinct, codes, ends = coded_words(texts, lower=True)
        digest = xxhash.xxh3_64_intdigest
        hashes = np.fromiter(map(digest, distinct.to_pylist()), dtype=np.uint64, count=len(distinct))[codes]
        for begin, end in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            yield self.shingles(hashes[begin:end])

    def shingles(self, hashes: np.ndarray) -> np.ndarray:
        if not len(hashes):
            return hashes
        size = min(self.words, len(hashes))
        n = len(hashes) - size + 1
        out = np.full(n, size, dtype=np.uint64)
        for k in range(size):
            out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n])
        return np.unique(out)


class Sketcher:
    def __init__(self, rows: int = ROWS, bands: int = BANDS, bits: int = BITS):
        self.rows, self.bands, self.bits = rows, bands, bits
        rng = np.random.default_rng(SEED)
        self.factors = rng.integers(0, 1 << 63, rows * bands, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.marks = mixed(np.arange(1, rows * bands + 1, dtype=np.uint64))

    def samples(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(len(self.factors), np.iinfo(np.uint64).max, dtype=np.uint64)
        for at in range(0, len(shingles), 1024):
            np.minimum(least, (self.factors[:, None] * shingles[None, at : at + 1024]).min(axis=1), out=least)
        return least

    def __call__(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The odd sketch and the set's parities as signed 64-bit numbers, and the bands' keys."""
        marked = mixed(self.samples(shingles) ^ self.marks)
        odd = (np.bincount((marked >> np.uint64(40)).astype(np.int64) % self.bits, minlength=self.bits) & 1).astype(np.uint8)
        keys = np.zeros(self.bands, dtype=np.uint64)
        for part in marked.reshape(self.bands, self.rows).T:
            keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + part)
        whole = (np.bincount((shingles >> np.uint64(20)).astype(np.int64) % SET_BITS, minlength=SET_BITS) & 1).astype(np.uint8)
        return np.packbits(np.concatenate([odd, whole])).view(np.int64), keys.view(np.int64)


def odd_limit(samples: int, percent: int, bits: int = BITS) -> int:
    """Ones in the XOR of two odd sketches that a pair at the threshold exceeds with a chance below 1e-9."""
    t = percent / 100
    differ = samples * (1 - t) + 6.5 * math.sqrt(samples * t * (1 - t))
    return math.ceil(bits / 2 * (1 - math.exp(-4 * differ / bits)) + 1.5 * math.sqrt(bits) / 2)


def keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """doc_id, mark (a hash that tells the texts of one id apart), text as bytes."""
    return docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("mark"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))


def sketched(docs: DataFrame, text: str, doc_id: str, words: int, rows: int, bands: int) -> DataFrame:
    """doc_id, mark, n (set size), set_key, sketch, bands."""
    chosen = keyed(docs, text, doc_id)
    kind = chosen.schema["doc_id"].dataType
    longs = pa.list_(pa.int64())
    out = pa.schema([("doc_id", to_arrow_type(kind)), ("mark", pa.int64()), ("n", pa.int64()), ("set_key", pa.binary()), ("sketch", longs), ("bands", longs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, sketcher = Shingler(words), Sketcher(rows, bands)
        for whole in batches:
            for batch in groups(whole, 2):
                sizes, keys, sketches, buckets = [], [], [], []
                for s in shingler(batch.column(2)):
                    sizes.append(len(s))
                    keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    sketch, band = sketcher(s) if len(s) else ([], [])
                    sketches.append(sketch)
                    buckets.append(band)
                made = [pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sketches, longs), pa.array(buckets, longs)]
                yield pa.RecordBatch.from_arrays([batch.column(0).cast(out.field(0).type), batch.column(1), *made], schema=out)

    return chosen.mapInArrow(run, f"doc_id {kind.simpleString()}, mark bigint, n bigint, set_key binary, sketch array<bigint>, bands array<bigint>")


def full_sets(docs: DataFrame, wanted: DataFrame, n: int, text: str, doc_id: str, words: int) -> DataFrame:
    """rep, shingles (binary, sorted 64-bit hashes) of the texts in wanted(rep, doc_id, mark), which are n; equal rows give their set once in a task.

    Texts that aren't asked for are held back by a filter of bounded size before they are shuffled.
    """
    chosen = keyed(docs, text, doc_id)
    if blocks := blocks_for(n):
        chosen = may_be_among(chosen, wanted.select("mark"), ["mark"], blocks)
    chosen = chosen.join(wanted, ["doc_id", "mark"]).select("rep", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = Shingler(words), set()
        for whole in batches:
            for batch in groups(whole, 1):
                reps = batch.column(0).to_pylist()
                new = [r not in seen and not seen.add(r) for r in reps]
                batch = batch.filter(pa.array(new, pa.bool_()))
                sets = [s.tobytes() for s in shingler(batch.column(1))]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["rep", "shingles"])

    return chosen.mapInArrow(run, "rep bigint, shingles binary")


def differing(a: Column, b: Column, first: int, words: int) -> Column:
    """Ones in the XOR of some words of two bitmaps."""
    out = F.lit(0)
    for i in range(first, first + words):
        out = out + F.bit_count(F.element_at(a, i + 1).bitwiseXOR(F.element_at(b, i + 1)))
    return out


def alike(x: str, y: str, percent: int, limit: int) -> Column:
    """Whether sizes, odd sketches and parities of rows x and y allow the threshold.

    The parities' limit is the largest symmetric difference at the threshold or, for large sets, what it shows by far at most.
    """
    a, b = F.col(f"{x}.n"), F.col(f"{y}.n")
    s, t = F.col(f"{x}.sketch"), F.col(f"{y}.sketch")
    most = (a + b) * F.lit((100 - percent) / (100 + percent))
    shown = F.lit(SET_BITS / 2) * (1 - F.exp(most * F.lit(-2 / SET_BITS))) + F.lit(6.5) * F.sqrt(F.least(most, F.lit(SET_BITS / 4)))
    return (
        (F.least(a, b) * 100 >= F.greatest(a, b) * percent)
        & (differing(s, t, BITS // 64, SET_BITS // 64) <= F.least(most, shown) + 1e-6)
        & (differing(s, t, 0, BITS // 64) <= limit)
    )


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike."""
    one, other = (sets.select(F.col("rep").alias(k), F.col("shingles").alias(f"set_{k}")) for k in "ab")
    both = pairs.select("a", "b").join(one, "a").join(other, "b").select("a", "b", "set_a", "set_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for s, t in zip(batch.column(2), batch.column(3), strict=True):
                s, t = (np.frombuffer(x.as_py(), dtype=np.uint64) for x in (s, t))
                shared = len(s) + len(t) - len(np.unique(np.concatenate([s, t])))
                keep.append(100 * shared >= percent * (len(s) + len(t) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a bigint, b bigint")


def near_copies(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = WORDS, percent: int = PERCENT, rows: int = ROWS, bands: int = BANDS
) -> DataFrame:
    """doc_id, mark (of the text), n (set size), component, lead (the least id that the text alone is linked with): one row for each row of docs.

    A table in the shared folder; what was made on the way to it is deleted. drop_stash() takes the result.
    """
    limit = odd_limit(rows * bands, percent)
    seen = stash(sketched(docs, text, doc_id, words, rows, bands), "sketches")
    some = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    # One row for each set, and for each of its bands. Sets are numbered by their least ids.
    sets = seen.filter(some).groupBy("set_key").agg(F.min(F.struct("doc_id", "mark")).alias("least"), *[F.first(c).alias(c) for c in ("n", "sketch", "bands")])
    reps = numbered(sets.select("set_key", "least.*", "n", "sketch", "bands"), ["doc_id", "mark"], "rep")
    rows_of = reps.select("rep", "n", "sketch", F.explode("bands").alias("bucket"))
    pivots = rows_of.groupBy("bucket").agg(F.min("rep").alias("pivot"), F.count(F.lit(1)).alias("members")).filter("members > 1").drop("members")
    members = stash(rows_of.select("bucket", "rep").join(pivots, "bucket"), "members")
    made = [seen, reps, members]

    info = reps.select("rep", "n", "sketch")
    stars = members.select("rep", "pivot").filter("rep <> pivot").distinct()
    pairs = (
        stars.join(info.alias("x"), "rep")
        .join(info.withColumnRenamed("rep", "pivot").alias("y"), "pivot")
        .filter(alike("x", "y", percent, limit))
        .select(F.col("rep").alias("a"), F.col("pivot").alias("b"))
    )
    pairs = stash(pairs, "pairs")  # stars are distinct; no aggregation here, so that the join's hot pivots can be split

    def linked(p: DataFrame) -> DataFrame:
        asked = stash(p.select(F.explode(F.array("a", "b")).alias("rep")).distinct().join(reps.select("rep", "doc_id", "mark"), "rep"), "asked")
        whole = stash(full_sets(docs, asked, asked.count(), text, doc_id, words), "sets")
        out = stash(confirmed(p, whole, percent), "links")
        drop_stash(asked, whole)
        return out

    links = linked(pairs)
    joined = components(links)
    made += [pairs, links, joined]

    # Classes outside the component of their bucket's pivot, against the bucket's other components. Both sides are dealt by bucket and
    # class of set size, where the sets of the class below are guests.
    placed = members.join(joined.select(F.col("id").alias("rep"), "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    placed = placed.join(joined.select(F.col("id").alias("pivot"), F.col("component").alias("main")), "pivot", "left").withColumn("main", F.coalesce("main", "pivot"))
    placed = stash(placed.select("bucket", "rep", "component", F.col("component") != F.col("main")).toDF("bucket", "rep", "component", "outside"), "placed")
    mixed_buckets = placed.filter("outside").select("bucket").distinct()
    dealt = placed.join(mixed_buckets, "bucket", "left_semi").join(info, "rep").withColumn("guest", F.explode(F.array(F.lit(0), F.lit(1))))
    dealt = dealt.withColumn("sized", F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent) + 1e-9).cast("int") + F.col("guest"))
    once = (F.col("x.rep") < F.col("y.rep")) & (F.col("x.guest") + F.col("y.guest") < 2) & (F.col("x.outside") | F.col("y.outside"))
    more = (
        dealt.alias("x")
        .join(dealt.alias("y"), (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.sized") == F.col("y.sized")) & once & (F.col("x.component") != F.col("y.component")) & alike("x", "y", percent, limit))
        .select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))
        .distinct()
    )
    more = stash(more.join(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_anti"), "more")
    made += [placed, more]
    if more.limit(1).count():
        extra = linked(more)
        made.append(extra)
        if extra.limit(1).count():
            joined = components(links.unionByName(extra))
            made.append(joined)

    # Each set's lead; then the rows, of which those without a set or an id are on their own.
    within = reps.select("set_key", "rep", "doc_id").join(joined.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    leads = within.join(within.groupBy("component").agg(F.min("doc_id").alias("lead")), "component").select("set_key", "lead")
    told = seen.filter(some).join(leads, "set_key").select("doc_id", "mark", "n", "lead")
    alone = seen.filter(~some).select("doc_id", "mark", "n", F.col("doc_id").alias("lead"))
    told = stash(told.unionByName(alone), "leads")
    drop_stash(*made)

    # The texts of one id may have different leads.
    several = told.filter("lead IS NOT NULL").groupBy("doc_id").agg(F.min("lead").alias("a"), F.max("lead").alias("b")).filter("a <> b")
    if not several.limit(1).count():
        done = told.withColumn("component", F.col("lead"))
    else:
        ways = told.join(several.select("doc_id", "a"), "doc_id").select("a", F.col("lead").alias("b"))
        ends = components(ways)
        done = stash(told.join(ends.select(F.col("id").alias("lead"), "component"), "lead", "left").withColumn("component", F.coalesce("component", "lead")), "near")
        drop_stash(told, ends)
        return done
    done._stash = told._stash
    return done


def drop_near_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """docs without the rows whose texts are linked with a row of a smaller id; of rows with the least id all stay."""
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"), F.col(doc_id).alias("doc_id"))
    gone = near_copies(rows, **options).filter("doc_id <> lead").select("doc_id", "mark").distinct()
    return rows.withColumn("mark", F.xxhash64("text")).join(gone, ["doc_id", "mark"], "left_anti").select("row.*")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = near_copies(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), (F.col("doc_id") == F.col("component")).alias("kept"))


OP10_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, CAST(len(w) AS BIGINT) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words
), sized AS (
  SELECT doc_id, CAST(len(s) AS BIGINT) AS n, s FROM sets
), items AS (
  SELECT doc_id, n, unnest(s) AS x FROM sized
), ordered AS (
  SELECT doc_id, n, x, row_number() OVER (PARTITION BY doc_id ORDER BY uses, x) AS place FROM (SELECT *, count(*) OVER (PARTITION BY x) AS uses FROM items)
), prefix AS (
  SELECT doc_id, n, x FROM ordered WHERE place <= n - (n * 85 + 99) // 100 + 1
), pairs AS (
  SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM prefix a JOIN prefix b ON a.x = b.x AND a.doc_id < b.doc_id AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 85
), links AS (
  SELECT a, b FROM pairs JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b
  WHERE 100 * len(list_intersect(x.s, y.s)) >= 85 * (x.n + y.n - len(list_intersect(x.s, y.s)))
), ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT a AS doc_id, b AS other FROM ways UNION SELECT doc_id, b FROM reached JOIN ways ON other = a
), least_of AS (
  SELECT doc_id, min(other) AS other FROM reached GROUP BY doc_id
)
SELECT s.doc_id, n AS n_shingles, coalesce(least(s.doc_id, other), s.doc_id) AS component_id, coalesce(other >= s.doc_id, TRUE) AS kept FROM sized s LEFT JOIN least_of l ON s.doc_id = l.doc_id
"""
