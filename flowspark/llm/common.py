"""What the training-data operators share: table access, lineage cuts, words, distributed ranks."""

from __future__ import annotations

import contextlib
import ctypes
import sys
import tempfile
import threading
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space of the word rule `[^\x20\x09-\x0D]+`; bytes.split() uses the same six characters.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share.

    It is set here only where it is unset and the session is local (one machine, as in tests).
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="flowspark-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_end_with_the_job(spark: SparkSession):
    """Spark deletes a job's shuffle files as soon as it has written its table, instead of whenever the driver collects garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


@contextlib.contextmanager
def rows_at_a_time(spark: SparkSession, rows: int):
    """Jobs that are run meanwhile send Python workers batches of at most so many rows."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def stash(df: DataFrame, name: str, compression: str = "zstd", by: str | None = None) -> DataFrame:
    """Cut the lineage: write df as Parquet in the shared folder (in a folder for each value of `by`) and read it back.

    Unlike a block held by one executor, the files survive the loss of any executor.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", compression)
    with shuffles_end_with_the_job(spark):
        (writer.partitionBy(by) if by else writer).parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept._stash = path
    return kept


def drop_stash(*frames: DataFrame) -> None:
    """Delete stashed tables that nothing reads any more. frames: as stash() returned them."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._stash)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def of_worker(key: tuple, make, idle: float = 10.0):
    """make()'s value, kept for the Python worker's later tasks and let go after some idle seconds."""
    kept = sys.__dict__.setdefault("_flowspark_kept", {})
    value, timer = kept.pop(key, (None, None))
    if timer:
        timer.cancel()
    value = make() if value is None else value
    try:
        yield value
    finally:
        timer = threading.Timer(idle, kept.pop, (key, None))
        timer.daemon = True
        kept[key] = (value, timer)
        timer.start()


def give_back() -> None:
    """Return freed memory to the system, as workers live on beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        with contextlib.suppress(AttributeError):  # C libraries other than glibc
            ctypes.CDLL(None).malloc_trim(0)


#: Texts that are handled together, in bytes.
GROUP_BYTES = 8_000_000


def groups(batch: pa.RecordBatch, column: int, held: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about so many bytes of text each, or one long text. What a slice took is given back to the system after it."""
    n = max(1, -(-batch.column(column).nbytes // held))
    step = max(1, -(-batch.num_rows // n))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)
        give_back()


def coded_words(texts: pa.BinaryArray, lower: bool = False) -> tuple[pa.BinaryArray, np.ndarray, np.ndarray]:
    """The distinct words of some texts (no nulls), the number of each word of all texts among them, and where each text's words end.

    Words are those of bytes.split(); lower: with A-Z in lower case.
    """
    plain = pa.StringArray.from_buffers(len(texts), *texts.buffers()[1:], offset=texts.offset)  # Arrow's kernels look at ASCII bytes only
    lists = pc.ascii_split_whitespace(pc.ascii_lower(plain) if lower else plain)
    flat, ends = lists.flatten(), lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()
    some = np.diff(np.frombuffer(flat.buffers()[1], dtype=np.int32)[flat.offset : flat.offset + len(flat) + 1]) > 0 if len(flat) else np.zeros(0, dtype=bool)
    if not some.all():  # white space at the ends of a text leaves empty parts
        flat, ends = flat.filter(pa.array(some)), np.concatenate([[0], np.cumsum(some)])[ends]
    coded = flat.dictionary_encode()
    words = coded.dictionary
    words = pa.BinaryArray.from_buffers(pa.binary(), len(words), words.buffers(), offset=words.offset)
    return words, coded.indices.to_numpy(zero_copy_only=False), np.asarray(ends, dtype=np.int64)


def id_of(docs: DataFrame, doc_id: str) -> Column:
    """Ids as keys that are never null: whole numbers as longs (null: the least one), others as strings (null: empty)."""
    if docs.schema[doc_id].dataType.typeName() in ("byte", "short", "integer", "long"):
        return F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63)))
    return F.coalesce(F.col(doc_id).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    """Words of a text, as long; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def magnitude(n: Column) -> Column:
    """An integer class that grows with n >= 0 and has four classes in each power of two.

    Integer arithmetic only, so that any SQL engine finds the same class.
    """
    bits = F.length(F.bin(n))
    return (bits * 4 + F.when(bits > 2, F.conv(F.substring(F.bin(n), 2, 2), 2, 10)).otherwise(n)).cast("int")


def spread(key: Column, n: int) -> Column:
    """0 to n - 1 by a hash of key that other SQL engines have too."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 4), 16, 10).cast("int") % n


def ranked(df: DataFrame, keys: list[str], coarse: Column, salt: Column, order: list, out: str = "rank") -> DataFrame:
    """Number the rows of each key from 0, without gathering a key in one task.

    Rows are dealt by (keys, coarse, salt); the counts of these cells, which are made before
    the shuffle, give the cells' first numbers, and only the rows of one cell are sorted
    together. The order within a key is (coarse, salt, order). Columns in keys are not null.
    """
    cell = [*keys, "_coarse", "_salt"]
    dealt = df.withColumns({"_coarse": coarse, "_salt": salt})
    counts = dealt.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_coarse", "_salt").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(*cell, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = F.row_number().over(Window.partitionBy(*cell).orderBy(*order))
    return (
        dealt.join(base, cell)
        .withColumn(out, (F.col("_base") + inside - 1).cast("long"))
        .drop("_coarse", "_salt", "_base")
    )


def numbered(df: DataFrame, order: list, out: str) -> DataFrame:
    """df, written to the shared folder, with all its rows numbered from 0 in an order.

    The sort is dealt by ranges; a row's number is its place in its part after the parts before. What is summed in one task
    and broadcast is a count for each part. drop_stash() takes the result.
    """
    ordered = stash(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", 33).alias("_part")
    counts = ordered.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    done = ordered.withColumn("_part", F.shiftright("_at", 33)).join(F.broadcast(first), "_part").withColumn(out, F.col("_first") + inside).drop("_part", "_at", "_first")
    done._stash = ordered._stash
    return done
