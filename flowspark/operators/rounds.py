"""Long tables that are joined and ranked a part at a time, and stored in the shared folder.

Whatever joins and windows shuffle lies on disk until their job ends. So a long table goes through its joins in rounds: each takes the rows whose key falls to it (Spark carries this
condition down to the first table's scan and over to its first partner) and adds what becomes of them to the stored table. Ranks take whole partitions of it, a slice at a time, which
is deleted then. What is shuffled at once is bounded by rows, however long the table is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import shared_folder
from ..sinks.store import names_in, remove
from ..types import column

#: Rows that a round takes of the first table.
ROUND_ROWS = 8_000_000
#: Tasks of a round that write a slice.
WRITERS = 4
SLICE, WRITER = "_flow_tanda", "_flow_escritor"
#: Shuffle files go with the job that made them, and stored tables aren't taken for smaller than they are in memory.
SETTINGS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.sources.fileCompressionFactor": "4.0"}


@contextmanager
def settings(spark: SparkSession) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def part(keys: list[Column], n: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def rounds(df: DataFrame, keys: tuple[str, ...], n: int) -> Iterator[DataFrame]:
    """df's rows in n parts by their keys."""
    for i in range(n):
        yield df.filter(part([column(k) for k in keys], n) == i) if n > 1 else df


def add(df: DataFrame, path: str, by: str | None = None) -> None:
    """Append df's rows to a stored table, but for columns without a type, which no file holds."""
    typed = df.select(*[column(c) for c, kind in df.dtypes if kind != "void"])
    writer = typed.write.mode("append").option("compression", "zstd")
    with settings(df.sparkSession):
        (writer.partitionBy(by) if by else writer).parquet(path)


def read_back(like: DataFrame, path: str) -> DataFrame:
    kinds = dict(like.dtypes)
    schema = like.select(*[column(c) for c in like.columns if kinds[c] != "void"]).schema
    found = like.sparkSession.read.schema(schema).parquet(path)
    return found.select(*[F.lit(None).alias(c) if kinds[c] == "void" else column(c) for c in like.columns])


def stored(df: DataFrame, name: str, keys: tuple[str, ...] = (), n: int = 1) -> tuple[DataFrame, str]:
    """df, written to the shared folder in n rounds by its keys, and where it lies."""
    path = shared_folder(df.sparkSession, name)
    for one in rounds(df, keys, n):
        add(one, path)
    return read_back(df, path), path


def stored_by_slices(df: DataFrame, name: str, keys: tuple[str, ...], n: int, partition: list[Column], make: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, str]:
    """make(df), which may rank rows inside of partitions, written to the shared folder, and where it lies. df is made in n rounds by its keys, make's work is done in as many slices."""
    spark, path, out = df.sparkSession, shared_folder(df.sparkSession, f"{name}-slices"), shared_folder(df.sparkSession, name)
    try:
        writer = part([*[column(k) for k in keys], F.lit(WRITER)], WRITERS)
        for one in rounds(df.withColumns({SLICE: part(partition, n), WRITER: writer}), keys, n):
            add(one.repartition(SLICE, WRITER).drop(WRITER).sortWithinPartitions(SLICE, *[column(k) for k in keys]), path, SLICE)  # rows of one key are alike and take less
        found = make(df.limit(0))
        add(found, out)
        for folder in names_in(spark, path):
            if folder.startswith(f"{SLICE}="):
                add(make(read_back(df, f"{path}/{folder}")), out)
                remove(spark, f"{path}/{folder}")
    finally:
        remove(spark, path)
    return read_back(found, out), out
