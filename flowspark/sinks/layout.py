"""Files of a planned size, whatever the sizes of the folders that they lie in.

The rows are written to the shared folder once, which tells what a row takes; rows of each folder are counted there, and each folder gets as many files as its share of the
bytes asks for. A row's file is its folder's first one and a hash of the row over the folder's files, so that a folder with most of the rows is written by many
tasks, and a task that is run again writes the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import kept_in
from ..types import column
from .store import bytes_of

MB = 1 << 20


def row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[column(c) for c in df.columns if df.schema[c].dataType.typeName() not in ("map", "variant")], F.lit("file"))


def planned(df: DataFrame, folders: tuple[str, ...], file_mb: float, compression: str) -> tuple[DataFrame, list[str]]:
    """df dealt to one partition for each file, and the tables in the shared folder that it is read from; the jobs that write it once and count are run.

    Rows that are equal in all columns share a file.
    """
    spark = df.sparkSession
    rows, where = kept_in(df, "layout", compression)
    total = rows.count()  # from the files' footers
    if not total:
        return rows, [where]
    share = bytes_of(spark, where) / total / (file_mb * MB)  # of a file, for a row
    if not folders:
        files = max(1, round(total * share))
        return rows.repartitionById(files, F.pmod(row_hash(rows), F.lit(files)).cast("int")), [where]
    keys = [f"_flow_k{i}" for i in range(len(folders))]
    counts = rows.groupBy(*[column(c).alias(k) for c, k in zip(folders, keys, strict=True)]).agg(F.greatest(F.lit(1), F.round(F.count(F.lit(1)) * share)).cast("long").alias("_flow_n"))
    counts, listed = kept_in(counts, "layout-folders", "zstd")  # a row for each folder, as a listing of the target has
    before = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    first = counts.withColumn("_flow_first", F.coalesce(F.sum("_flow_n").over(before), F.lit(0)))
    files = counts.agg(F.sum("_flow_n")).first()[0]
    same = F.lit(True)
    for c, k in zip(folders, keys, strict=True):
        same = same & column(c).eqNullSafe(F.col(k))
    number = (F.col("_flow_first") + F.pmod(row_hash(rows), F.col("_flow_n"))).cast("int").alias("_flow_file")
    dealt = rows.join(first, same).select(*[column(c) for c in df.columns], number)
    return dealt.repartitionById(files, F.col("_flow_file")).drop("_flow_file"), [where, listed]
