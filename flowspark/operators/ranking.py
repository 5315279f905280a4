"""Ranks over partitions that no single task could hold, up to one partition that is the whole table.

A window function gathers a partition in one task. Here row numbers come from rows that are sorted once by ranges and written: a range holds a stretch of one partition or several
partitions, and a row's place is its number in its range and what stands before the range. For ranks the rows of each order are counted where they are read, the counts are sorted by ranges and
summed, and rows look their order up, without a shuffle. Where orders (or, for row numbers, partitions) are too many to broadcast, rows and
counts are dealt by partition, order and a part of a hash. Equal orders have equal ranks wherever their rows are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import kept, kept_in
from ..sinks.store import bytes_of, remove
from ..types import column

RANK, ROW_NUMBER = 1, 4
#: Parts that rows of one order are dealt to.
SALTS = 256
#: Orders, or partitions, that are broadcast at most, and the bytes that they take as a file.
FEW, FEW_BYTES = 500_000, 16 << 20


def plain_rank(partition: list[Column], order: list[Column], down: bool, mode: int) -> Column:
    spec = Window.partitionBy(*partition).orderBy(*[c.desc() if down else c.asc() for c in order])
    return (F.rank() if mode == RANK else F.row_number()).over(spec)


def largest_partition(df: DataFrame, partition: list[Column]) -> int:
    """Rows of the largest partition, by one job that reads what the partition is made of."""
    return df.groupBy(*partition).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


def first_places(counts: DataFrame, keys: list[str], order: list[str], down: bool) -> DataFrame:
    """counts: keys, order, _n. Adds _before, the sum of _n of what has equal keys and an earlier order."""
    by = [*[F.col(k).asc() for k in keys], *[F.col(o).desc() if down else F.col(o).asc() for o in order]]
    placed = kept(counts.orderBy(*by).withColumn("_at", F.monotonically_increasing_id()), "ranks")
    placed = placed.withColumn("_range", F.shiftright("_at", 33))
    ranges = placed.groupBy("_range", *keys).agg(F.sum("_n").alias("_sum"))
    ahead = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select("_range", *keys, F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_n"), F.lit(-1).cast("long").alias("_at"))
    # The sum of the ranges before stands as a row at the begin of each range. Rows are dealt by ranges again, as the hashes of so few numbers would meet in some tasks.
    all_rows = placed.unionByName(offsets, allowMissingColumns=True).repartitionByRange("_range")
    upto = Window.partitionBy("_range", *keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    return all_rows.withColumn("_before", F.sum("_n").over(upto)).filter("_at >= 0").select(*keys, *order, "_before")


def same_cell(cell: list[str]) -> Column:
    same = F.lit(True)
    for c in cell:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_f"))
    return same


def few(counts: DataFrame, name: str) -> DataFrame | None:
    """counts, written to the shared folder, or None if there are too many of them to broadcast."""
    counts, where = kept_in(counts, name)
    if counts.count() <= FEW and bytes_of(counts.sparkSession, where) <= FEW_BYTES:
        return counts
    remove(counts.sparkSession, where)
    return None


def looked_up(df: DataFrame, partition: list[Column], order: list[Column], down: bool) -> DataFrame | None:
    """df with _before, the rows of its partition that have an earlier order, from a table of all orders; None if there are too many of these.

    Rows stay where they are; equal orders are counted where they are read.
    """
    keys, orders = [f"_flow_p{i}" for i in range(len(partition))], [f"_flow_o{i}" for i in range(len(order))]
    cell = [*keys, *orders]
    rows = df.withColumns(dict(zip(cell, [*partition, *order], strict=True)))
    counts = few(rows.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n")), "orders")
    if counts is None:
        return None
    first = kept(first_places(counts, keys, orders, down).select(*[F.col(c).alias(f"{c}_f") for c in cell], "_before"), "places")
    return rows.join(F.broadcast(first), same_cell(cell))


def sorted_once(df: DataFrame, partition: list[Column], order: list[Column], down: bool, salt: Column) -> DataFrame | None:
    """df, sorted by ranges and written, with _before, the rows of its partition that come before; None if there are too many partitions to broadcast.

    A row's place in the whole is its number in its range after all that earlier ranges hold; the place where its partition begins is taken off.
    """
    keys = [f"_flow_p{i}" for i in range(len(partition))]
    with_keys = lambda df: df.withColumns(dict(zip(keys, partition, strict=True)))
    counts = few(with_keys(df).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "partitions") if keys else None
    if keys and counts is None:
        return None
    by = [*[p.asc() for p in partition], *[o.desc() if down else o.asc() for o in order], F.col("_flow_salt")]
    ordered = df.withColumn("_flow_salt", salt).orderBy(*by).drop("_flow_salt")
    rows = kept(ordered.withColumn("_at", F.monotonically_increasing_id()), "ranks")
    rows = rows.withColumns({"_range": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select("_range", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    rows = rows.join(F.broadcast(kept(ranges, "ranges")), "_range").withColumn("_before", F.col("_ahead") + F.col("_at"))
    if keys:
        starts = first_places(counts, [], keys, False).select(*[F.col(k).alias(f"{k}_f") for k in keys], F.col("_before").alias("_start"))
        rows = with_keys(rows).join(F.broadcast(kept(starts, "starts")), same_cell(keys)).withColumn("_before", F.col("_before") - F.col("_start"))
    return rows


def by_cells(df: DataFrame, partition: list[Column], order: list[Column], down: bool, mode: int, salt: Column) -> DataFrame:
    """df with _before, where what could be broadcast is too much: rows are dealt by partition, order and a part of a hash, and so are the counts of these cells."""
    keys, orders = [f"_flow_p{i}" for i in range(len(partition))], [f"_flow_o{i}" for i in range(len(order))]
    cell = [*keys, *orders, "_flow_salt"]
    rows = df.withColumns(dict(zip([*keys, *orders], [*partition, *order], strict=True)) | {"_flow_salt": salt})
    counts = rows.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n"))
    first = first_places(counts, keys, [*orders, "_flow_salt"], down)
    if mode == RANK:
        first = first.withColumn("_before", F.min("_before").over(Window.partitionBy(*keys, *orders)))
    found = rows.join(first.select(*[F.col(c).alias(f"{c}_f") for c in cell], "_before"), same_cell(cell))
    if mode == ROW_NUMBER:
        found = found.withColumn("_before", F.col("_before") + F.row_number().over(Window.partitionBy(*cell).orderBy(F.lit(1))) - 1)
    return found


def distributed_rank(df: DataFrame, partition: list[Column], order: list[Column], down: bool, mode: int, out: str) -> DataFrame:
    """df with a column out: the rank (mode 1) or row number (mode 4) of each row; rows of one order are numbered in any order.

    Runs the jobs that count and sort; what they give lies in the shared folder.
    """
    names = df.columns
    # Rows that are equal in all columns stay together; any others of one order are dealt out.
    salt = F.pmod(F.xxhash64(*[column(c) for c in names]), F.lit(SALTS)).cast("int")
    found = looked_up(df, partition, order, down) if mode == RANK else sorted_once(df, partition, order, down, salt)
    if found is None:
        found = by_cells(df, partition, order, down, mode, salt)
    return found.select(*[column(c) for c in names if c != out], (F.col("_before") + 1).cast("int").alias(out))


def with_rank(df: DataFrame, partition: list[Column], order: list[Column], down: bool, mode: int, out: str, hot_rows: int | None = None) -> DataFrame:
    """A window function, but where there is no partition, or hot_rows is given and the largest one has more rows, the distributed form."""
    if not partition or hot_rows is not None and largest_partition(df, partition) > hot_rows:
        return distributed_rank(df, partition, order, down, mode, out)
    return df.withColumn(out, plain_rank(partition, order, down, mode))
