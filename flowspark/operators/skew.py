"""Equi joins with keys that hold a large share of the rows.

A frequency sketch, made where rows are read, finds such keys on the left side. Their rows are dealt to parts by a hash of all their columns, so that a
task that is run again deals them alike, and the right side's rows of these keys are copied to each part. All other rows keep to one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..types import column

#: Items that the sketch tells apart for each key that it may report, so that counts are off by little of the least share.
TRACKED = 20
#: Parts for what an even partition would hold, as the hashes of a few parts may meet in one task.
FINER = 4


def hash_of(keys: list[Column]) -> Column:
    return F.xxhash64(*keys)


def heavy_keys(df: DataFrame, keys: list[Column], share: float) -> tuple[dict[int, int], int]:
    """Hashes of keys that hold at least this share of df's rows (at most 1 / share of them), with about their rows; and all rows. Null keys don't count: they match nothing."""
    most = math.ceil(1 / share)
    no_null = F.lit(True)
    for k in keys:
        no_null = no_null & k.isNotNull()
    sketch = F.expr(f"approx_top_k(h, {most}, {most * TRACKED})")
    row = df.select(F.when(no_null, hash_of(keys)).alias("h")).agg(F.count(F.lit(1)).alias("n"), sketch.alias("top")).first()
    found = {x["item"]: x["count"] for x in row["top"] or [] if x["item"] is not None and x["count"] >= share * row["n"]}
    return found, row["n"]


def parts_of(heavy: dict[int, int], total: int, partitions: int) -> dict[int, int]:
    """Parts for each heavy key, so that a part holds a fraction of what a partition would."""
    return {h: max(2, math.ceil(FINER * n / max(total, 1) * partitions)) for h, n in heavy.items()}


def looked_up(parts: dict[int, int], h: Column) -> Column:
    """A heavy key's parts, by its hash; null for other keys."""
    pairs = [x for k, n in sorted(parts.items()) for x in (F.lit(k).cast("bigint"), F.lit(n))]
    return F.element_at(F.create_map(*pairs), h)


def dealt(left: DataFrame, right: DataFrame, left_keys: list[Column], right_keys: list[Column], parts: dict[int, int], salt: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with a column salt, on which they have to be equal besides their keys."""
    own = looked_up(parts, hash_of(left_keys))
    salted = F.coalesce(F.pmod(F.xxhash64(*[column(c) for c in left.columns], F.lit("flow")), own).cast("int"), F.lit(0))
    copies = F.sequence(F.lit(0), F.coalesce(looked_up(parts, hash_of(right_keys)), F.lit(1)) - 1)
    return left.withColumn(salt, salted), right.withColumn(salt, F.explode(copies))
