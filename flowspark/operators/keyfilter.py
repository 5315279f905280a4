"""Reading from a large table only the rows whose keys a small one may have, before anything is shuffled.

Two filters, both of a size that is known beforehand: the least and greatest value of each key, which the scan can hold against its files' statistics, and a
Bloom filter in blocks of 32768 bits. A key sets HASHES bits in one block; blocks are made by bitmap aggregation and broadcast. A filter lets
some other keys through, so that an exact join has to follow; it never holds back a key that is there.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..types import column

BLOCK, WORD_BITS, HASHES = 32_768, 32, 4
#: Bits for each key, at best and at worst, and how many blocks (of 8 KB as arrays) are broadcast at most.
MOST_BITS, LEAST_BITS, MAX_BLOCKS = 16, 4, 8_192
#: Types whose values are equal exactly if their hashes are made of equal bytes, and that literals hold exactly.
HASHED = {"byte", "short", "integer", "long", "string", "date", "timestamp", "timestamp_ntz", "decimal", "boolean", "binary"}
RANGED = {"byte", "short", "integer", "long", "string", "date", "decimal"}


def blocks_for(n: int) -> int:
    """Blocks for n keys, or 0 if so many keys can't be told apart within the bound."""
    if n * LEAST_BITS > MAX_BLOCKS * BLOCK:
        return 0
    return max(1, min(MAX_BLOCKS, math.ceil(n * MOST_BITS / BLOCK)))


def typed(df: DataFrame, keys: list[str], kinds: set[str]) -> list[str]:
    return [k for k in keys if df.schema[k].dataType.typeName().split("(")[0] in kinds]


def within_ranges(keys: DataFrame, names: list[str]) -> Column:
    """A condition that all rows of keys meet: each value between the least and the greatest. One job; its result is one row."""
    names = typed(keys, names, RANGED)
    if not names:
        return F.lit(True)
    row = keys.agg(*[f(column(k)).alias(f"{what}{i}") for i, k in enumerate(names) for what, f in (("least", F.min), ("most", F.max))]).first()
    out = F.lit(True)
    for i, k in enumerate(names):
        if row[f"least{i}"] is not None:
            kind = keys.schema[k].dataType
            out = out & column(k).between(F.lit(row[f"least{i}"]).cast(kind), F.lit(row[f"most{i}"]).cast(kind))
    return out


def places(names: list[str], blocks: int) -> tuple[Column, list[Column]]:
    """A key's block and its bits there, by two hashes."""
    h = F.xxhash64(*map(column, names))
    bits = [F.shiftrightunsigned(h, 15 * i).bitwiseAND(F.lit(BLOCK - 1)) for i in range(HASHES)]
    return F.pmod(F.hash(*map(column, names)), F.lit(blocks)).cast("int"), bits


def bloom_blocks(keys: DataFrame, names: list[str], blocks: int) -> DataFrame:
    """_block, _words: the bits of each block that has any, as 32-bit numbers."""
    block, bits = places(names, blocks)
    set_bits = keys.select(block.alias("_block"), F.explode(F.array(*bits)).alias("_bit"))
    made = set_bits.groupBy("_block").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    number = lambda i: F.conv(F.hex(F.substring(F.col("_bits"), i * 4 + 1, F.lit(4))), 16, 10).cast("bigint")
    return made.select("_block", F.transform(F.sequence(F.lit(0), F.lit(BLOCK // WORD_BITS - 1)), number).alias("_words"))


def is_set(words: Column, bit: Column) -> Column:
    """Bit b lies in byte b div 8; numbers have their first byte highest."""
    byte = F.shiftrightunsigned(bit, 3)
    word = F.get(words, F.shiftrightunsigned(byte, 2).cast("int"))
    return F.bit_get(word, ((F.lit(3) - byte % 4) * 8 + bit % 8).cast("int")) == 1


def may_be_among(rows: DataFrame, keys: DataFrame, names: list[str], blocks: int) -> DataFrame:
    """The rows whose keys may be among keys, by a Bloom filter of so many blocks; nothing of rows is shuffled."""
    block, bits = places(names, blocks)
    probed = rows.withColumn("_block", block).join(F.broadcast(bloom_blocks(keys, names, blocks)), "_block")
    met = F.lit(True)
    for bit in bits:
        met = met & is_set(F.col("_words"), bit)
    return probed.filter(met).select(*map(column, rows.columns))


def pruned(existing: DataFrame, keys: DataFrame, names: list[str], n: int) -> DataFrame:
    """The key columns of those rows of existing whose keys may be among the n rows of keys; nothing of existing is shuffled."""
    rows = existing.filter(within_ranges(keys, names)).select(*map(column, names))
    blocks = blocks_for(n)
    if not blocks or len(typed(keys, names, HASHED)) < len(names):
        return rows
    return may_be_among(rows, keys, names, blocks)
