"""Mixing sources to target weights by systematic sampling.

Every source gets a share of all words by weight, at most `cap` times what it has; the
excess is reshared by weight. Within a source each document expects target / source size
copies. These expectations are prefix-summed in an order by size, one random offset is
added, and a document is emitted once for each integer boundary that its interval crosses.
As documents of like sizes are neighbours, the words taken come near the target.

Defined cases: a null source is a source of its own and comes last; a null or empty text has
size 0 and takes no words; repeated rows are documents of their own; an empty table gives an
empty table; other columns are carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop_stash, magnitude, numbered, spread, stash, table, word_count

WEIGHTS = (1, 2, 3)
CAP = 3
#: Parts of a (source, size class) cell; with over a hundred size classes, a source's rows are dealt to thousands of cells.
SALTS = 64


def offset_of(name: Column, missing: Column, seed: str) -> Column:
    """A source's random offset in [0, 1), a multiple of 2**-16 so that sums with it stay exact."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.when(missing, F.lit("null")).otherwise(F.concat(F.lit("="), name))))
    return F.conv(F.substring(digest, 1, 4), 16, 10).cast("double") / 65536


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """sources: source, missing, words. Adds target (double).

    Sources are numbered by a distributed sort, so that there may be any number of them, in any number of parts.
    """
    ordered = numbered(sources, ["missing", "source"], "number")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int")).cast("long")
    weighed = stash(ordered.select("source", "missing", "words", weight.alias("weight")), "mix-weights")
    drop_stash(ordered)
    total, all_weights = weighed.agg(F.sum("words"), F.sum("weight")).first()
    total, all_weights = total or 0, all_weights or 1
    rest, left, over = total, all_weights, F.lit(False)
    while True:
        over = F.lit(cap) * F.col("words").cast("decimal(38,0)") * F.lit(left).cast("decimal(20,0)") < F.col("weight").cast("decimal(5,0)") * F.lit(rest).cast("decimal(30,0)")
        got = weighed.agg(F.sum(F.when(over, F.col("words") * cap)).alias("full"), F.sum(F.when(~over, F.col("weight"))).alias("left")).first()
        new_rest, new_left = total - (got["full"] or 0), got["left"] or 0
        if (new_rest, new_left) == (rest, left) or not new_left:
            break
        rest, left = new_rest, new_left
    share = (F.col("weight") * F.lit(rest).cast("long")).cast("double") / F.lit(float(left))
    return weighed.withColumn("target", F.when(over, (F.col("words") * cap).cast("double")).otherwise(share)).drop("weight")


def plan_mix(
    docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id",
    weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = "mix", size: Callable[[Column], Column] = word_count, carry: list[str] | None = None,
) -> DataFrame:
    """doc (a struct of docs' columns, or of those in carry), words, source_words, target and copies, one row per document."""
    sized = docs.select(
        F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in (docs.columns if carry is None else carry)]).alias("doc"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        F.col(source).isNull().alias("missing"),
        size(F.col(text)).alias("words"),
        F.col(doc_id).alias("id"),
    )
    dealt = sized.withColumns({"class": magnitude(F.col("words")), "salt": spread(F.col("id"), SALTS)})
    cell = ["source", "missing", "class", "salt"]
    cells = stash(dealt.groupBy(*cell).agg(F.count(F.lit(1)).alias("n"), F.sum("words").alias("words")), "mix-cells")
    sources = targets(cells.groupBy("source", "missing").agg(F.sum("words").alias("words")), weights, cap)
    before = Window.partitionBy("source", "missing").orderBy("class", "salt").rowsBetween(Window.unboundedPreceding, -1)
    first = cells.select(*cell, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    first = first.join(sources.withColumnRenamed("words", "source_words"), ["source", "missing"])
    inside = F.row_number().over(Window.partitionBy(*cell).orderBy("words", "id"))
    rate = F.when(F.col("source_words") > 0, F.col("target") / F.col("source_words").cast("double")).otherwise(F.lit(0.0))
    upto = lambda k: F.floor(k.cast("double") * F.col("rate") + F.col("offset"))
    return (
        dealt.join(first, cell)
        .withColumns({"k": F.col("before") + inside, "rate": rate, "offset": offset_of(F.col("source"), F.col("missing"), seed)})
        .withColumn("copies", (upto(F.col("k")) - upto(F.col("k") - 1)).cast("int"))
        .select("doc", "words", "source_words", "target", "copies")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document's row as many times as it is taken, with the columns of docs."""
    again = plan_mix(docs, **options).filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return again.select("doc.*")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = plan_mix(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return planned.select(
        "doc.doc_id",
        F.col("words").alias("size"),
        F.col("source_words").alias("source_size"),
        "target",
        (F.col("copies") * F.col("words")).cast("long").alias("taken"),
        "copies",
    )


OP9_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), dealt AS (
  SELECT *, length(bin(size)) * 4 + CASE WHEN length(bin(size)) > 2
      THEN CAST(substr(bin(size), 2, 1) AS BIGINT) * 2 + CAST(substr(bin(size), 3, 1) AS BIGINT) ELSE size END AS class,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 4) AS BIGINT) % 64 AS salt
  FROM sized
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS words FROM sized GROUP BY source
), weighed AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source IS NULL, source COLLATE "C") - 1) % 3 AS weight, sum(words) OVER () AS total FROM sources
), filled AS (
  SELECT *, total - 3 * coalesce(sum(words) OVER before, 0) AS rest, sum(weight) OVER (ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) - coalesce(sum(weight) OVER before, 0) AS left_weight
  FROM weighed
  WINDOW before AS (ORDER BY words * 6 / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), flagged AS (
  SELECT *, 3 * words * left_weight < weight * rest AS over_cap FROM filled
), settled AS (
  SELECT *, sum(CASE WHEN over_cap THEN 3 * words ELSE 0 END) OVER () AS capped, sum(CASE WHEN over_cap THEN 0 ELSE weight END) OVER () AS free_weight FROM flagged
), targets AS (
  SELECT source, words, CASE WHEN over_cap THEN CAST(3 * words AS DOUBLE) ELSE CAST(weight * (total - capped) AS DOUBLE) / CAST(free_weight AS DOUBLE) END AS target,
    CAST(CAST('0x' || substr(md5('mix:' || CASE WHEN source IS NULL THEN 'null' ELSE '=' || source END), 1, 4) AS BIGINT) AS DOUBLE) / 65536 AS u
  FROM settled
), numbered AS (
  SELECT d.*, t.words, t.target, t.u, CASE WHEN t.words > 0 THEN t.target / CAST(t.words AS DOUBLE) ELSE 0.0 END AS rate,
    row_number() OVER (PARTITION BY d.source ORDER BY class, salt, size, doc_id) AS k
  FROM dealt d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), copied AS (
  SELECT *, CAST(floor(CAST(k AS DOUBLE) * rate + u) - floor(CAST(k - 1 AS DOUBLE) * rate + u) AS INTEGER) AS copies FROM numbered
)
SELECT doc_id, CAST(size AS BIGINT) AS size, words AS source_size, target, CAST(copies * size AS BIGINT) AS taken, copies FROM copied
"""
