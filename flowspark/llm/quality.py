"""Quality rules with thresholds that adapt to each language and source.

Each document is measured by whole-number metrics. Each metric's distribution in a
(language, source) group is kept as a quantile sketch: counts over buckets whose width is at most
a thirty-second of their values (small values are exact). Two sketches merge by adding
counts, so partial sketches are made before the shuffle, and groups with too few documents
use the merged sketch of their language or, failing that, of the corpus. The thresholds are
outer fences, `fence` times the interquartile range beyond the quartiles and never
closer than a metric's slack; they replace fixed cutoffs. Documents are then joined with
their group's thresholds and filtered.

Everything is a Spark expression. Defined cases: a null text has no words and fails the base
rule; null languages and sources are groups of their own; repeated rows count repeatedly and get equal
verdicts; an empty table gives an empty table; other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACES, WORD, stash, table

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: metric: (slack that the lower fence leaves below the first quartile, or None without a lower fence; the same above the third quartile)
METRICS = {
    "word_length": (120, 150),  # hundredths of a code point per word
    "symbols": (None, 50),  # per thousand words
    "shouting": (None, 25),  # upper-case letters per thousand code points of words
    "exclaiming": (None, 100),  # ! and ? per thousand words
    "dup_lines": (None, 400),  # per thousand lines with a word
    "repeat_words": (None, 300),  # per thousand words
}
FENCE = 6
#: Groups with fewer documents use a merged sketch.
MIN_GROUP = 50
#: Buckets for each power of two; DIGITS are the binary digits that tell them.
SUB, DIGITS = 32, 6


def bound(value: Column, body) -> Column:
    """body(value), with value worked out once however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows that the text holds at least twice.

    Hashes tell whether any window may repeat; only then are the windows themselves compared.
    """

    def starts(n: Column) -> Column:
        return F.when(n >= window, F.sequence(F.lit(1), n - window + 1)).otherwise(F.array().cast("array<int>"))

    def counted(w: Column) -> Column:
        keyed = F.transform(starts(F.size(w)), lambda i: F.struct(F.array_join(F.slice(w, i, window), " ").alias("w"), i.alias("i")))
        return bound(F.array_sort(keyed), of_sorted)

    def of_sorted(s: Column) -> Column:
        n = F.size(s)
        pairs = F.zip_with(
            F.slice(s, 1, n - 1), F.slice(s, 2, n - 1), lambda a, b: F.when(a["w"] == b["w"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>"))
        )
        return bound(F.array_sort(F.array_distinct(F.flatten(pairs))), covered)

    def covered(at: Column) -> Column:
        n = F.size(at)
        steps = F.zip_with(F.slice(at, 1, n - 1), F.slice(at, 2, n - 1), lambda a, b: F.least(b - a, F.lit(window)))
        return F.when(n == 0, F.lit(0)).otherwise(F.aggregate(steps, F.lit(window), lambda x, y: x + y))

    def may(w: Column) -> Column:
        hashes = F.transform(starts(F.size(w)), lambda i: F.xxhash64(F.slice(w, i, window)))
        distinct = bound(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
        return F.when(distinct, counted(w)).otherwise(F.lit(0))

    return bound(words, may).cast("long")


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and the metrics."""
    body = F.coalesce(F.col(text), F.lit(""))
    length = lambda drop: F.length(body) - F.length(F.translate(body, drop, ""))
    words = F.array_remove(F.split(F.translate(body, SPACES[1:], " " * 5), " "), "")
    counted = docs.withColumns({
        "n_words": F.coalesce(F.regexp_count(body, F.lit(WORD)), F.lit(0)).cast("long"),
        "word_chars": F.length(F.translate(body, SPACES, "")).cast("long"),
        "n_symbols": length("#*$%&|<>").cast("long"),
        "_lines": bound(
            F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD)),
            lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")),
        ),
        "n_repeat_words": repeat_words(words),
        "_upper": length("ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("long"),
        "_marks": length("!?").cast("long"),
    })
    over = lambda a, b, k: F.when(F.col(b) > 0, F.expr(f"({a} * {k}) div {b}")).otherwise(F.lit(0)).cast("long")
    return (
        counted.withColumns({"n_dup_lines": F.col("_lines.dup"), "_n_lines": F.col("_lines.n")})
        .withColumns({
            "base_failed": (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT),
            "word_length": over("word_chars", "n_words", 100),
            "symbols": over("n_symbols", "n_words", 1000),
            "shouting": over("_upper", "word_chars", 1000),
            "exclaiming": over("_marks", "n_words", 1000),
            "dup_lines": over("n_dup_lines", "_n_lines", 1000),
            "repeat_words": over("n_repeat_words", "n_words", 1000),
        })
        .drop("_lines", "_upper", "_marks", "_n_lines")
    )


def bucket_floor(value: Column) -> Column:
    """The smallest value of value's bucket: exact below 2 * SUB, then the first DIGITS binary digits."""
    digits = F.bin(value)
    floor = F.conv(F.rpad(F.substring(digits, 1, DIGITS), F.length(digits), F.lit("0")), 2, 10).cast("long")
    return F.when(value < 2 * SUB, value).otherwise(floor)


def sketches(docs: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """One row for each bucket of each group's metrics: lang, source, metric, at, n."""
    values = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), bucket_floor(F.col(m)).alias("at")) for m in METRICS]))
    return (
        docs.select(F.col(lang).alias("lang"), F.col(source).alias("source"), values.alias("v"))
        .groupBy("lang", "source", F.col("v.metric").alias("metric"), F.col("v.at").alias("at"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merged(sketch: DataFrame, by: list[str]) -> DataFrame:
    return sketch.groupBy(*by, "metric", "at").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, by: list[str], fence: int = FENCE) -> DataFrame:
    """Of each group in by: its document count n_docs, and low and high for each metric."""
    group = Window.partitionBy(*by, "metric")
    ranked = sketch.withColumns({"upto": F.sum("n").over(group.orderBy("at")), "all": F.sum("n").over(group)})
    first = lambda share: F.min(F.when(F.col("upto") * 4 >= F.col("all") * share, F.col("at")))
    quartiles = ranked.groupBy(*by, "metric").agg(first(1).alias("q1"), first(3).alias("q3"), F.max("all").alias("all"))
    spread = F.lit(fence) * (F.col("q3") - F.col("q1"))
    low, high = F.lit(None).cast("long"), F.lit(None).cast("long")
    for m, (below, above) in METRICS.items():
        mine = F.col("metric") == m
        low = F.when(mine & F.lit(below is not None), F.col("q1") - F.greatest(spread, F.lit(below or 0))).otherwise(low)
        high = F.when(mine, F.col("q3") + F.greatest(spread, F.lit(above))).otherwise(high)
    return (
        quartiles.withColumns({"low": low, "high": high})
        .groupBy(*by)
        .agg(F.max("all").alias("n_docs"), *[F.max(F.when(F.col("metric") == m, F.struct("low", "high"))).alias(f"{m}_fence") for m in METRICS])
    )


def thresholds(sketch: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """The fences that hold for each (lang, source), from its own sketch or a merged one."""
    cols = [f"{m}_fence" for m in METRICS]
    own, lang, corpus = (fences(merged(sketch, by) if by != ["lang", "source"] else sketch, by) for by in (["lang", "source"], ["lang"], []))
    lang = lang.select(F.col("lang").alias("_lang"), F.col("n_docs").alias("_lang_docs"), *[F.col(c).alias(f"_lang_{c}") for c in cols])
    corpus = corpus.select(F.lit(1).alias("_one"), *[F.col(c).alias(f"_all_{c}") for c in cols])
    return (
        own.join(lang, F.col("lang").eqNullSafe(F.col("_lang")), "left")
        .withColumn("_one", F.lit(1))
        .join(corpus, "_one", "left")
        .select(
            "lang", "source", "n_docs",
            *[F.when(F.col("n_docs") >= min_group, F.col(c)).when(F.col("_lang_docs") >= min_group, F.col(f"_lang_{c}")).otherwise(F.col(f"_all_{c}")).alias(c) for c in cols],
        )
    )


def judged(docs: DataFrame, limits: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """docs (measured) with kept; the join is Spark's to choose, as the limits' size is known only at run time."""
    named = limits.withColumnsRenamed({"lang": "_lang", "source": "_source", "n_docs": "_n_docs"})
    inside = F.lit(True)
    for m in METRICS:
        fence = F.col(f"{m}_fence")
        inside = inside & F.coalesce(F.col(m) >= fence["low"], F.lit(True)) & F.coalesce(F.col(m) <= fence["high"], F.lit(True))
    joined = docs.join(named, F.col(lang).eqNullSafe(F.col("_lang")) & F.col(source).eqNullSafe(F.col("_source")), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & inside).drop("_lang", "_source", "_n_docs", *[f"{m}_fence" for m in METRICS])


def quality_filter(docs: DataFrame) -> DataFrame:
    """The documents that pass, with the columns of docs, whatever their names."""
    scored = measured(docs.select(F.struct("*").alias("_row"), "text", "lang", "source"))
    limits = stash(thresholds(sketches(scored)), "quality-limits")
    return judged(scored, limits).filter("kept").select("_row.*")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = stash(measured(docs).select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", *METRICS), "quality-metrics")
    return judged(scored, thresholds(sketches(scored))).drop("lang", "source")


_FLOOR = f"CASE WHEN {{v}} < {2 * SUB} THEN {{v}} ELSE ({{v}} >> (length(bin({{v}})) - {DIGITS})) << (length(bin({{v}})) - {DIGITS}) END"
_QUARTILES = """
  SELECT {by} metric, min(CASE WHEN upto * 4 >= total THEN low END) AS q1, min(CASE WHEN upto * 4 >= total * 3 THEN low END) AS q3, max(total) AS n_docs FROM (
    SELECT *, sum(n) OVER (PARTITION BY {by} metric ORDER BY low) AS upto, sum(n) OVER (PARTITION BY {by} metric) AS total
    FROM (SELECT {by} metric, low, count(*) AS n FROM sketched GROUP BY {by} metric, low)) GROUP BY {by} metric"""
OP8_SQL = r"""
WITH words AS (
  SELECT *, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS win FROM (SELECT doc_id, w, unnest(range(1, CAST(len(w) AS BIGINT) - 6)) AS i FROM words)
), repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n FROM (SELECT *, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM repeated) GROUP BY doc_id
), counted AS (
  SELECT w.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(l) AS BIGINT) AS n_lines,
    CAST(length(body) - length(regexp_replace(body, '[A-Z]', '', 'g')) AS BIGINT) AS upper, CAST(length(body) - length(regexp_replace(body, '[!?]', '', 'g')) AS BIGINT) AS marks
  FROM words w LEFT JOIN covered c ON w.doc_id = c.doc_id
), scored AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    coalesce(word_chars * 100 // nullif(n_words, 0), 0) AS word_length, coalesce(n_symbols * 1000 // nullif(n_words, 0), 0) AS symbols,
    coalesce(upper * 1000 // nullif(word_chars, 0), 0) AS shouting, coalesce(marks * 1000 // nullif(n_words, 0), 0) AS exclaiming,
    coalesce(n_dup_lines * 1000 // nullif(n_lines, 0), 0) AS dup_lines, coalesce(n_repeat_words * 1000 // nullif(n_words, 0), 0) AS repeat_words
  FROM counted
), sketched AS (
""" + " UNION ALL ".join(f"SELECT lang, source, '{m}' AS metric, {_FLOOR.format(v=m)} AS low FROM scored" for m in METRICS) + """
), own AS (""" + _QUARTILES.format(by="lang, source,") + """
), of_lang AS (""" + _QUARTILES.format(by="lang,") + """
), of_all AS (""" + _QUARTILES.format(by="") + """
), picked AS (
  SELECT o.lang, o.source, o.metric,
    CASE WHEN o.n_docs >= 50 THEN o.q1 WHEN l.n_docs >= 50 THEN l.q1 ELSE a.q1 END AS q1, CASE WHEN o.n_docs >= 50 THEN o.q3 WHEN l.n_docs >= 50 THEN l.q3 ELSE a.q3 END AS q3
  FROM own o JOIN of_lang l ON o.lang IS NOT DISTINCT FROM l.lang AND o.metric = l.metric JOIN of_all a ON o.metric = a.metric
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, word_length, symbols, shouting, exclaiming, dup_lines, repeat_words,
  NOT base_failed""" + "".join(
    f"""
  AND (SELECT {m} <= max(q3 + greatest({FENCE} * (q3 - q1), {above})){f" AND {m} >= max(q1 - greatest({FENCE} * (q3 - q1), {below}))" if below is not None else ""} FROM picked p WHERE p.metric = '{m}' AND p.lang IS NOT DISTINCT FROM s.lang AND p.source IS NOT DISTINCT FROM s.source)"""
    for m, (below, above) in METRICS.items()
) + """ AS kept
FROM scored s
"""  # fmt: skip
