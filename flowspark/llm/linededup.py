"""Near-duplicate lines by an exact set-similarity join, with Spark expressions only.

A line is the set of its words (in lower case). Words are counted over the corpus; a line's words are ordered by
rarity, and lines whose Jaccard similarity reaches the threshold must share a word of their prefixes. Pairs that do are held to
the length and positional filters and to a bound from parity bitmaps (the ones of the XOR never exceed
the symmetric difference), and are verified on the full sets. A line that matches an earlier one (by
doc_id, then a hash of the text, then line number) is removed.

Lines with equal sets are one class, of which the earliest line is compared. Sets so small that only an equal one can reach the
threshold (up to three words at 80 percent) are classes too, but have no prefix words.
Common prefix words come from families of near-copies; there each line is first compared with the `PIVOTS` earliest lines of its
length that share the word, and only pairs with a line that found no earlier match go on to the join of all lines. So families don't
make all their pairs, and no line loses its match. There a pair is met by its shorter line: as the longer one has as many words, or more, the
shorter one's share of a common word lies among fewer of its rarest words than its own prefix has (a ninth of them instead of a fifth, at 80
percent). Words with some uses are joined within classes of like length, rare ones alone.

Rarity is kept as a quarter-power-of-two class for each hash of words, in a table that grows with the number of documents up to
2**`MOST_BITS` bytes, and is small enough for a processor's cache; any fixed order gives the same matches, a good one fewer candidates.

Defined cases: a null text has no lines and stays null; lines without words are kept; a document that
loses all its words is dropped by `drop_repeated_lines`; a null doc_id counts as the least id; ids that aren't whole numbers are sorted as strings; rows with equal ids and different texts are
documents of their own; rows with equal ids and texts are one document given twice, and get equal results; an empty table gives an
empty table; other columns are carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, drop_stash, id_of, magnitude, stash, table
from .quality import bound

PERCENT = 80
#: The rarity table has 2**LEAST_BITS hashes at least and 2**MOST_BITS at most, and else 4 to 8 for each document.
LEAST_BITS, MOST_BITS = 12, 24
CHUNK_BITS = 10
#: Words that are used once in so many documents, or more often, are common; none with fewer uses than LEAST_COMMON is.
DOCS_PER_USE, LEAST_COMMON = 400, 128
#: Words with so many uses are joined within classes of like length.
SOME_USES = 128
#: A code has the kind of its word (few uses, some, common), its rarity among these, and bits of its hash.
CODE_BITS, RARITIES = 24, 32
SOME, COMMON = (kind * RARITIES << CODE_BITS for kind in (1, 2))
#: The rarity class of hashes that are not used.
UNUSED = 4
PIVOTS = 8
#: Documents of which single lines are asked for are found by a broadcast list where it has at most so many, and one for so many different lines.
MOST_ASKED, LINES_PER_ASKED = 1 << 19, 128
#: Where a line stands; earlier lines are less.
PLACE = ["doc", "mark", "line_no"]
#: What equal sets share: their size, a 64-bit hash and 64 parities.
SET = ["k1", "n", "bits"]  # the hash first, by which rows are sorted at once


def words_of(line: Column) -> Column:
    """The words of a line in lower case; spaces, tabs and the like part them, and some may be empty."""
    return F.split(plain(line), " ")


def plain(text: Column) -> Column:
    lowered = out = F.lower(text)
    some = F.lit(False)
    for other in "\t\x0b\x0c\r":  # much faster than translate(); most texts have none, which contains() tells much faster than replace()
        some = some | F.contains(text, F.lit(other))
        out = F.replace(out, F.lit(other), F.lit(" "))
    return F.when(some, out).otherwise(lowered)


def token_set(words: Column) -> Column:
    """Distinct words as 64-bit hashes."""
    return F.array_remove(F.array_distinct(F.transform(words, lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))


def rarity(docs: DataFrame, text: str) -> tuple[DataFrame, int, int]:
    """The classes of all hashes, in chunks; the number of hashes, and the class from which on words are common.

    Common is what is used often for the number of documents, so that their share of the rows is the same at every size.
    """
    n_docs = docs.count()
    bits = min(max((8 * max(n_docs, 1)).bit_length() - 1, LEAST_BITS), MOST_BITS)
    lines = docs.select(F.explode(F.split(plain(F.col(text)), "\n")).alias("line"))
    words = lines.select(F.explode(F.split("line", " ")).alias("w"))
    used = words.select(F.xxhash64("w").bitwiseAND((1 << bits) - 1).cast("int").alias("h"), F.lit(1).cast("long").alias("n"))
    # Of each chunk at least the first hash is there; filled() adds the others that no word has.
    n_chunks = 1 << (bits - CHUNK_BITS)
    unused = docs.sparkSession.range(n_chunks).select(F.shiftleft("id", CHUNK_BITS).cast("int").alias("h"), F.lit(0).cast("long").alias("n"))
    counts = used.unionAll(unused).groupBy("h").agg(F.sum("n").alias("n"))
    # Hash and class in one number, as numbers are sorted faster than structs.
    coded = F.shiftleft("h", 7).bitwiseOR(F.coalesce(F.least(magnitude(F.col("n")), F.lit(127)), F.lit(0)))
    chunks = counts.groupBy(F.shiftright("h", CHUNK_BITS).alias("c")).agg(filled(F.sort_array(F.collect_list(coded))).alias("ks"))
    return stash(chunks, "rarity"), bits, min(class_of(max(n_docs // DOCS_PER_USE, LEAST_COMMON)), 127)


def class_of(uses: int) -> int:
    """magnitude() of a number of four or more."""
    return 4 * uses.bit_length() + (uses >> (uses.bit_length() - 3) & 3)


def filled(coded: Column) -> Column:
    """The classes of a chunk's hashes in order, from the sorted numbers of those in use, of which the first hash is one."""
    at = lambda x: F.shiftright(x, 7).bitwiseAND((1 << CHUNK_BITS) - 1)
    others = lambda n: F.array_repeat(F.lit(UNUSED).cast("tinyint"), n)

    def spaced(x: Column, following: Column) -> Column:
        gap = F.when(following.isNull(), 1 << CHUNK_BITS).otherwise(at(following)) - at(x) - 1
        return F.concat(F.array(x.bitwiseAND(127).cast("tinyint")), others(gap))

    return bound(coded, lambda xs: F.flatten(F.transform(xs, lambda x, i: spaced(x, F.get(xs, i + 1)))))


def lines_of(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    # The place is made before lines are: beside them it would be hashed from the whole text for each line.
    bodies = docs.select(*place_of(docs, text, doc_id), plain(F.col(text)).alias("body"))
    return bodies.select("doc", "mark", F.posexplode(F.split("body", "\n")).alias("line_no", "line"))


def place_of(docs: DataFrame, text: str, doc_id: str) -> list[Column]:
    """doc and mark, which tell documents apart."""
    return [id_of(docs, doc_id).alias("doc"), F.xxhash64(text).alias("mark")]


def prefixes(docs: DataFrame, text: str, doc_id: str, percent: int) -> DataFrame:
    """One row for each line with words: its place, n, k1 and bits (its words' parities), which are the set's key, and the codes of its prefix words, rarest first."""
    chunks, n_bits, common = rarity(docs, text)
    kinds = chunks.select("c", F.transform("ks", lambda k: kind_of(k, common)).alias("ks"))
    classes = kinds.select(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("c", "ks"))), lambda x: x["ks"])).alias("ks")).scalar()

    def ranked(h: Column) -> Column:
        # Class first (as the highest bits), then the hash; never null, so that numbers are sorted as such.
        k = F.coalesce(F.get("classes", h.bitwiseAND((1 << n_bits) - 1)), F.lit(0).cast("tinyint")).cast("bigint")
        return F.shiftleft(k, 56).bitwiseOR(F.shiftrightunsigned(h, 8))

    lines = lines_of(docs, text, doc_id).filter(F.trim("line") != "").withColumn("classes", classes)
    hashes = F.array_remove(F.transform(F.split("line", " "), lambda w: F.xxhash64(w)), F.xxhash64(F.lit("")))
    # In steps and neither in lambdas nor below them, as distinct values, sorting and hashing are compiled there.
    # `classes` is used once: a column with two uses would be copied, all of it, for each line.
    sets = lines.select(*PLACE, F.array_distinct(F.transform(hashes, ranked)).alias("t"))
    n = F.size("t")
    least = F.floor((n * percent + 99) / 100).cast("int")  # ceil(n * percent / 100)
    # Even the set with one word more is too far from the smallest sets.
    prefix = F.slice("t", 1, F.when(n * 100 >= (n + 1) * percent, n - least + 1).otherwise(0))
    flip = lambda h: F.call_function("shiftleft", F.lit(1).cast("bigint"), h.bitwiseAND(63).cast("int"))
    bits = F.aggregate("t", F.lit(0).cast("bigint"), lambda a, h: a.bitwiseXOR(flip(h)))
    keyed = sets.withColumn("t", F.sort_array("t")).select(*PLACE, n.alias("n"), F.xxhash64("t").alias("k1"), bits.alias("bits"), prefix.alias("p"))
    codes = F.transform("p", lambda x: F.shiftright(x, 56 - CODE_BITS).cast("int"))
    done = stash(keyed.select(*PLACE, *SET, codes.alias("codes")), "prefixes")
    drop_stash(chunks)
    return done


def kind_of(k: Column, common: int) -> Column:
    """The kind and rarity of the words of a class, in one small number that grows with the class."""
    some = class_of(SOME_USES)
    among = lambda kind, least: F.lit(kind * RARITIES) + F.least(k - least, F.lit(RARITIES - 1))
    return F.when(k >= common, among(2, common)).when(k >= some, among(1, some)).otherwise(among(0, UNUSED)).cast("tinyint")


def length_class(n: Column, percent: int) -> Column:
    """Lines at the threshold are in the same or neighbouring classes."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(100 / percent)) + 1e-9).cast("int")


def of_shorter(reps: DataFrame, percent: int) -> DataFrame:
    """reps with those codes only by which a line meets its matches that have as many words, or more."""
    # With m >= n words there, 100 * shared >= percent * (n + m - shared) asks for 2 * percent * n / (100 + percent) shared words at least.
    most = F.col("n") - F.floor((F.col("n") * 2 * percent + 99 + percent) / (100 + percent)).cast("int") + 1
    return reps.withColumn("codes", F.slice("codes", 1, most))


def prefix_rows(reps: DataFrame, percent: int, open_: Column, *carry: str, least: int = 0, guests: bool = True) -> DataFrame:
    """One row for each prefix word with a code of `least` or more: key, id, bits and what (n, at, guest and open in one number, as rows are many).

    The key is the word's code and, for words with some uses, the class of the line's length, with a second row, as a guest (if asked for), for the class above.
    """
    rows = reps.select("id", "n", "bits", open_.alias("open"), *carry, F.posexplode("codes").alias("at", "code")).filter(F.col("code") >= least)
    by_length = F.col("code") >= SOME
    one = F.array(F.lit(0))
    rows = rows.withColumn("guest", F.explode(F.when(by_length, F.array(F.lit(0), F.lit(1))).otherwise(one)) if guests else F.lit(0))
    group = F.when(by_length, length_class(F.col("n"), percent) + F.col("guest") + 1).otherwise(0).cast("bigint")
    what = F.shiftleft(F.col("n").cast("bigint"), 32) + F.col("at") * 4 + F.col("guest") * 2 + F.col("open")
    return rows.select(F.shiftleft(group, 32).bitwiseOR(F.col("code").cast("bigint")).alias("key"), "id", "bits", what.alias("what"), *carry)


def n_of(side: str) -> Column:
    """The number of words of a prefix row's line."""
    return F.shiftright(f"{side}.what", 32)


def partners(x: DataFrame, y: DataFrame, percent: int, also: Column) -> DataFrame:
    """id and to_id of prefix rows of x and y that share a word, of which one is open, and that pass all filters."""
    at = lambda r: F.shiftright(F.col(f"{r}.what").bitwiseAND(0xFFFFFFFF), 2)
    a, b = n_of("x"), n_of("y")
    # Matches share percent * (a + b) / (100 + percent) words at least; multiplied out, as divisions are slow.
    reach = F.least(a - at("x"), b - at("y")) * (100 + percent) >= (a + b) * percent
    differ = F.bit_count(F.col("x.bits").bitwiseXOR(F.col("y.bits")))
    close = (F.least(a, b) * 100 >= F.greatest(a, b) * percent) & reach & (differ * (100 + percent) <= (a + b) * (100 - percent))
    flags = (F.col("x.what").bitwiseAND(F.col("y.what")).bitwiseAND(2) == 0) & (F.col("x.what").bitwiseOR(F.col("y.what")).bitwiseAND(1) == 1)
    return x.alias("x").join(y.alias("y"), (F.col("x.key") == F.col("y.key")) & also & flags & close).select(F.col("x.id").alias("id"), F.col("y.id").alias("to_id")).distinct()


def verified(pairs: DataFrame, reps: DataFrame, docs: DataFrame, text: str, doc_id: str, percent: int) -> DataFrame:
    """id and match (a place): of each line with an earlier match among pairs, the earliest of them."""
    ids = pairs.select("id").union(pairs.select("to_id")).distinct()
    asked = reps.select("id", *PLACE).join(ids, "id", "left_semi").groupBy("doc", "mark").agg(F.collect_list(F.struct("line_no", "id")).alias("wanted"))
    asked = stash(asked, "asked")
    few = asked.count() <= min(reps.count() // LINES_PER_ASKED, MOST_ASKED)
    body = docs.select(*place_of(docs, text, doc_id), F.col(text).alias("text"))
    taken = lambda ls: F.transform("wanted", lambda w: F.struct(w["id"].alias("id"), w["line_no"].alias("line_no"), token_set(words_of(F.get(ls, w["line_no"]))).alias("t")))
    found = body.join(F.broadcast(asked) if few else asked, ["doc", "mark"]).dropDuplicates(["doc", "mark"])  # a document may be given twice
    found = found.select("doc", "mark", F.explode(bound(F.split("text", "\n"), taken)).alias("x"))
    sets = stash(found.select("x.id", F.struct("doc", "mark", "x.line_no").alias("place"), "x.t"), "line-sets")
    one = sets.select("id", F.struct("place", "id").alias("p"), "t")
    other = sets.select(F.col("id").alias("to_id"), F.struct("place", "id").alias("q"), F.col("t").alias("u"))
    # 100 * shared >= percent * (t + u - shared), so written that the sets are intersected once.
    good = pairs.join(one, "id").join(other, "to_id").filter(F.size(F.array_intersect("t", "u")) * (100 + percent) >= (F.size("t") + F.size("u")) * percent)
    directed = good.select(F.greatest("p", "q").alias("later"), F.least("p", "q")["place"].alias("earlier"))
    done = stash(directed.groupBy("later.id").agg(F.min("earlier").alias("match")), "matches")
    drop_stash(asked, sets)
    return done


def matched_classes(reps: DataFrame, docs: DataFrame, text: str, doc_id: str, percent: int) -> DataFrame:
    """id and match of the classes (one row of reps each) whose first line matches an earlier line."""
    common = prefix_rows(reps, percent, F.lit(1), "doc", least=COMMON)
    order = Window.partitionBy("key").orderBy("doc", "id")
    pivots = stash(common.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= PIVOTS).drop("k"), "pivots")
    near = stash(partners(common, pivots, percent, (F.col("x.id") != F.col("y.id")) & (F.col("x.doc") >= F.col("y.doc"))), "pairs")
    drop_stash(pivots)
    early = verified(near, reps, docs, text, doc_id, percent)
    drop_stash(near)

    decided = early.select("id", F.lit(0).alias("decided"))
    told, open_ = reps.join(decided, "id", "left"), F.coalesce("decided", F.lit(1))
    shorter, longer = prefix_rows(of_shorter(told, percent), percent, open_), prefix_rows(told, percent, open_, guests=False)
    rest = stash(partners(shorter, longer, percent, (n_of("x") < n_of("y")) | (n_of("x") == n_of("y")) & (F.col("x.id") < F.col("y.id"))), "pairs")
    late = verified(rest, reps, docs, text, doc_id, percent)
    drop_stash(rest)
    done = stash(early.unionByName(late).groupBy("id").agg(F.min("match").alias("match")), "matches")
    drop_stash(early, late)
    return done


def matches(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """doc, mark, line_no, match (a place): a row for each line that matches an earlier one."""
    every = prefixes(docs, text, doc_id, percent)
    # The least place brings the other columns along; equal sets have equal ones.
    firsts = every.groupBy(*SET).agg(F.min(F.struct(*PLACE, "codes")).alias("first"), F.count(F.lit(1)).alias("uses"))
    reps = stash(firsts.select(F.monotonically_increasing_id().alias("id"), *SET, "uses", "first.*"), "reps")
    found = matched_classes(reps, docs, text, doc_id, percent)

    # A line's own class may have an earlier line, and the class's first line may match an earlier class.
    place = F.struct(*PLACE)
    classes = reps.join(found, "id", "left").filter("uses > 1 OR match IS NOT NULL").select(*SET, place.alias("first"), "match")
    lines = every.select(*PLACE, *SET).join(classes, SET)
    done = lines.select(*PLACE, F.coalesce("match", F.when(place != F.col("first"), F.col("first"))).alias("match")).filter("match IS NOT NULL")
    done = stash(done, "line-matches")
    drop_stash(every, reps, found)
    return done


def with_removed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """docs with _removed array<struct<line_no, to_doc, to_line>>, the lines to remove and the lines that they match."""
    found = matches(docs, text, doc_id, percent)
    told = F.struct("line_no", F.col("match.doc").alias("to_doc"), F.col("match.line_no").alias("to_line"))
    lists = found.groupBy("doc", "mark").agg(F.sort_array(F.collect_set(told)).alias("_removed")).withColumnsRenamed({"doc": "_doc", "mark": "_mark"})
    doc, mark = place_of(docs, text, doc_id)
    return docs.join(lists, (F.col("_doc") == doc) & (F.col("_mark") == mark), "left").drop("_doc", "_mark")


def kept_text(text: Column, removed: Column) -> Column:
    """The text without the removed lines."""
    gone = bound(F.transform(removed, lambda x: x["line_no"]), lambda g: F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains(g, i)))
    return F.when(removed.isNull(), text).otherwise(F.array_join(gone, "\n"))


def drop_repeated_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """docs with their texts without removed lines; documents that lose all their words are dropped."""
    rows = docs.select(F.struct("*").alias("_row"), F.col(text).alias("text"), F.col(doc_id).alias("doc_id"))
    done = with_removed(rows, percent=percent).withColumn("_text", kept_text(F.col("text"), F.col("_removed")))
    empty = F.col("_removed").isNotNull() & ~F.col("_text").rlike(WORD)
    return done.filter(~empty).select(F.col("_row").withField(f"`{text}`", F.col("_text")).alias("_row")).select("_row.*")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = with_removed(docs)
    return done.select(
        "doc_id",
        F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.transform("_removed", lambda x: x["line_no"].cast("long")).alias("removed_lines"),
        kept_text(F.col("text"), F.col("_removed")).alias("text"),
    )


OP1_SQL = r"""
WITH lines AS (
  SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, list_distinct(list_filter(string_split(regexp_replace(lower(l[i]), '[\x09\x0B-\x0D]', ' ', 'g'), ' '), lambda x: x <> '')) AS s
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l, unnest(range(1, CAST(len(string_split(text, chr(10))) AS BIGINT) + 1)) AS i FROM documents WHERE text IS NOT NULL)
), numbered AS (
  SELECT *, len(s) AS n, row_number() OVER (ORDER BY doc_id, line_no) AS id FROM lines WHERE len(s) > 0
), classes AS (
  SELECT list_sort(s) AS k, min(id) AS id FROM numbered GROUP BY k
), firsts AS (
  SELECT n.id, n.n, n.s FROM classes c JOIN numbered n ON n.id = c.id
), items AS (
  SELECT id, n, unnest(s) AS x FROM firsts
), ordered AS (
  SELECT id, n, x, row_number() OVER (PARTITION BY id ORDER BY uses, x) AS place FROM (SELECT *, count(*) OVER (PARTITION BY x) AS uses FROM items)
), prefix AS (
  SELECT id, n, x, place FROM ordered WHERE place <= n - (n * 80 + 99) // 100 + 1
), pairs AS (
  SELECT DISTINCT a.id AS a, b.id AS b FROM prefix a JOIN prefix b ON a.x = b.x AND a.id < b.id AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80
    AND least(a.n - a.place, b.n - b.place) + 1 >= (80 * (a.n + b.n) + 179) // 180
), matched AS (
  SELECT DISTINCT b AS id FROM pairs JOIN firsts x ON x.id = a JOIN firsts y ON y.id = b
  WHERE 100 * len(list_intersect(x.s, y.s)) >= 80 * (x.n + y.n - len(list_intersect(x.s, y.s)))
), gone AS (
  SELECT doc_id, list(CAST(line_no AS BIGINT) ORDER BY line_no) AS removed_lines FROM numbered n LEFT JOIN firsts f ON n.id = f.id
  WHERE f.id IS NULL OR n.id IN (SELECT id FROM matched) GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(len(string_split(text, chr(10))), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(removed_lines), 0) AS BIGINT) AS n_removed, removed_lines,
  CASE WHEN removed_lines IS NULL THEN text ELSE array_to_string(list_transform(list_filter(range(0, CAST(len(string_split(text, chr(10))) AS BIGINT)), lambda i: NOT list_contains(removed_lines, i)), lambda i: string_split(text, chr(10))[i + 1]), chr(10)) END AS text
FROM documents d LEFT JOIN gone g ON d.doc_id = g.doc_id
"""
