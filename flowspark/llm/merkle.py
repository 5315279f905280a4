"""Merkle manifest of a dataset: a digest for each row, a root for each group and for all, and a proof for each row.

A row's leaf is the SHA-256 of its fields. The place of a leaf in its group is its exact rank by id, which comes from
histograms of the ids' digits, as in a radix sort: rows are counted by all but the lowest digit, these counts by all but the two lowest, and
so on. A prefix's first rank is the sum of what stands before it under the same parent (at most 2**BITS counts) and its parent's
first rank; only rows that share all but the lowest digit are sorted together. So no group is gathered or sorted as a whole.

The rank's digits, base FANOUT, key the nodes of a trie. Nodes are reduced from the longest prefix: rows that share all but the last LEVELS
digits (729 at most) are hashed up to one node, which stands for them in the next round. A row's proof has the siblings
of its nodes on the way up, told apart into those on its left and on its right. Groups are numbered in order and reduced in the same way.

Defined cases: a null field has a leaf of its own, unlike that of an empty one; a null group comes first; in a group rows with a null id
come first, by leaf; rows of one id stand by leaf, and equal rows have equal leaves; ids are whole numbers; a group of one row has its leaf as root;
an empty table gives an empty table; very long texts are hashed whole; columns that aren't fields don't count, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop_stash, numbered, stash, table

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT, LEVELS, BITS = 3, 6, 10
SIGN = -(1 << 63)


def named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def hashed(*parts: Column) -> Column:
    """SHA-256 of the parts, one after the other, in lower-case hex."""
    return F.sha2(F.concat(*parts), 256)


def leaf_of(*fields: Column) -> Column:
    """The digest of some fields: each `-` if null, else its length in bytes, a colon and the value."""
    told = lambda s: F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return hashed(*[told(f.cast("string")) for f in fields])


def prefix(number: Column, level: int) -> Column:
    """A number without its last digits; numbers count as unsigned. There are at most six levels below the top in 64 bits."""
    return F.shiftrightunsigned(number, BITS * level) if BITS * level < 64 else F.lit(0).cast("long")


def with_places(leaves: DataFrame, group: list[str]) -> DataFrame:
    """leaves: group's columns (not null), id, leaf, ... Adds place (from 0, by id in each group) and total (of the group)."""
    least, most, unknown = leaves.agg(F.min("id"), F.max("id"), F.sum(F.col("id").isNull().cast("long"))).first()
    mask = (1 << 64) - 1
    bits = ((least & mask) ^ (most & mask)).bit_length() if least is not None else 0
    spread = max(BITS, ((unknown or 0) >> BITS).bit_length() + BITS)  # rows without an id are dealt by as many bits of their leaf
    height = -(-max(bits, spread if unknown else 0) // BITS)
    by_leaf = F.shiftright(F.conv(F.substring("leaf", 1, 15), 16, 10).cast("long"), 60 - spread)
    number = F.when(F.col("id").isNull(), by_leaf).otherwise(F.col("id").bitwiseXOR(F.lit(SIGN)))
    dealt = leaves.withColumns({"known": F.col("id").isNotNull().cast("int"), "cell": prefix(number, 1)})
    keys = [*group, "known", "cell"]
    finest = stash(dealt.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "merkle-cells")

    histograms = [finest]
    for _ in range(2, height):
        up = histograms[-1].withColumn("cell", F.shiftrightunsigned("cell", BITS))
        histograms.append(up.groupBy(*keys).agg(F.sum("n").alias("n")))
    # From the top: groups, rows with and without an id, then digit by digit.
    before = lambda by, order: F.coalesce(F.sum("n").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = finest.groupBy(*group, "known").agg(F.sum("n").alias("n"))
    first = first.select(*group, "known", before(group, "known").alias("first"), F.sum("n").over(Window.partitionBy(*group)).alias("total"))
    parents = [*group, "known"]
    for level in reversed(histograms):
        inside = level.withColumn("parent", F.shiftrightunsigned("cell", BITS))
        inside = inside.withColumn("inside", before([*group, "known", "parent"], "cell")).drop("n")
        if parents[-1] == "cell":
            first = first.withColumnRenamed("cell", "parent")
            joined = inside.join(first, [*group, "known", "parent"])
        else:
            joined = inside.join(first, parents)
        first = joined.select(*keys, (F.col("first") + F.col("inside")).alias("first"), "total")
        parents = keys
    at = F.row_number().over(Window.partitionBy(*keys).orderBy("id", "leaf")) - 1
    done = dealt.join(first, keys).withColumn("place", (F.col("first") + at).cast("long")).drop("known", "cell", "first")
    done._cells = finest
    return done


def level_name(k: int) -> str:
    return f"level{k}"


def parent_of(low: str) -> Callable[[Column], Column]:
    """The digest of node i above the nodes in column low."""
    return lambda i: hashed(*[F.coalesce(F.get(low, i * FANOUT + j), F.lit("")) for j in range(FANOUT)])


def chunks(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """nodes: keys, place, total (nodes of these keys), node, row. One row for each keys and place div FANOUT**LEVELS: rows in order, the nodes of each level, top.

    Where the keys have no more nodes than that, it ends at one node; else all levels are made, of single nodes too.
    """
    size = FANOUT**LEVELS
    gathered = nodes.groupBy(*keys, "total", F.expr(f"place div {size}").alias("chunk")).agg(F.collect_list(F.struct("place", "node", "row")).alias("rows"))
    in_order = F.array_sort("rows", lambda a, b: (a["place"] - b["place"]).cast("int"))
    out = gathered.withColumn("rows", in_order).withColumn(level_name(0), F.transform("rows", lambda x: x["node"]))
    top = F.get(level_name(0), F.lit(0))
    for k in range(LEVELS):
        low, high = level_name(k), level_name(k + 1)
        parents = F.transform(F.sequence(F.lit(0), F.expr(f"cast((size({low}) - 1) div {FANOUT} as int)")), parent_of(low))
        out = out.withColumn(high, F.when((F.size(low) > 1) | (F.col("total") > size) & F.col(low).isNotNull(), parents))
        top = F.coalesce(F.get(high, F.lit(0)), top)
    return out.withColumn("top", top)


def siblings(k: int, j: Column) -> Column:
    """Of node j's ancestor at level k: struct(left, right), or null if nothing stands above that level."""
    low, at = level_name(k), F.floor(j / FANOUT**k).cast("int")
    digit = at % FANOUT
    one = lambda i: F.coalesce(F.get(low, at - digit + i), F.lit(""))
    left = F.concat(*[F.when(F.lit(i) < digit, one(i)).otherwise(F.lit("")) for i in range(FANOUT)])
    right = F.concat(*[F.when(F.lit(i) > digit, one(i)).otherwise(F.lit("")) for i in range(FANOUT)])
    return F.when(F.col(level_name(k + 1)).isNotNull(), F.struct(left.alias("left"), right.alias("right")))


def trie(nodes: DataFrame, keys: list[str]) -> list[DataFrame]:
    """Chunks of all rounds, from the nodes to those of the last top, as stashed tables."""
    rounds = []
    while True:
        rounds.append(stash(chunks(nodes, keys), "merkle-chunks"))
        more = rounds[-1].filter(f"total > {FANOUT**LEVELS}")
        if not more.limit(1).count():
            return rounds
        nodes = more.select(*keys, F.col("chunk").alias("place"), F.expr(f"(total + {FANOUT**LEVELS - 1}) div {FANOUT**LEVELS}").alias("total"), F.col("top").alias("node"), F.lit(None).cast("string").alias("row"))


def tops(rounds: list[DataFrame], keys: list[str]) -> DataFrame:
    """keys, top: the one node that all of the keys' nodes come to."""
    ends = [r.filter(f"total <= {FANOUT**LEVELS}").select(*keys, "top") for r in rounds]
    out = ends[0]
    for e in ends[1:]:
        out = out.unionByName(e)
    return out


def with_proofs(rounds: list[DataFrame], keys: list[str], above: DataFrame) -> DataFrame:
    """above: keys, proof, more... of the tops. One row for each node of the first round: keys, place, node, row, proof, more..."""
    carried = [c for c in above.columns if c not in [*keys, "proof"]]
    lower = None
    for r in reversed(rounds):
        met = r.filter(f"total <= {FANOUT**LEVELS}").join(above, keys)
        if lower is not None:
            met = met.unionByName(r.filter(f"total > {FANOUT**LEVELS}").join(lower.select(*keys, F.col("place").alias("chunk"), "proof", *carried), [*keys, "chunk"]))
        proved = F.transform("rows", lambda x, j: F.struct(x["place"].alias("place"), x["node"].alias("node"), x["row"].alias("row"), F.array_compact(F.array(*[siblings(k, j) for k in range(LEVELS)])).alias("own")))
        rows = met.select(*keys, "proof", *carried, F.explode(proved).alias("x"))
        lower = rows.select(*keys, "x.place", "x.node", "x.row", F.concat("x.own", "proof").alias("proof"), *carried)
    return lower


def manifest(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", fields: tuple[str, ...] = FIELDS, carry: dict[str, Column] | None = None) -> DataFrame:
    """One row for each of docs: doc_id, the columns in carry (by default none), place, leaf, subroot, root and proof.

    proof: an array of struct(left, right), which are the digests on both sides of the row's node, level by level; folded() reads it.
    The tables below it stay in the shared folder, as the result is read from them; free(result) deletes them.
    """
    group = ["missing", "group"]
    seen = docs.select(
        named(source).isNull().cast("int").alias("missing"),
        F.coalesce(named(source).cast("string"), F.lit("")).alias("group"),
        named(doc_id).cast("long").alias("id"),
        leaf_of(*map(named, fields)).alias("leaf"),
        F.struct(named(doc_id).alias("doc_id"), *[c.alias(k) for k, c in (carry or {}).items()]).alias("row"),
    )
    leaves = stash(seen, "merkle-leaves")
    placed = with_places(leaves, group)
    rounds = trie(placed.select(*group, "place", "total", F.col("leaf").alias("node"), "row"), group)
    drop_stash(leaves, placed._cells)

    groups = numbered(tops(rounds, group), [F.col("missing").desc(), F.col("group").asc()], "place")
    total = groups.count()
    every = groups.select(F.lit(0).alias("one"), "place", F.lit(total).cast("long").alias("total"), F.col("top").alias("node"), F.struct(*group).alias("row"))
    upper = trie(every, ["one"])
    root = tops(upper, ["one"]).select("one", F.array().cast("array<struct<left:string,right:string>>").alias("proof"), F.col("top").alias("root"))
    of_groups = with_proofs(upper, ["one"], root).select("row.*", "proof", F.col("node").alias("subroot"), "root")
    found = with_proofs(rounds, group, of_groups).select("row.*", "place", F.col("node").alias("leaf"), "subroot", "root", "proof")
    found._stashes = [*rounds, *upper, groups]
    return found


def free(found: DataFrame) -> None:
    """Delete the tables that a manifest is read from."""
    drop_stash(*found._stashes)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof come to."""
    return F.aggregate(proof, leaf, lambda h, s: hashed(s["left"], h, s["right"]))


def proof_digest(proof: Column) -> Column:
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    struck = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = manifest(docs, carry={"now": leaf_of(*[struck if f == "text" else F.col(f) for f in FIELDS])})
    again = found.withColumn("folded_root", folded(F.col("now"), F.col("proof")))
    return again.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


OP13_SQL = r"""
WITH RECURSIVE told AS (
  SELECT doc_id, source, coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
      || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS head,
    text, CAST(doc_id AS VARCHAR) AS digits FROM documents
), struck AS (
  SELECT *, CASE WHEN xor(list_reduce(list_prepend(4294967295, range(8 * CAST(len(digits) AS BIGINT))),
      lambda acc, k: xor(xor(acc, CASE WHEN k % 8 = 0 THEN ascii(digits[k // 8 + 1]) ELSE 0 END) >> 1, 3988292384 * (xor(acc, CASE WHEN k % 8 = 0 THEN ascii(digits[k // 8 + 1]) ELSE 0 END) & 1))), 4294967295) % 2 = 0
    THEN replace(text, chr(10), '') ELSE text END AS other FROM told
), leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf, sha256(head || coalesce(octet_length(encode(other)) || ':' || other, '-')) AS now,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS place, count(*) OVER (PARTITION BY source) AS total FROM struck
), nodes AS (
  SELECT 0 AS level, source, place, total, leaf AS node FROM leaves
  UNION ALL
  SELECT level + 1, source, place // 3, (total + 2) // 3, sha256(string_agg(node, '' ORDER BY place)) FROM nodes WHERE total > 1 GROUP BY level, source, place // 3, total
), subroots AS (
  SELECT source, node, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS total FROM nodes WHERE total = 1
), upper AS (
  SELECT 0 AS level, place, total, node FROM subroots
  UNION ALL
  SELECT level + 1, place // 3, (total + 2) // 3, sha256(string_agg(node, '' ORDER BY place)) FROM upper WHERE total > 1 GROUP BY level, place // 3, total
), steps AS (
  SELECT l.doc_id, n.level, coalesce(string_agg(n.node, '' ORDER BY n.place) FILTER (n.place < l.place // CAST(pow(3, n.level) AS BIGINT)), '') AS before,
    coalesce(string_agg(n.node, '' ORDER BY n.place) FILTER (n.place > l.place // CAST(pow(3, n.level) AS BIGINT)), '') AS after
  FROM leaves l JOIN nodes n ON l.source IS NOT DISTINCT FROM n.source AND n.total > 1 AND n.place // 3 = l.place // CAST(pow(3, n.level + 1) AS BIGINT) GROUP BY l.doc_id, n.level
  UNION ALL
  SELECT l.doc_id, 1000 + n.level, coalesce(string_agg(n.node, '' ORDER BY n.place) FILTER (n.place < s.place // CAST(pow(3, n.level) AS BIGINT)), ''),
    coalesce(string_agg(n.node, '' ORDER BY n.place) FILTER (n.place > s.place // CAST(pow(3, n.level) AS BIGINT)), '')
  FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source JOIN upper n ON n.total > 1 AND n.place // 3 = s.place // CAST(pow(3, n.level + 1) AS BIGINT) GROUP BY l.doc_id, n.level
), proofs AS (
  SELECT doc_id, string_agg(before || after, '' ORDER BY level) AS siblings, list(before || '|' || after ORDER BY level) AS path FROM steps GROUP BY doc_id
), done AS (
  SELECT l.doc_id, leaf, s.node AS subroot, (SELECT node FROM upper WHERE total = 1) AS root, sha256(coalesce(siblings, '')) AS proof_sha256,
    list_reduce(list_prepend(now, coalesce(path, [])), lambda acc, x: sha256(split_part(x, '|', 1) || acc || split_part(x, '|', 2))) AS folded_root
  FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source LEFT JOIN proofs p ON l.doc_id = p.doc_id
)
SELECT *, folded_root = root AS verified FROM done
"""
