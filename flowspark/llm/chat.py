"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns of one role are
merged by array aggregation into one block; blocks are concatenated:

    system     [SYS]text[/SYS]
    user       [INST]text[/INST]
    assistant  <s>text</s>
    others     [ROLE]role[/ROLE]text[END]

Merged turns stay apart by [TURN]. Control strings inside texts are escaped: one `~` is put after the
first character, and one more if some are there already, so that no control string is left and that
unescaping gives the text back exactly. The loss mask is a list of spans (code points) that cover
each assistant text and nothing else.

Defined cases: a null text is an empty text and a null role an empty role; equal turn numbers are
ordered by role, then text; repeated rows are turns of their own; a null conv_id is a
conversation of its own; an empty table gives an empty table; other columns are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .quality import bound

OPEN = {"system": "[SYS]", "user": "[INST]", "assistant": "<s>"}
CLOSE = {"system": "[/SYS]", "user": "[/INST]", "assistant": "</s>"}
OTHER = ("[ROLE]", "[/ROLE]", "[END]")
NEXT = "[TURN]"
#: What follows the first character (< or [) of a control string.
_REST = r"(?:/?s>|(?:/?SYS|/?INST|/?ROLE|END|TURN)\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[]~*)(?={_REST})", "$1~")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[]~*)~(?={_REST})", "$1")


def _by_role(role: Column, marks: dict[str, str], other: Column) -> Column:
    out = other
    for name, mark in marks.items():
        out = F.when(role == name, F.lit(mark)).otherwise(out)
    return out


def _blocks(turns: Column) -> Column:
    """Sorted turns to blocks: runs of one role, with the escaped texts of their turns."""
    n = F.size(turns)
    role = lambda i: F.element_at(turns, i)["role"]
    first = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: (i == 1) | (role(i) != role(F.greatest(i - 1, F.lit(1)))))

    def runs(at: Column) -> Column:
        ends = F.concat(F.slice(at, 2, F.greatest(F.size(at) - 1, F.lit(0))), F.array(n + 1))
        return F.zip_with(
            at, ends, lambda a, b: F.struct(role(a).alias("role"), F.transform(F.slice(turns, a, b - a), lambda t: escape(t["text"])).alias("texts"))
        )

    return bound(first, runs)


def _text(block: Column) -> Column:
    other = F.concat(F.lit(OTHER[0]), escape(block["role"]), F.lit(OTHER[1]))
    return F.concat(_by_role(block["role"], OPEN, other), F.array_join(block["texts"], NEXT), _by_role(block["role"], CLOSE, F.lit(OTHER[2])))


def _spans(blocks: Column) -> Column:
    """The loss spans: a fold over blocks keeps the place and adds a run of spans for each assistant block."""
    span = "struct<start: bigint, length: bigint>"

    def texts(place: Column, block: Column) -> Column:
        begin = F.struct(place.alias("at"), F.array().cast(f"array<{span}>").alias("spans"))

        def step(acc: Column, t: Column) -> Column:
            size = F.length(t).cast("long")
            return F.struct(
                (acc["at"] + size + len(NEXT)).alias("at"), F.concat(acc["spans"], F.array(F.struct(acc["at"].alias("start"), size.alias("length")))).alias("spans")
            )

        return F.aggregate(block["texts"], begin, step, lambda acc: acc["spans"])

    def step(acc: Column, block: Column) -> Column:
        mine = F.when(block["role"] == "assistant", texts(acc["at"] + len(OPEN["assistant"]), block)).otherwise(F.array().cast(f"array<{span}>"))
        return F.struct((acc["at"] + F.length(_text(block))).alias("at"), F.concat(acc["spans"], mine).alias("spans"))

    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{span}>").alias("spans"))
    return F.aggregate(blocks, begin, step, lambda acc: acc["spans"])


def format_chats(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, formatted string, loss_spans array<struct<start, length>>: one row per conversation."""
    told = F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    chats = rows.groupBy(F.col(conv_id).alias("conv_id")).agg(F.collect_list(told).alias("turns"))
    done = bound(bound(F.sort_array("turns"), _blocks), lambda b: F.struct(F.array_join(F.transform(b, _text), "").alias("formatted"), _spans(b).alias("loss_spans")))
    return chats.select("conv_id", done.alias("done")).select("conv_id", "done.formatted", "done.loss_spans")


def read_back(formatted: Column) -> Column:
    """The turns in a formatted text: array<struct<role, text>>."""
    blocks = F.filter(F.split(formatted, r"(?<=</s>|\[/SYS\]|\[/INST\]|\[END\])"), lambda b: b != "")

    def parsed(b: Column) -> Column:
        out_role = unescape(F.regexp_extract(b, r"(?s)^\[ROLE\](.*?)\[/ROLE\]", 1))
        body = F.regexp_extract(b, r"(?s)^\[ROLE\].*?\[/ROLE\](.*)\[END\]$", 1)
        for name in OPEN:
            mine = b.startswith(OPEN[name])
            out_role = F.when(mine, F.lit(name)).otherwise(out_role)
            body = F.when(mine, F.substring(b, F.lit(len(OPEN[name]) + 1), F.length(b) - len(OPEN[name]) - len(CLOSE[name]))).otherwise(body)
        return bound(F.struct(out_role.alias("role"), body.alias("body")), lambda x: F.transform(
            F.split(x["body"], r"\[TURN\]"), lambda t: F.struct(x["role"].alias("role"), unescape(t).alias("text"))
        ))

    return F.flatten(F.transform(blocks, parsed))


def under_mask(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped, with nothing between the spans."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


TEST_TURNS = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    mine = spark.sql("SELECT * FROM VALUES " + ", ".join(f"({c}L, {t}L, '{r}', '{x}')" for c, t, r, x in TEST_TURNS) + " AS t(conv_id, turn, role, text)")
    chats = format_chats(rows.unionByName(mine))
    back = F.struct(read_back(F.col("formatted")).alias("turns"), under_mask(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    return chats.select("conv_id", bound(back, lambda b: F.struct(
        F.size(b["turns"]).cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform(b["turns"], lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length(b["loss"]).cast("long").alias("loss_chars"),
        F.sha2(b["loss"], 256).alias("loss_sha256"),
    )).alias("x"), F.length("formatted").cast("long").alias("formatted_chars")).select("conv_id", "x.*", "formatted_chars")


OP2_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), placed AS (
  SELECT *, row_number() OVER w AS k, lag(role) OVER w IS NOT DISTINCT FROM role AS joined,
    length(regexp_replace(text, '([<\[]~*)(/?s>|(/?SYS|/?INST|/?ROLE|END|TURN)\])', '\1~\2', 'g')) AS chars
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars + CASE WHEN joined THEN 6 WHEN role = 'system' THEN 11 WHEN role = 'user' THEN 13 WHEN role = 'assistant' THEN 7 ELSE 18 + length(role) END) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""
