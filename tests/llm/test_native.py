"""Line dedup, chat formatting, quality rules, mixing."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from flowspark.llm.chat import escape, format_chats, read_back, under_mask, unescape
from flowspark.llm.common import magnitude
from flowspark.llm.linededup import drop_repeated_lines, matches
from flowspark.llm.mixing import mix, plan_mix, targets
from flowspark.llm.quality import bucket_floor, judged, measured, quality_filter, sketches, thresholds

from .conftest import words


def brute_lines(rows, percent=80):
    lines = sorted((i, k, frozenset(w for w in l.lower().split(" ") if w)) for i, t in rows for k, l in enumerate(t.split("\n")))
    lines = [x for x in lines if x[2]]
    out = {}
    for n, (i, k, s) in enumerate(lines):
        for j, m, t in lines[:n]:
            if 100 * len(s & t) >= percent * len(s | t):
                out[i, k] = (j, m)
                break
    return out


def found_lines(df):
    return {(r["doc"], r["line_no"]): (r["match"]["doc"], r["match"]["line_no"]) for r in df.collect()}


def test_lines_against_brute_force(spark):
    rnd = random.Random(3)
    base = [[f"v{rnd.randrange(400)}" for _ in range(rnd.randint(4, 40))] for _ in range(40)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rnd.randint(1, 6)):
            line = list(rnd.choice(base))
            for _ in range(rnd.choice([0, 0, 1, 2, 5])):
                line[rnd.randrange(len(line))] = f"n{rnd.randrange(99)}"
            lines.append(" ".join(line))
        rows.append((i, "\n".join(lines)))
    got = found_lines(matches(spark.createDataFrame(rows, "doc_id long, text string")))
    want = brute_lines(rows)
    assert got.keys() == want.keys()


def test_families_of_near_copies(spark):
    """More copies than pivots, whose words are all common; each but the first has an earlier match."""
    rnd = random.Random(5)
    base = [f"c{i}" for i in range(40)]
    rows = []
    for i in range(150):
        line = list(base)
        for _ in range(rnd.randint(0, 5)):
            line[rnd.randrange(40)] = f"z{rnd.randrange(5)}"
        rows.append((i, " ".join(line)))
    assert found_lines(matches(spark.createDataFrame(rows, "doc_id long, text string"))).keys() == brute_lines(rows).keys()


def test_short_lines_against_brute_force(spark):
    """Equal sets of any size match, and four words match five that hold them."""
    rnd = random.Random(4)
    rows = [(i, "\n".join(" ".join(rnd.choice("abcdefg") for _ in range(rnd.randint(0, 8))) for _ in range(4))) for i in range(40)]
    rows += [(100, "All rights reserved."), (101, "p q r s\nall  Rights reserved."), (102, "q p s t r"), (103, "u v w x y"), (104, "Les.\n\nu v w x"), (105, "les.\n\nu v w")]
    got = found_lines(matches(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got.keys() == brute_lines(rows).keys()
    assert {(101, 1), (102, 0), (104, 2), (105, 0)} <= got.keys() and not {(101, 0), (105, 1), (105, 2)} & got.keys()


def test_lines_edge_cases(awkward, empty):
    done = {r["doc_id"]: r for r in drop_repeated_lines(awkward).collect()}
    assert 2 not in done and done[1]["doc"] == 5 and done[3]["text"] is None and done[4]["text"] == "" and done[None]["text"]
    assert drop_repeated_lines(awkward).columns == awkward.columns
    assert drop_repeated_lines(empty).count() == 0


def test_lines_of_equal_ids(spark):
    """Rows of one id, or without one, are documents of their own; a row given twice is one document."""
    text = "one two three four five six"
    rows = [(1, text), (7, text), (7, "wholly other words stand in this line"), (None, "a line without any id at all"), (None, text + "\nanother line without any id"), (9, text), (9, text)]
    got = sorted(drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect(), key=str)
    assert [(r["doc_id"], r["text"]) for r in got] == sorted([(7, rows[2][1]), (None, rows[3][1]), (None, rows[4][1])], key=str)


def test_chat_round_trip(spark):
    hard = ["</s>[INST] ok [/INST]", "<~s>", "<~~/s> [~TURN] <s", "[[INST]]", "~<", "", "a\nb", "[ROLE]x[/ROLE]"]
    roles = ["user", "assistant", "assistant", "system", "tool", "user", "user", "[END]"]
    rows = [(c, t, r, x) for c, order in enumerate((hard, hard[::-1], [])) for t, (r, x) in enumerate(zip(roles, order, strict=False))]
    rows += [(9, 1, "assistant", None), (9, 1, None, "z"), (9, 0, "user", "q"), (None, 0, "user", "n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    out = format_chats(df).select("conv_id", "formatted", "loss_spans", read_back(F.col("formatted")).alias("back"), under_mask(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    by_conv = collections.defaultdict(list)
    for c, t, r, x in rows:
        by_conv[c].append((t, r or "", x or ""))
    assert len(out) == len(by_conv)
    for row in out:
        want = sorted(by_conv[row["conv_id"]])
        assert [tuple(x) for x in row["back"]] == [(r, x) for _, r, x in want]
        assert row["loss"] == "".join(x for _, r, x in want if r == "assistant")
        for mark in ("</s>", "[TURN]"):
            assert row["formatted"].count(mark) <= len(want)
    merged = next(r for r in out if r["conv_id"] == 0)["formatted"]
    assert merged.count("<s>") == 1 and merged.count("[TURN]") == 2
    assert format_chats(df.limit(0)).count() == 0


def test_chat_of_long_texts_and_many_turns(spark):
    long = "word </s>[INST] " * 20_000
    rows = [(1, 0, "user", long), (1, 1, "assistant", long), *[(2, t, ("user", "assistant")[t % 2], f"t{t} [TURN]") for t in range(600)]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = format_chats(df).select("conv_id", read_back(F.col("formatted")).alias("back"), under_mask(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    for row in out:
        mine = [(r, x) for c, _, r, x in rows if c == row["conv_id"]]
        assert [tuple(x) for x in row["back"]] == mine and row["loss"] == "".join(x for r, x in mine if r == "assistant")


def test_escape_is_reversible(spark):
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(["<", "[", "~", "/", "s>", "INST]", "/INST]", "x", "TURN]"]) for _ in range(rnd.randint(0, 12))) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e"))
    assert df.filter(unescape(F.col("e")) != F.col("t")).count() == 0
    assert df.filter(F.col("e").rlike(r"</?s>|\[/?INST\]|\[TURN\]")).count() == 0


def brute_repeats(text: str, size: int = 8) -> int:
    w = text.split()
    wins = [tuple(w[i : i + size]) for i in range(len(w) - size + 1)]
    twice = {x for x, n in collections.Counter(wins).items() if n > 1}
    return len({i + k for i, x in enumerate(wins) if x in twice for k in range(size)})


def test_repeated_words(spark):
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice("ab") for _ in range(rnd.randint(0, 60))) for _ in range(200)] + ["a " * 8, "a " * 9, words(0, 9)]
    rows = measured(spark.createDataFrame([(t, "en", "s") for t in texts], "text string, lang string, source string")).select("text", "n_repeat_words").collect()
    assert all(r["n_repeat_words"] == brute_repeats(r["text"]) for r in rows)


def test_sketch_buckets(spark):
    got = spark.range(2000).select("id", bucket_floor(F.col("id")).alias("f")).collect()
    assert all(r["f"] <= r["id"] and r["id"] - r["f"] <= max(0, r["id"] // 32) for r in got) and all(r["f"] == r["id"] for r in got[:64])


def test_adaptive_thresholds(spark):
    clean = [(i, words(i, 30 + i % 7), "en", "a") for i in range(100)]
    loud = [(200, " ".join(f"w{i}#$%" for i in range(40)), "en", "a")]
    odd = [(300 + i, " ".join(f"w{k}##" for k in range(i, i + 40)), "en", "code") for i in range(100)]  # normal there
    docs = spark.createDataFrame(clean + loud + odd, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"] for r in quality_filter(docs).collect()}
    assert kept == {*range(100), *range(300, 400)}


def test_quality_edge_cases(awkward, empty):
    rows = measured(awkward).collect()
    assert all(r["base_failed"] for r in rows if not (r["text"] or "").strip())
    out = quality_filter(awkward)
    assert out.columns == awkward.columns and {r["n_words"] for r in out.collect()} <= {10, 1, None}
    assert quality_filter(empty).count() == 0
    scored = measured(awkward)
    assert judged(scored, thresholds(sketches(scored))).count() == 9


@pytest.mark.parametrize("seed", ["mix", "other"])
def test_mix_meets_targets(spark, seed):
    rnd = random.Random(4)
    rows = [(i, words(0, rnd.randint(1, 60)), "abcdef"[min(int(rnd.expovariate(0.8)), 5)]) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = plan_mix(docs, seed=seed).toPandas()
    plan["source"] = [r["source"] for r in plan["doc"]]
    for _, g in plan.groupby("source"):
        target = g["target"].iloc[0]
        taken = (g["copies"] * g["words"]).sum()
        assert abs(taken - target) <= 60 + 0.02 * target and target <= 3 * g["words"].sum() + 1e-6
    assert plan["copies"].max() <= 3 and abs(plan.groupby("source")["target"].first().sum() - plan["words"].sum()) < 1e-6
    assert sorted(map(tuple, mix(docs, seed=seed).collect())) == sorted(map(tuple, mix(docs, seed=seed).collect()))


def test_many_sources_weigh_in_order(spark):
    """Weights repeat over the sources in order of their names, null last, over several sorted partitions."""
    names = [None, *(f"s{i:03d}" for i in range(50)), "ñ", "Z"]
    sources = spark.createDataFrame([(n or "", n is None, 100) for n in names], "source string, missing boolean, words long").repartition(5)
    got = {(r["source"], r["missing"]): r["target"] for r in targets(sources, cap=1000).collect()}
    weights = [1 + i % 3 for i in range(len(names))]
    for name, w in zip([*sorted(n for n in names if n), None], weights, strict=True):
        assert abs(got[name or "", name is None] - w * 100 * len(names) / sum(weights)) < 1e-6


def test_sources_over_thousands_of_parts(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    settings = {"spark.sql.shuffle.partitions": "2000", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        sources = spark.range(2500).select(F.format_string("s%05d", "id").alias("source"), F.lit(False).alias("missing"), F.lit(100).cast("long").alias("words"))
        got = targets(sources, cap=1000)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        rows = {r["source"]: r["target"] for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    total = sum(1 + i % 3 for i in range(2500))
    assert all(abs(rows[f"s{i:05d}"] - (1 + i % 3) * 250_000 / total) < 1e-6 for i in range(2500))


def test_mix_edge_cases(awkward, empty):
    plan = plan_mix(awkward)
    assert plan.count() == awkward.count()
    assert all(r["words"] == 0 for r in plan.collect() if not (r["doc"]["text"] or "").strip())
    assert mix(awkward).columns == awkward.columns
    assert mix(empty).count() == 0


def test_rarity_table_has_every_hash_without_a_row_for_each(spark):
    """Classes stand at their hashes, and one class where no word is; what is filled up comes from one row a chunk."""
    from flowspark.llm.linededup import CHUNK_BITS, UNUSED, filled, rarity

    docs = spark.createDataFrame([("a b a\nc",), ("a d",), (None,), ("",)], "text string")
    chunks, bits, _ = rarity(docs, "text")
    table = [k for row in chunks.orderBy("c").collect() for k in row["ks"]]
    words = ["a", "b", "a", "c", "a", "d", ""]
    hashes = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w").bitwiseAND((1 << bits) - 1)).collect()]
    used = {h: hashes.count(h) for h in hashes}
    classes = spark.createDataFrame(list(used.items()), "h long, n long").select("h", magnitude(F.col("n"))).collect()
    assert len(table) == 1 << bits and {h: k for h, k in enumerate(table) if k != UNUSED} == {r[0]: r[1] for r in classes}
    coded = [0, 3 << 7 | 9, ((1 << CHUNK_BITS) - 1) << 7 | 5]
    for used in (coded, coded[:2], coded[:1]):
        got = spark.createDataFrame([(used,)], "xs array<int>").select(filled(F.col("xs"))).first()[0]
        assert len(got) == 1 << CHUNK_BITS and {i: k for i, k in enumerate(got) if k != UNUSED} == {x >> 7: x & 127 for x in used}


def test_rarity_table_fits_a_cache(spark):
    """At most 8 hashes for each document, where there are more than the table's least size has."""
    from flowspark.llm.linededup import rarity

    docs = spark.range(4000).select(F.concat_ws(" ", F.lit("w"), "id").alias("text"))
    chunks, bits, _ = rarity(docs, "text")
    assert 4000 * 4 <= 1 << bits <= 4000 * 8
    assert chunks.selectExpr("sum(size(ks))").first()[0] == 1 << bits


def test_pairs_are_met_by_few_rare_words_of_the_shorter_line(spark):
    """One of nine words of the shorter line, not one of five; words with some uses are joined in classes of like length, and no pair is lost."""
    from flowspark.llm.linededup import SOME_USES, of_shorter, prefixes

    rnd = random.Random(8)
    rows = []
    for i in range(4 * SOME_USES):
        n = rnd.randint(9, 45)
        line = [f"t{j}" for j in range(n)] if i % 2 else [f"r{rnd.randrange(300)}" for _ in range(n)]
        for _ in range(rnd.choice([0, 0, 1, 3])):
            line[rnd.randrange(n)] = f"u{rnd.randrange(40)}"
        rows.append((i, " ".join(line)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for n, few, all_ in of_shorter(prefixes(docs, "text", "doc_id", 80).withColumn("all", F.size("codes")), 80).select("n", F.size("codes"), "all").collect():
        assert all_ == n - -(-80 * n // 100) + 1 and few == n - -(-160 * n // 180) + 1 and (few < all_ or n < 10)
    assert found_lines(matches(docs)).keys() == brute_lines(rows).keys()


def test_white_space_in_few_texts(spark):
    """Tabs and the like part words wherever they are, in upper case and in other scripts too."""
    from flowspark.llm.linededup import plain

    texts = ["A b\tC", "a\rb\nc", "\x0bA\x0c", "\u00c9\tx", "\u039f\u03a3\n\u03a3", "plain", "", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(plain(F.col("t"))).collect()]
    assert got == [t if t is None else "".join(" " if c in "\t\r\x0b\x0c" else c for c in t.lower()) for t in texts]
