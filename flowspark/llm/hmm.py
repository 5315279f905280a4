"""Language-model scores by a hidden Markov model over word classes.

A text is its lower-cased words and one end token. Tokens are counted over all training texts. The
`HEAD` most frequent tokens are classes of their own; every other token belongs to one of `TAIL` classes by its last letters,
within which it has its smoothed share of counts (unseen tokens included). Latent states emit classes, so the model's table has a
fixed size whatever the vocabulary, and a text's likelihood is the product of the class sequence's
likelihood, exact by the scaled forward recursion, and its rare tokens' shares, which come from a join with
the whole count table.

Baum-Welch starts from random transitions and from the corpus' emissions with random factors. Each of `ROUNDS` rounds runs
forward-backward over all training texts, in `BLOCKS` blocks; after each block the model is re-estimated from the block's counts and a
fading sum of those before (stepwise expectation maximization), so that a round moves the model as often as there are blocks. A
last round re-estimates it from the counts of all texts together. The counts are summed by Spark. States smooth their emissions towards the corpus.

Probabilities sum to one over each token: a state's class probabilities do, and so do the shares within a class with one place for unseen tokens.

Defined cases: a null or empty text is the end token alone; a null doc_id is trained on; repeated rows count
repeatedly; without training texts all tokens are unseen; an empty table gives an empty table; very long texts are trained on and
scored whole; other columns are not used.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import coded_words, groups, magnitude, stash, table

HEAD, TAIL, STATES = 60_000, 256, 8
#: Rounds over all training texts, and the blocks of a round after each of which the model is re-estimated.
ROUNDS, BLOCKS = 3, 16
#: A block's counts weigh a share of the number of blocks so far to the power of -FORGET.
FORGET = 0.5
SMOOTH = 50.0
SEED = 20_240_211
#: Tokens whose recursions are held together.
TOKENS = 1_000_000
END = b""
FOLDS, HELD_OUT = 7, 2

#: start (K), move (K x K) and emit (classes x K), a plain tuple so that workers need no class of ours.
Model = tuple[np.ndarray, np.ndarray, np.ndarray]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def tail_class(token: bytes) -> int:
    return zlib.crc32(token[-3:]) % TAIL


# --- counts and encoding ------------------------------------------------------------------------


def token_counts(texts: DataFrame) -> DataFrame:
    """token binary, c long. texts: text (binary). Words are counted in groups of texts, in tasks, and then over all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in groups(whole, 0):
                words, codes, ends = coded_words(batch.column(0), lower=True)
                counts = np.append(np.bincount(codes, minlength=len(words)), len(ends))
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([words, pa.array([END], pa.binary())]), pa.array(counts, pa.int64())], names=["token", "c"])

    return texts.mapInArrow(run, "token binary, c bigint").groupBy("token").agg(F.sum("c").alias("c")).filter("c > 0")


def commonest(counts: DataFrame, n: int) -> pa.Table:
    """The n most frequent tokens, ties by token. Only tokens in the classes of counts that hold them are sorted."""
    classed = counts.withColumn("class", magnitude(F.col("c")))
    held, least = 0, 0
    for r in classed.groupBy("class").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("class")).collect():  # four classes for each power of two
        held, least = held + r["n"], r["class"]
        if held >= n:
            break
    return classed.filter(F.col("class") >= least).orderBy(F.desc("c"), "token").limit(n).select("token", "c").toArrow()


def encoded(docs: DataFrame, head: list[bytes]) -> DataFrame:
    """key, doc_id, train, ids (16-bit class numbers), tail array<struct<token, n>>, block: one row per document, in a folder for each block."""
    told = docs.sparkSession.sparkContext.broadcast(head)  # at most HEAD tokens
    names = ["doc_id", "train", "ids", "tail"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(told.value, pa.binary())
        for whole in batches:
            for batch in groups(whole, 2):
                words, codes, ends = coded_words(batch.column(2), lower=True)
                words = pa.concat_arrays([words, pa.array([END], pa.binary())])
                n, end = batch.num_rows, len(words) - 1
                sizes = np.diff(ends, prepend=0) + 1
                ends = np.cumsum(sizes)
                flat = np.full(int(ends[-1]) if n else 0, end, dtype=np.int64)
                inner = np.ones(len(flat), dtype=bool)
                inner[ends - 1] = False
                flat[inner] = codes
                classes = pc.index_in(words, value_set=known).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                rare = np.flatnonzero(classes < 0)
                tail_classes = classes.copy()
                tail_classes[rare] = [HEAD + tail_class(w) for w in words.take(pa.array(rare)).to_pylist()]
                ids = tail_classes[flat].astype("<u2")
                body = pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.append(0, ends * 2).astype(np.int32)), pa.py_buffer(ids)])
                # A text's rare tokens with their numbers.
                mine = np.flatnonzero(classes[flat] < 0)
                pairs, many = np.unique(np.searchsorted(ends, mine, side="right") * len(words) + flat[mine], return_counts=True)
                items = pa.StructArray.from_arrays([words.take(pa.array(pairs % len(words))), pa.array(many, pa.int32())], names=["token", "n"])
                tails = pa.ListArray.from_arrays(pa.array(np.searchsorted(pairs, np.arange(n + 1) * len(words)), pa.int32()), items)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), body, tails], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    done = docs.select("doc_id", (~held_out(F.col("doc_id"))).alias("train"), F.coalesce("text", F.lit("")).cast("binary").alias("text")).mapInArrow(
        run, f"doc_id {kind}, train boolean, ids binary, tail array<struct<token: binary, n: int>>"
    )
    keyed = done.withColumn("key", F.monotonically_increasing_id())
    return stash(keyed.withColumn("block", (F.col("key") % BLOCKS).cast("int")), "encoded", by="block")


# --- the recursions -------------------------------------------------------------------------------


def batches_by_length(texts: list[np.ndarray], tokens: int = TOKENS) -> Iterator[list[int]]:
    """Numbers of texts of like length, longest first, with about so many tokens together."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    group, held = [], 0
    for i in order:
        if group and held + len(texts[i]) > tokens:
            yield group
            group, held = [], 0
        group.append(i)
        held += len(texts[i])
    if group:
        yield group


def side_by_side(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of some texts (longest first) by their places: all first tokens, then all second ones, and so on; and where each place begins."""
    sizes = np.array([len(t) for t in texts])
    alive = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")
    begins = np.concatenate([[0], np.cumsum(alive)])
    out = np.empty(begins[-1], dtype=np.int64)
    place = np.arange(len(out)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[begins[place] + np.repeat(np.arange(len(texts)), sizes)] = np.concatenate(texts)
    return out, begins


def forward(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """Natural logarithms of the texts' probabilities; texts of like length advance together. Longest first."""
    start, move, emit = model
    flat, begins = side_by_side(texts)
    total = np.zeros(len(texts))
    state = start
    for t, (a, b) in enumerate(itertools.pairwise(begins.tolist())):
        now = (state[: b - a] @ move if t else state) * emit[flat[a:b]]
        scale = now.sum(axis=1)
        total[: b - a] += np.log(scale)
        state = now / scale[:, None]
    return total


def expected(model: Model, texts: list[np.ndarray], sums: dict) -> None:
    """Add the expected counts of start, move and emit, and the log likelihood, to sums. Longest first."""
    start, move, emit = (x.astype(np.float32) for x in model)  # the scaled recursions stay near one
    flat, begins = side_by_side(texts)
    here = emit[flat]
    ahead, scales = np.empty_like(here), np.empty(len(flat), dtype=np.float32)
    spans = list(itertools.pairwise(begins.tolist()))
    state = start
    for t, (a, b) in enumerate(spans):
        now = (state[: b - a] @ move if t else state) * here[a:b]
        scale = now.sum(axis=1)
        state = np.divide(now, scale[:, None], out=ahead[a:b])
        scales[a:b] = scale
    here /= scales[:, None]
    moved, later = np.zeros(move.shape), np.ones((0, len(start)), dtype=np.float32)
    back = np.ascontiguousarray(move.T)
    for (a, _), (c, d) in zip(spans[-2::-1], spans[:0:-1], strict=True):
        step = here[c:d]  # of the texts that go on
        step[: len(later)] *= later
        before = ahead[a : a + d - c]
        moved += before.T @ step
        later = step @ back
        before *= later
    sums["move"] += moved * model[1]
    sums["start"] += ahead[: begins[1]].sum(axis=0, dtype=np.float64)
    for j in range(len(start)):
        sums["emit"][:, j] += np.bincount(flat, weights=ahead[:, j], minlength=len(emit))
    sums["log"] += np.log(scales, dtype=np.float64).sum()


def empty_sums(classes: int, k: int) -> dict:
    return {"start": np.zeros(k), "move": np.zeros((k, k)), "emit": np.zeros((classes, k)), "log": 0.0}


def estimated(sums: dict, corpus: np.ndarray) -> Model:
    """The model of these counts; corpus: the classes' probabilities over all states."""
    start, move = sums["start"] + 1.0, sums["move"] + 1.0
    share = SMOOTH + (sums["emit"] > 0.5).sum(axis=0)  # of what a state emits, as much is new as it has emitted kinds of classes
    emit = (sums["emit"] + share * corpus[:, None]) / (sums["emit"].sum(axis=0) + share)
    return start / start.sum(), move / move.sum(axis=1, keepdims=True), emit


def first_model(corpus: np.ndarray, states: int) -> Model:
    """Random transitions, and the corpus' emissions, each state's with random factors."""
    rng = np.random.default_rng(SEED)
    emit = corpus[:, None] * np.exp(rng.normal(size=(len(corpus), states)))
    return np.full(states, 1 / states), rng.dirichlet(np.ones(states), states), emit / emit.sum(axis=0)


def all_expected(model: Model, texts: list[np.ndarray], sums: dict) -> None:
    for group in batches_by_length(texts):
        expected(model, [texts[i] for i in group], sums)


def sums_of(docs: DataFrame, model: Model) -> dict:
    """The expected counts over all rows of docs (ids). They are summed before and after the shuffle; one row for each class comes back."""
    classes, states = model[2].shape
    names = ["kind", "at", *[f"s{j}" for j in range(states)]]
    schema = ", ".join(["kind int", "at int", *[f"s{j} double" for j in range(states)]])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # classes x states numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = empty_sums(classes, states)
        for batch in batches:
            all_expected(shared.value, [np.frombuffer(x.as_py(), dtype="<u2").astype(np.int64) for x in batch.column(0)], sums)
        some = np.flatnonzero(sums["emit"].any(axis=1))
        table = np.concatenate([sums["emit"][some], sums["move"], sums["start"][None], np.full((1, states), sums["log"])])
        kind = np.concatenate([np.zeros(len(some)), np.ones(states), [2, 3]]).astype(np.int32)
        at = np.concatenate([some, np.arange(states), [0, 0]]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(at), *[pa.array(table[:, j]) for j in range(states)]], names=names)

    counted = docs.select("ids").mapInArrow(run, schema).groupBy("kind", "at").agg(*[F.sum(f"s{j}").alias(f"s{j}") for j in range(states)]).toArrow()
    shared.unpersist()
    kind, at = counted.column(0).to_numpy(), counted.column(1).to_numpy()
    rows = np.stack([counted.column(2 + j).to_numpy() for j in range(states)], axis=1)
    sums = empty_sums(classes, states)
    sums["emit"][at[kind == 0]] = rows[kind == 0]
    sums["move"][at[kind == 1]] = rows[kind == 1]
    sums["start"] = rows[kind == 2].sum(axis=0)
    sums["log"] = float(rows[kind == 3, 0].sum())
    return sums


def trained(blocks: list, whole, tokens: int, corpus: np.ndarray, states: int, rounds: int = ROUNDS, count: Callable = sums_of) -> Model:
    """Baum-Welch, block by block and then once over all. blocks and whole: what count(texts, model) counts; tokens: their number in whole."""
    model, held, seen = first_model(corpus, states), None, 0
    for block in blocks * rounds:
        new = count(block, model)
        if not new["emit"].any():
            continue
        share = (seen + 2) ** -FORGET
        held = {name: held[name] * (1 - share) + new[name] * share for name in new} if seen else new
        seen += 1
        model = estimated({name: x * (tokens / held["emit"].sum()) for name, x in held.items()}, corpus)
    return estimated(count(whole, model), corpus)


def class_scores(docs: DataFrame, model: Model, head_logs: np.ndarray) -> DataFrame:
    """key, doc_id, n_tokens, log10 of the class sequence's probability, and the head tokens' base score and number."""
    told = docs.sparkSession.sparkContext.broadcast((model, head_logs))
    names = ["key", "doc_id", "n_tokens", "classes", "head_base", "head_known"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, logs = told.value
        for batch in batches:
            texts = [np.frombuffer(x.as_py(), dtype="<u2").astype(np.int64) for x in batch.column(2)]
            out = np.zeros(len(texts))
            for group in batches_by_length(texts):
                out[group] = forward(model, [texts[i] for i in group])
            heads = [t[t < HEAD] for t in texts]
            base, known = [float(logs[h].sum()) for h in heads], [len(h) for h in heads]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sizes, pa.array(out / math.log(10)), pa.array(base, pa.float64()), pa.array(known, pa.int64())], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("key", "doc_id", "ids").mapInArrow(run, f"key bigint, doc_id {kind}, n_tokens bigint, classes double, head_base double, head_known bigint")


def scored(docs: DataFrame, states: int = STATES, head_size: int = HEAD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. docs: doc_id, text."""
    spark = docs.sparkSession
    texts = docs.filter(~held_out(F.col("doc_id"))).select(F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    counts = stash(token_counts(texts), "token-counts")
    n, v = (int(x or 0) for x in counts.agg(F.sum("c"), F.count(F.lit(1))).first())
    top = commonest(counts, head_size)  # bounded by HEAD
    head = top.column(0).to_pylist()
    head_counts = np.zeros(HEAD, dtype=np.int64)
    head_counts[: len(head)] = top.column(1).to_numpy()
    known_head = spark.createDataFrame(pa.table({"token": pa.array(head, pa.binary())})) if head else None
    rare = counts.join(F.broadcast(known_head), "token", "left_anti") if head else counts  # at most HEAD rows
    group = (F.crc32(F.when(F.length("token") > 3, F.expr("substring(token, -3, 3)")).otherwise(F.col("token"))) % TAIL).cast("int")
    rare = rare.withColumn("class", group)
    tail_n, tail_v = np.zeros(TAIL), np.zeros(TAIL)
    for r in rare.groupBy("class").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect():  # TAIL rows
        tail_n[r["class"]], tail_v[r["class"]] = r["n"], r["v"]
    corpus = np.concatenate([head_counts, tail_n]) + 1.0
    corpus[len(head) : HEAD] = 0.0  # places that no token has
    if END not in head:
        corpus[HEAD + tail_class(END)] += 1.0
    corpus /= corpus.sum()
    base_of = lambda c: np.log10((c + 1.0) / (n + v + 1.0))

    rows = encoded(docs, head)
    train = rows.filter("train")
    model = trained([train.filter(F.col("block") == b) for b in range(BLOCKS)], train, n, corpus, states)
    shares = spark.createDataFrame(pa.table({"class": pa.array(range(TAIL), pa.int32()), "all": pa.array(tail_n + tail_v + 1.0)}))
    asked = rows.select("key", F.explode("tail").alias("t")).select("key", "t.token", "t.n")
    found = asked.join(rare.select("token", "c"), "token", "left").withColumn("class", group).join(F.broadcast(shares), "class")  # TAIL rows
    c = F.coalesce("c", F.lit(0)).cast("double")
    tails = found.groupBy("key").agg(
        F.sum(F.col("n") * F.log10((c + 1.0) / F.lit(n + v + 1.0))).alias("tail_base"),
        F.sum(F.col("n") * F.log10((c + 1.0) / F.col("all"))).alias("tail_share"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(F.lit(0))).alias("tail_known"),
    )
    whole = class_scores(rows, model, base_of(head_counts.astype(float))).join(tails, "key", "left")
    return whole.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("tail_base", F.lit(0.0))).alias("base_score"),
        (F.col("classes") + F.coalesce("tail_share", F.lit(0.0))).alias("score"),
    )


def op3_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents").select("doc_id", "text"))
