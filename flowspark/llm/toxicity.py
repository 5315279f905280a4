"""Toxicity by a linear-chain conditional random field over tokens.

Training takes a bounded sample of labelled documents. Their tokens are labelled first: a token is toxic if
its document is and one of its features (the word or a prefix) is tied to toxic documents by a
likelihood-ratio test. A two-tag chain with hashed word features is fitted to these
tokens by exact gradients from forward-backward. Scoring runs forward-backward over whole
texts; the marginals of the toxic tag give the document's score, by a logistic function of
their maximum and sum, and the offsets of offending tokens.

Labels, lang, source and doc_id are no inputs of a score. Defined cases: a null or empty text has
no tokens and gets the score of the intercept alone; null labels are not used, and of
several labels of a document the highest counts; without labelled documents of both kinds every score is
0; an empty table gives an empty table; repeated rows get equal scores; very long
texts are scored whole; other columns are carried along by `scored` and `reject_toxic`, whatever their names.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from .common import coded_words, groups, stash, table

#: The training sample: of each kind at most so many labelled documents and, but for the first, so many bytes together.
SAMPLE, SAMPLE_BYTES = 1200, 12_000_000
#: Documents of more bytes teach only where there are too few others; and so many times the sample is sorted to choose it.
LONG, MARGIN = 12_000, 3
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2
PREFIXES = (3, 4, 5, 6)
STEPS = 60
CACHE_WORDS = 300_000
EDGES = b".,;:!?\"'()[]{}*&%$#<>|"
SPANS = ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType()), StructField("marginal", DoubleType())]))


def features(word: bytes) -> list[bytes]:
    word = word.lower().strip(EDGES)
    return [b"=" + word, *[b"^" + word[:n] for n in PREFIXES if len(word) > n]]


def held_out(doc_id: Column, folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


# --- the chain ----------------------------------------------------------------------------------


def forward_backward(odds: np.ndarray, lengths: np.ndarray, chain: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of concatenated texts: forward and backward odds of the toxic tag at each token, the texts' starts, and their order.

    odds: exp of the emission score's difference. chain: exp of transition scores [from][to]. Texts of like
    length advance together, each to its own end, so the work is in proportion to the tokens.
    """
    order = np.argsort(-lengths, kind="stable")
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1][order]
    sizes = lengths[order]
    ahead, back = np.empty_like(odds), np.ones_like(odds)
    (a00, a01), (a10, a11) = chain
    if not len(sizes) or not sizes[0]:
        return ahead, back, starts, order
    alive = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")
    now = starts[: alive[0]]
    ratio = odds[now]
    ahead[now] = ratio
    for t in range(1, sizes[0]):
        n = alive[t]
        now, ratio = starts[:n] + t, ratio[:n]
        ratio = np.clip(odds[now] * (a01 + ratio * a11) / (a00 + ratio * a10), 1e-30, 1e30)
        ahead[now] = ratio
    later = np.ones(0)
    for t in range(sizes[0] - 2, -1, -1):
        n = alive[t + 1]  # texts with a token after this one
        if len(later) < n:
            later = np.concatenate([later, np.ones(n - len(later))])
        step = odds[starts[:n] + t + 1] * later
        later = np.clip((a10 + step * a11) / (a00 + step * a01), 1e-30, 1e30)
        back[starts[:n] + t] = later
    return ahead, back, starts, order


def marginals(odds: np.ndarray, lengths: np.ndarray, chain: np.ndarray) -> np.ndarray:
    ahead, back, _, _ = forward_backward(odds, lengths, chain)
    joint = ahead * back
    return joint / (1 + joint)


def families(texts: list[set[bytes]]) -> np.ndarray:
    """A number for each text; texts that share most of their words get one number, as copies prove nothing twice."""
    root = list(range(len(texts)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    multipliers = np.arange(1, 129, 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
    owner: dict[tuple, int] = {}
    for i, words in enumerate(texts):
        hashes = np.fromiter((zlib.crc32(w) | zlib.adler32(w) << 32 for w in words), dtype=np.uint64, count=len(words))
        least = (hashes[None, :] * multipliers[:, None] >> np.uint64(20)).min(axis=1).tolist() if words else [0] * 64
        for band in range(0, 64, 8):
            other = owner.setdefault((band, *least[band : band + 8]), i)
            root[find(i)] = find(other)
    return np.array([find(i) for i in range(len(texts))])


def train(texts: list[bytes], toxic: np.ndarray) -> dict:
    """The fitted chain: weights by feature, bias, chain (2 x 2, as factors) and the logistic layer."""
    types: dict[bytes, int] = {}
    words = [[types.setdefault(w, len(types)) for w in t.split()] for t in texts]
    numbers: dict[bytes, int] = {}  # of features
    names = list(types)
    sizes, flat = array("H"), array("i")
    for w in names:
        mine = [numbers.setdefault(f, len(numbers)) for f in features(w)]
        sizes.append(len(mine))
        flat.extend(mine)
    flat, sizes = np.array(flat, dtype=np.int64), np.array(sizes, dtype=np.int64)
    ends = np.cumsum(sizes)
    family = families([{names[w] for w in set(t)} for t in words])
    n, seen = np.zeros(2), np.zeros((2, len(numbers)))  # families, and families with each feature
    for y in (0, 1):
        for f in np.unique(family[toxic == y]).tolist():
            held = np.unique(np.concatenate([[], *[np.asarray(words[i], dtype=np.int64) for i in np.flatnonzero((family == f) & (toxic == y))]]).astype(np.int64))
            n[y] += 1
            if len(held):
                seen[y][np.unique(np.concatenate([flat[ends[w] - sizes[w] : ends[w]] for w in held.tolist()]))] += 1
    by_number = list(numbers)
    del numbers
    usable = np.flatnonzero(seen.sum(axis=0) >= 3)
    a, b = seen[0][usable], seen[1][usable]
    least = max(12.0, 2 * np.log(max(len(usable), 1)))  # about one false tie among all features
    share = (a + b) / n.sum()
    part = lambda k, m: np.where(k > 0, k * np.log(np.maximum(k, 1) / (share * m)), 0.0)
    tied = (2 * (part(b, n[1]) + part(a, n[0])) >= least) & (b / n[1] >= 100 * a / n[0])
    place = np.full(seen.shape[1], -1, dtype=np.int64)
    place[usable] = np.arange(len(usable))
    mark = np.zeros(seen.shape[1], dtype=bool)
    mark[usable[tied]] = True
    owner = np.repeat(np.arange(len(names)), sizes)
    bad = (np.bincount(owner, weights=mark[flat], minlength=len(names)) > 0).astype(float)
    known = [by_number[i] for i in usable.tolist()]
    del by_number
    keep = place[flat] >= 0
    flat, owner, kinds = place[flat][keep], owner[keep], names
    tokens = np.fromiter((w for t in words for w in t), dtype=np.int64)
    lengths = np.array([len(t) for t in words], dtype=np.int64)
    gold = bad[tokens] * np.repeat(toxic, lengths)
    first = np.zeros(len(tokens), dtype=bool)
    first[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    pairs = np.flatnonzero(~first)
    counted = np.bincount(gold[pairs - 1].astype(int) * 2 + gold[pairs].astype(int), minlength=4).reshape(2, 2)
    weights, bias, chain = np.where(tied, 2.0, 0.0), -5.0, np.zeros((2, 2))
    memory = [np.zeros(len(known)), 0.0, np.zeros((2, 2))]
    gold_types = np.bincount(tokens, weights=gold, minlength=len(kinds))
    emission = lambda: np.bincount(owner, weights=weights[flat], minlength=len(kinds)) + bias
    for _ in range(STEPS):
        odds = np.exp(np.clip(emission(), -30, 30))[tokens]
        moved = np.exp(chain)
        ahead, back, _, _ = forward_backward(odds, lengths, moved)
        p = ahead * back / (1 + ahead * back)
        left, right = ahead[pairs - 1], odds[pairs] * back[pairs]
        joint = np.stack([np.full(len(pairs), moved[0, 0]), moved[0, 1] * right, left * moved[1, 0], left * moved[1, 1] * right])
        expected = (joint / joint.sum(axis=0)).sum(axis=1).reshape(2, 2)
        slope_types = gold_types - np.bincount(tokens, weights=p, minlength=len(kinds))
        slopes = (
            np.bincount(flat, weights=slope_types[owner], minlength=len(known)) - 0.1 * weights,
            slope_types.sum(),
            counted - expected - 0.1 * chain,
        )
        values = []
        for i, (value, slope) in enumerate(zip((weights, bias, chain), slopes, strict=True)):  # adaptive steps
            memory[i] = memory[i] + slope * slope
            values.append(value + 0.7 * slope / np.sqrt(memory[i] + 1e-8))
        weights, bias, chain = values
    p = marginals(np.exp(np.clip(emission(), -30, 30))[tokens], lengths, np.exp(chain))
    layer = logistic(document_inputs(p, lengths), toxic)
    kept = {f: float(x) for f, x in zip(known, weights, strict=True) if abs(x) > 1e-4}
    return {"weights": kept, "bias": float(bias), "chain": np.exp(chain), "layer": layer}


def document_inputs(p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Intercept, the largest marginal and the logarithm of one plus their sum."""
    ends = np.cumsum(lengths)
    sums = np.concatenate([[0], np.cumsum(p)])
    total = sums[ends] - sums[ends - lengths]
    most = np.zeros(len(lengths))
    some = lengths > 0
    if some.any():
        most[some] = np.maximum.reduceat(p, (ends - lengths)[some])
    return np.stack([np.ones(len(lengths)), most, np.log1p(np.maximum(total, 0))], axis=1)


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton's method with a small ridge."""
    beta = np.zeros(x.shape[1])
    for _ in range(25):
        mean = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        curve = (x * (mean * (1 - mean))[:, None]).T @ x + np.diag([1e-3, 0.1, 0.1])
        beta = beta + np.linalg.solve(curve, x.T @ (y - mean) - np.array([1e-3, 0.1, 0.1]) * beta)
    return beta


# --- on tables ------------------------------------------------------------------------------------


def sampled(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, sample: int, sample_bytes: int) -> DataFrame:
    """_id and _toxic of the documents to learn from: of each kind at most `sample`, chosen by a hash of their id.

    Only labels with a document count. Together a kind's texts hold at most sample_bytes bytes, but for the first; documents of over LONG
    bytes are taken last, so that they teach where there are too few others.
    """
    usable = labels.filter(F.col("toxic").isNotNull() & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id)))
    usable = usable.groupBy(F.col(doc_id).alias("_id")).agg((F.max("toxic") > 0).cast("int").alias("_toxic"))
    sizes = docs.groupBy(F.col(doc_id).alias("_id")).agg(F.max(F.coalesce(F.octet_length(text), F.lit(0))).cast("long").alias("_bytes"))
    labelled = stash(usable.join(sizes, "_id").withColumn("_place", F.xxhash64("_id")), "labelled")
    found = {r["_toxic"]: r["n"] for r in labelled.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    # About MARGIN times the sample is sorted, whatever the number of labels.
    share = F.lit(0.0)
    for kind, n in found.items():
        share = F.when(F.col("_toxic") == kind, F.lit(min(1.0, MARGIN * sample / n))).otherwise(share)
    some = labelled.filter(F.pmod("_place", F.lit(1 << 30)).cast("double") < share * float(1 << 30))
    order = Window.partitionBy("_toxic").orderBy(F.col("_bytes") > LONG, "_place", "_id")
    ranked = some.withColumns({"_k": F.row_number().over(order), "_upto": F.sum("_bytes").over(order.rowsBetween(Window.unboundedPreceding, 0))})
    return ranked.filter((F.col("_k") == 1) | (F.col("_k") <= sample) & (F.col("_upto") <= sample_bytes)).select("_id", "_toxic")


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> dict | None:
    """The model, or None if there are no documents with labels of both kinds. Reads the texts of at most 2 * sample documents."""
    chosen = sampled(docs, labels, text, doc_id, sample, sample_bytes)
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = (
        docs.select(F.col(doc_id).alias("_id"), body.alias("_text"))
        .join(F.broadcast(chosen), "_id")  # at most 2 * sample rows
        .groupBy("_id", "_toxic")
        .agg(F.min("_text").alias("_text"))
        .select("_text", "_toxic")
        .toArrow()
    )
    toxic = rows.column(1).to_numpy()
    if len(set(toxic.tolist())) < 2:
        return None
    texts = [bytes(x) for x in rows.column(0).to_pylist()]
    order = sorted(range(len(texts)), key=lambda i: (int(toxic[i]), texts[i]))  # any order of rows gives one model
    return train([texts[i] for i in order], toxic[order].astype(float))


class Scorer:
    def __init__(self, model: dict):
        self.model = model
        self.cache: dict[bytes, float] = {}

    def emissions(self, words: list[bytes]) -> np.ndarray:
        """Of some distinct words."""
        cache, get, bias = self.cache, self.model["weights"].get, self.model["bias"]
        if len(cache) + len(words) > CACHE_WORDS:
            cache.clear()
        found = list(map(cache.get, words))
        for i, known in enumerate(found):
            if known is None:
                cache[words[i]] = found[i] = sum([get(f, 0.0) for f in features(words[i])]) + bias
        return np.array(found, dtype=np.float64)

    def __call__(self, texts: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores, each text's number of tokens, and the marginals of all tokens."""
        words, codes, ends = coded_words(texts)
        odds = np.exp(np.clip(self.emissions(words.to_pylist()), -30, 30))[codes]
        lengths = np.diff(ends, prepend=0)
        p = marginals(odds, lengths, self.model["chain"])
        x = document_inputs(p, lengths) @ self.model["layer"]
        return 1 / (1 + np.exp(-np.clip(x, -30, 30))), lengths, p


def offending(text: bytes, p: np.ndarray) -> list[dict]:
    """Code point offsets of the tokens whose marginal is over one half."""
    spans, at, place, done = [], 0, 0, 0
    for word, q in zip(text.split(), p, strict=True):
        at = text.index(word, at)
        if q > 0.5:
            place, done = place + len(text[done:at].decode()), at
            spans.append({"start": place, "end": place + len(word.decode()), "marginal": float(q)})
        at += len(word)
    return spans


def scored(docs: DataFrame, model: dict | None, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """doc (a struct of docs' columns, or of those in carry, whatever their names), score double and spans array<struct<start, end, marginal>>."""
    doc = F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in (docs.columns if carry is None else carry)]).alias("doc")
    if model is None:
        return docs.select(doc, F.lit(0.0).alias("score"), F.array().cast(SPANS).alias("spans"))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("marginal", pa.float64())]))
    rows = docs.select(doc, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for whole in batches:
            for batch in groups(whole, 1):
                texts = batch.column(1).to_pylist()
                score, lengths, p = scorer(batch.column(1))
                ends = np.cumsum(lengths)
                high = np.concatenate([[0], np.cumsum(p > 0.5)])
                spans = [offending(t, p[e - n : e]) if high[e] > high[e - n] else [] for t, e, n in zip(texts, ends, lengths, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array(spans, span)], names=["doc", "score", "spans"])

    return rows.mapInArrow(run, StructType([rows.schema["doc"], StructField("score", DoubleType()), StructField("spans", SPANS)]))


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not toxic, with the columns of docs."""
    return scored(docs, fit(docs, labels)).filter(F.col("score") < threshold).select("doc.*")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    got = scored(docs, fit(docs, table(spark, sf_dir, "labels")), carry=["doc_id"])
    return got.select(
        "doc.doc_id",
        held_out(F.col("doc.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "spans",
    )
