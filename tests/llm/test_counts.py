"""Token counts, runs of words and the Merkle manifest, against the library or brute force."""

import hashlib
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowspark.llm import merkle, periodic, tokencount
from flowspark.llm.queries import QUERIES

from ..test_queries import DATA


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokencount.tokenizer_path())


@pytest.fixture(scope="module")
def counter():
    return tokencount.PrefixCounter(tokencount.tokenizer_path())


def tokens(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


PARTS = ["a", "b", "the", " ", "  ", "\n", "\t", "'", "'s", "'re", "'ll", "r", "l", "1", "22", "-", "--", ".", "é", "日本", "😀", " ", "<|endoftext|>", "<|endo", "|>", "S", " hello", "tion", "\r\n", "don't", "ÃÂ", "\x00"]


def test_counts_at_every_prefix(library, counter):
    rng = random.Random(7)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 25))) for _ in range(200)]
    for text, counts in zip(texts, counter([t.encode() for t in texts]), strict=True):
        assert counts.tolist() == [tokens(library, text[:i]) for i in range(1, len(text) + 1)], text


def test_long_texts_are_counted_in_parts(library, counter, monkeypatch):
    monkeypatch.setattr(tokencount, "PART_BYTES", 20)
    rng = random.Random(8)
    for _ in range(60):
        text = "".join(rng.choices(PARTS, k=40))
        assert counter([text.encode()])[0].tolist() == [tokens(library, text[:i]) for i in range(1, len(text) + 1)], text


def test_classes_of_characters(library, counter):
    """Of a sample of all planes; the library's splitter is the measure."""
    split = library.pre_tokenizer.pre_tokenize_str
    for p in [*range(0x300), *range(0x300, 0xD800, 97), *range(0xE000, 0x110000, 4999)]:
        kind, c = counter.kinds.kind(chr(p)), chr(p)
        assert (len(split("a" + c)) == 1) == (kind == tokencount.LETTER) and (len(split("1" + c)) == 1) == (kind == tokencount.NUMBER)


def test_token_rows(spark, awkward, empty, library):
    got = tokencount.token_prefixes(awkward).toPandas()
    cut = tokencount.with_cut(tokencount.token_prefixes(awkward), 5).toPandas()
    rows = awkward.collect()
    assert sorted(zip(got["n_bytes"], got["n_chars"], got["n_tokens"], strict=True)) == sorted((len((r.text or "").encode()), len(r.text or ""), tokens(library, r.text or "")) for r in rows)
    assert got["doc_id"].isna().sum() == 1 and len(cut) == len(rows)
    for r, s in zip(cut.itertuples(), got.itertuples(), strict=True):
        text = next(x.text or "" for x in rows if len((x.text or "").encode()) == s.n_bytes)
        fits = r.fit_chars
        assert tokens(library, text[:fits]) <= 5 and all(tokens(library, text[:i]) > 5 for i in range(fits + 1, min(len(text), fits + 60) + 1))
        assert tokencount.tokens_of(s.steps, fits) == tokens(library, text[:fits])
    assert tokencount.token_prefixes(empty).count() == 0
    named = awkward.select(F.col("doc_id").cast("string").alias("steps"), F.col("text").alias("n_bytes"))
    assert tokencount.token_prefixes(named, text="n_bytes", doc_id="steps").filter("doc_id = '1'").count() == 2


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_token_query(spark, library):
    got = {r.doc_id: r for r in QUERIES["op11_tokens"](spark, DATA).collect()}
    rows = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        n = tokens(library, r.text or "")
        assert (got[r.doc_id].n_bytes, got[r.doc_id].n_tokens, got[r.doc_id].over_limit) == (len((r.text or "").encode()), n, n > 512)


def runs(words, least):
    """Every stretch that a period goes through, by the smallest period first."""
    codes: dict = {}
    a = np.array([codes.setdefault(w, len(codes)) for w in words], dtype=np.int64)
    out: dict = {}
    for q in range(1, len(a) // 2 + 1):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (a[:-q] == a[q:]).astype(int), [0]])))
        for s, x in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if x + q - s >= max(least, 2 * q):
                out.setdefault((s, x + q), q)
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_small_alphabets(seed):
    rng = random.Random(seed)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 5)):
            a, words = rng.randint(1, 4), []
            for _ in range(rng.randint(0, 6)):
                words += [rng.randrange(a) for _ in range(rng.randint(1, 8))] * rng.randint(1, 5)
                if rng.random() < 0.5:
                    j = rng.randrange(len(words))
                    words += words[j : j + rng.randint(1, 40)]
            texts.append(words)
        least = rng.choice([2, 4, 12])
        found = periodic.runs_of(np.array([x for t in texts for x in t], dtype=np.int64), np.cumsum([len(t) for t in texts]), least)
        assert found == [runs(t, least) for t in texts]


def test_one_word_many_times():
    n = 20_000
    assert periodic.runs_of(np.zeros(n, dtype=np.int64), np.array([n])) == [[(0, n, 1)]]


def test_run_rows(spark, awkward, empty):
    doubled = awkward.withColumn("text", F.concat_ws(" ", "text", "text", "text"))
    got = periodic.word_runs(doubled).collect()
    assert len(got) == awkward.count() and periodic.word_runs(empty).count() == 0
    for r in got:
        words = r.collapsed.split()
        if r.runs:
            assert len(r.runs) == 1 and r.runs[0].length == r.n_words and r.runs[0].period == len(words)
    named = awkward.select(F.col("doc_id").cast("string").alias("runs"), F.col("text").alias("collapsed"))
    assert periodic.word_runs(named, text="collapsed", doc_id="runs").filter("doc_id = '1'").count() == 2


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_run_query(spark):
    got = {r.doc_id: r for r in QUERIES["op12_runs"](spark, DATA).collect()}
    rows = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        words, h = (r.text or "").encode().split(), zlib.crc32(str(r.doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        want, x = runs(words, 12), got[r.doc_id]
        gone = {i for s, m, q in want for i in range(s + q, s + m)}
        top = min(want, key=lambda t: (-t[1], t[0], t[2]), default=None)
        assert (x.n_runs, x.start, x.length, x.period, x.exponent_milli) == (len(want), *((*top, 1000 * top[1] // top[2]) if top else [None] * 4))
        assert x.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in want).encode()).hexdigest()
        assert x.collapsed_sha256 == hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest()


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*fields):
    return sha(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def tree(nodes):
    """All levels of a list of nodes, and for each node its siblings up to the root as (left, right)."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    proofs = []
    for i in range(len(nodes)):
        path = []
        for level in levels[:-1]:
            run = i - i % 3
            path.append(("".join(level[run:i]), "".join(level[i + 1 : run + 3])))
            i //= 3
        proofs.append(path)
    return levels[-1][0] if nodes else None, proofs


def brute_manifest(rows, fields):
    """(id, leaf, subroot, root, proof) of each row."""
    groups: dict = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(*[r[f] for f in fields]), r["doc_id"]))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(groups[s])]) for s in order}
    root, upper = tree([trees[s][0] for s in order])
    return [(x[3], x[2], trees[s][0], root, [*path, *above]) for s, above in zip(order, upper, strict=True) for x, path in zip(sorted(groups[s]), trees[s][1], strict=True)]


def same(found, want):
    got = [(r.doc_id, r.leaf, r.subroot, r.root, [(s.left, s.right) for s in r.proof]) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_manifest_of_awkward_rows(spark, awkward, empty):
    found = merkle.manifest(awkward, carry={"place": F.col("rank")})
    same(found, brute_manifest([r.asDict() for r in awkward.collect()], merkle.FIELDS) if "n_chars" in awkward.columns else [])


@pytest.fixture()
def awkward(awkward):
    return awkward.withColumn("n_chars", F.length("text").cast("long"))


def test_empty_manifest(empty):
    assert merkle.manifest(empty.withColumn("n_chars", F.lit(1).cast("long"))).count() == 0


def test_one_row(awkward):
    one = awkward.filter("doc_id = 7")
    same(merkle.manifest(one), brute_manifest([r.asDict() for r in one.collect()], merkle.FIELDS))


def test_manifest_over_several_rounds(spark):
    """Ids over the whole range, negative, far apart and null; more rows than one task hashes up; many sources."""
    rng = random.Random(5)
    ids = [*range(-900, 900), *[rng.randrange(-(1 << 63), 1 << 63) for _ in range(300)], (1 << 63) - 1, -(1 << 63), *[None] * 40]
    rows = [(i, f"t{k}\n{k % 7}", None if k % 50 == 0 else "a" if k % 3 else f"s{k % 31}") for k, i in enumerate(ids)]
    rows += [(k, "x", f"z{k:04}") for k in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = merkle.manifest(docs, fields=("doc_id", "text"), carry={"text": F.col("text")})
    want = brute_manifest([r.asDict() for r in docs.collect()], ("doc_id", "text"))
    same(found, want)
    again = found.withColumn("to", merkle.folded(F.col("leaf"), F.col("proof")))
    assert again.filter("`to` <> root").count() == 0
    other = found.withColumn("to", merkle.folded(merkle.leaf_of(F.col("doc_id"), F.concat("text", F.lit("!"))), F.col("proof")))
    assert other.filter("`to` = root").count() == 0
    merkle.free(found)


def test_packing_sends_workers_small_batches(spark, monkeypatch):
    from flowspark.llm import packing

    setting, seen, kept = "spark.sql.execution.arrow.maxRecordsPerBatch", [], packing.stash
    monkeypatch.setattr(packing, "stash", lambda df, name, **more: (seen.append(int(spark.conf.get(setting))), kept(df, name, **more))[1])
    before = spark.conf.get(setting)
    docs = spark.range(2_500, numPartitions=1).selectExpr("id AS doc_id", "concat('word ', id) AS text")
    assert packing.pack(docs).count() == 2_500
    assert seen == [packing.BATCH_ROWS] and packing.BATCH_ROWS < int(before) == int(spark.conf.get(setting))
