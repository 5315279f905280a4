"""Toxicity and language-model scores."""

import collections
import math
import random
import zlib

import numpy as np
import pytest

from flowspark.llm import hmm
from flowspark.llm.toxicity import fit, forward_backward, marginals, reject_toxic, sampled, scored


def brute_marginals(odds, chain):
    n = len(odds)
    weight = np.zeros((2,) * n)
    for tags in np.ndindex(*weight.shape):
        w = 1.0
        for t, y in enumerate(tags):
            w *= odds[t] if y else 1.0
            if t:
                w *= chain[tags[t - 1]][y]
        weight[tags] = w
    return np.array([np.take(weight, 1, axis=t).sum() / weight.sum() for t in range(n)])


def test_marginals_against_all_taggings():
    rng = np.random.default_rng(1)
    chain = np.exp(rng.normal(size=(2, 2)))
    lengths = np.array([3, 0, 7, 1, 7, 2])
    odds = np.exp(rng.normal(size=lengths.sum()))
    p = marginals(odds, lengths, chain)
    ends = np.cumsum(lengths)
    for n, e in zip(lengths, ends, strict=True):
        if n:
            assert np.allclose(p[e - n : e], brute_marginals(odds[e - n : e], chain))
    assert len(forward_backward(np.zeros(0), np.array([0, 0]), chain)[0]) == 0


@pytest.fixture()
def toxic_corpus(spark):
    rnd = random.Random(8)
    vocabulary, bad = [f"word{i}" for i in range(300)], ["idiot", "Moron", "scum"]
    docs, labels = [], []
    for i in range(600):
        text = [rnd.choice(vocabulary) for _ in range(30)]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                text.insert(rnd.randrange(30), rnd.choice(bad) + rnd.choice(["", ",", "."]))
        docs.append((i, " ".join(text)))
        if i % 3:
            labels.append((i, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy(toxic_corpus):
    docs, labels = toxic_corpus
    rows = scored(docs, fit(docs, labels)).collect()
    assert all((r["score"] >= 0.3) == (r["doc"]["doc_id"] % 5 == 0) for r in rows)
    assert all(r["doc"]["text"][s["start"] : s["end"]].strip(",.") in ("idiot", "Moron", "scum") for r in rows for s in r["spans"])
    assert reject_toxic(docs, labels).count() == 480


def plain_score(text, model):
    """The score of one text by a plain forward-backward over its words, in probabilities that are scaled at each step."""
    words = text.lower().encode().split()
    emit = []
    for w in words:
        core = w.strip(b".,;:!?\"'()[]{}*&%$#<>|")
        names = [b"=" + core, *[b"^" + core[:n] for n in (3, 4, 5, 6) if len(core) > n]]
        emit.append((1.0, math.exp(max(-30.0, min(30.0, sum(model["weights"].get(f, 0.0) for f in names) + model["bias"])))))
    chain, ahead, back = model["chain"], [], [(1.0, 1.0)]
    for t, e in enumerate(emit):
        now = [e[y] * (sum(ahead[-1][x] * chain[x][y] for x in (0, 1)) if t else 1.0) for y in (0, 1)]
        ahead.append([v / sum(now) for v in now])
    for e in reversed(emit[1:]):
        now = [sum(chain[x][y] * e[y] * back[-1][y] for y in (0, 1)) for x in (0, 1)]
        back.append([v / sum(now) for v in now])
    p = [a[1] * b[1] / (a[0] * b[0] + a[1] * b[1]) for a, b in zip(ahead, back[::-1], strict=False)]
    x = [1.0, max(p, default=0.0), math.log1p(sum(p))]
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(x, model["layer"], strict=True)))))), p


def test_toxicity_scores_text_by_text(spark, toxic_corpus, awkward):
    docs, labels = toxic_corpus
    model = fit(docs, labels)
    mixed = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(["", "idiot", "idiot Moron, scum word1 word2", "word3 " * 400 + "(scum!)", "ídiot \U0001f600 scum"])], "doc_id long, text string")
    for frame in (docs, mixed, awkward.select("doc_id", "text")):
        for r in scored(frame, model).collect():
            score, p = plain_score(r["doc"]["text"] or "", model)
            assert math.isclose(r["score"], score, rel_tol=1e-6), r["doc"]
            assert [s["marginal"] for s in r["spans"]] == pytest.approx([q for q in p if q > 0.5], rel=1e-6)


def test_long_labelled_texts_teach(spark, toxic_corpus):
    """Where all toxic documents are long they are learned from, as many as the bound on bytes allows; labels without a document don't count."""
    docs, labels = toxic_corpus
    rows, marks = docs.collect(), labels.collect()
    toxic = {r["doc_id"] for r in marks if r["toxic"]}
    grown = [(r["doc_id"], r["text"] + " word7" * 3000 if r["doc_id"] in toxic else r["text"]) for r in rows]
    long_docs = spark.createDataFrame(grown, "doc_id long, text string")
    more = labels.unionByName(spark.createDataFrame([(10_000 + i, 1) for i in range(5000)], "doc_id long, toxic int"))
    got = scored(long_docs, fit(long_docs, more)).collect()
    assert sum((r["score"] >= 0.3) == (r["doc"]["doc_id"] % 5 == 0) for r in got) >= 0.98 * len(got)
    few = {r["_id"]: r["_toxic"] for r in sampled(long_docs, more, "text", "doc_id", 20, 100_000).collect()}
    assert sum(few.values()) == 5 and len(few) == 25  # 18 kB each
    assert sampled(long_docs, more, "text", "doc_id", 20, 10).count() == 2


def test_toxicity_edge_cases(spark, toxic_corpus, awkward, empty):
    docs, labels = toxic_corpus
    model = fit(docs, labels)
    rows = scored(awkward, model).collect()
    assert len(rows) == 9 and all(0 <= r["score"] <= 1 for r in rows)
    assert scored(empty, model).count() == 0
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    assert fit(awkward, none) is None and reject_toxic(awkward, none).count() == 9
    assert reject_toxic(awkward, none).columns == awkward.columns


def test_forward_against_all_paths():
    rng = np.random.default_rng(2)
    k, c = 3, 5
    start, move, emit = model = rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), size=k), rng.dirichlet(np.ones(c), size=k).T
    texts = sorted((rng.integers(0, c, n) for n in (1, 6, 4, 4)), key=len, reverse=True)
    for text, got in zip(texts, hmm.forward(model, texts), strict=True):
        total = 0.0
        for path in np.ndindex(*(k,) * len(text)):
            p = start[path[0]] * emit[text[0], path[0]]
            for t in range(1, len(text)):
                p *= move[path[t - 1], path[t]] * emit[text[t], path[t]]
            total += p
        assert math.isclose(got, math.log(total), rel_tol=1e-9)


def test_expected_counts_against_all_paths():
    rng = np.random.default_rng(4)
    k, c = 3, 5
    start, move, emit = model = rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), size=k), rng.dirichlet(np.ones(c), size=k).T
    texts = sorted((rng.integers(0, c, n) for n in (1, 6, 4, 4)), key=len, reverse=True)
    want, got = hmm.empty_sums(c, k), hmm.empty_sums(c, k)
    for text in texts:
        weights = {}
        for path in np.ndindex(*(k,) * len(text)):
            p = start[path[0]] * emit[text[0], path[0]]
            for t in range(1, len(text)):
                p *= move[path[t - 1], path[t]] * emit[text[t], path[t]]
            weights[path] = p
        total = sum(weights.values())
        want["log"] += math.log(total)
        for path, p in weights.items():
            want["start"][path[0]] += p / total
            for t, (x, z) in enumerate(zip(text, path, strict=True)):
                want["emit"][x, z] += p / total
                if t:
                    want["move"][path[t - 1], z] += p / total
    hmm.expected(model, texts, got)
    assert all(np.allclose(got[name], want[name], rtol=1e-4) for name in want)


def test_training_finds_the_chain(monkeypatch):
    """Texts that alternate between two vocabularies: rounds raise the likelihood of texts not trained on, and the states come to alternate within a text."""
    rng = np.random.default_rng(3)

    def text():
        z, out = rng.integers(2), []
        for _ in range(60):
            out.append(rng.integers(5) + 5 * z)
            z = z if rng.random() < 0.1 else 1 - z
        return np.array(out)

    blocks, fresh = [[text() for _ in range(20)] for _ in range(4)], [text() for _ in range(40)]
    corpus = np.ones(10) / 10

    def count(block, model):
        sums = hmm.empty_sums(10, 2)
        hmm.all_expected(model, block, sums)
        return sums

    whole = [t for block in blocks for t in block]
    monkeypatch.setattr(hmm, "SMOOTH", 1.0)
    models = [hmm.trained(blocks, whole, 80 * 60, corpus, 2, rounds, count) for rounds in (0, 1, 3, 8)]
    logs = [hmm.forward(m, fresh).sum() for m in models]
    assert logs == sorted(logs) and logs[-1] > logs[0] + 500
    assert (np.diag(models[-1][1]) < 0.3).all() and abs(models[-1][1] - models[1][1]).max() > 0.01


def test_scores(spark):
    rnd = random.Random(6)
    docs = [(i, " ".join(rnd.choice("abcdefgh" if i % 2 else "ijklmnop") * rnd.randint(1, 3) for _ in range(30))) for i in range(200)] + [(500, None), (None, "Zz aa"), (501, ""), (502, "aa \x1c unseen")]
    rows = {r["doc_id"]: r for r in hmm.scored(spark.createDataFrame(docs, "doc_id long, text string"), head_size=20).collect()}
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    tokens = lambda t: [*(t or "").encode().lower().split(), None]
    counts = collections.Counter(w for i, t in docs if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    for i, t in docs:
        w, r = tokens(t), rows[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(i), len(w), sum(x in counts for x in w), n)
        assert math.isclose(r["base_score"], sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
    assert sum(r["score"] for r in rows.values()) > sum(r["base_score"] for r in rows.values())


def test_states_of_long_texts_among_copies(spark):
    """Only texts of over 4000 tokens, most of them copies of one: the states still tell the kinds of texts apart."""
    rnd = random.Random(8)
    docs = [(i, " ".join(rnd.choice("abcdefgh" if i % 2 else "ijklmnop") for _ in range(4500))) for i in range(30)]
    docs += [(100 + i, docs[0][1]) for i in range(30)]
    for r in hmm.scored(spark.createDataFrame(docs, "doc_id long, text string"), head_size=20).collect():
        if r["doc_id"] < 100 and r["doc_id"] % 2:  # the kind without copies; a single state gives what the base score gives
            assert r["score"] - r["base_score"] > 0.2 * r["n_tokens"]


def test_score_is_the_models(spark, monkeypatch):
    """score against the definition: the class sequence's probability by all paths, times each rare token's share of its class."""
    caught = []
    monkeypatch.setattr(hmm, "trained", lambda *a, f=hmm.trained: caught.append((a[3], f(*a))) or caught[-1][1])
    rnd = random.Random(9)
    docs = [(i, " ".join(rnd.choice(["to", "be", "or", "not", "alpha", "beta", "betta", "gamma"]) for _ in range(rnd.randint(0, 4)))) for i in range(80)]
    rows = hmm.scored(spark.createDataFrame(docs, "doc_id long, text string"), states=2, head_size=4).collect()
    (corpus, (start, move, emit)) = caught[0]
    counts = collections.Counter()
    for i, t in docs:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update([*t.encode().split(), b""])
    head = [w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:4]]
    tail = {}
    for w in counts:
        if w not in head:
            tail.setdefault(hmm.tail_class(w), []).append(w)
    class_of = lambda w: head.index(w) if w in head else hmm.HEAD + hmm.tail_class(w)
    texts = dict(docs)
    for r in rows:
        words = [*texts[r["doc_id"]].encode().split(), b""]
        total = 0.0
        for path in np.ndindex(*(2,) * len(words)):
            p = start[path[0]]
            for t, (w, z) in enumerate(zip(words, path, strict=True)):
                p *= emit[class_of(w), z] * (move[path[t - 1], z] if t else 1.0)
            total += p
        share = 0.0
        for w in words:
            if w not in head:
                same = tail.get(hmm.tail_class(w), [])
                share += math.log10((counts[w] + 1) / (sum(counts[x] for x in same) + len(same) + 1))
        assert math.isclose(r["score"], math.log10(total) + share, rel_tol=1e-9)


def test_scores_edge_cases(awkward, empty):
    assert hmm.scored(awkward).count() == 9
    assert hmm.scored(empty).count() == 0
