"""Every opN query on the smallest test tables: against its SQL where it has one, else against the contract."""

import os
import zlib

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from flowspark.llm.queries import ORACLES, QUERIES

from ..test_queries import DATA, rows

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    plain = lambda df: df.map(lambda v: v.tolist() if isinstance(v, np.ndarray) else v)
    assert rows(plain(QUERIES[name](spark, DATA).toPandas())) == rows(plain(duck.sql(ORACLES[name]).df()))


def test_all_are_registered():
    assert {f"op{i}" for i in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_language_model_scores(spark, duck):
    got = QUERIES["op3_hmm"](spark, DATA).toPandas().set_index("doc_id")
    texts = dict(duck.sql("SELECT doc_id, text FROM documents").fetchall())
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, t in texts.items()}
    counts: dict = {}
    for i, words in tokens.items():
        for w in words if fold(i, 7) != 2 else ():
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(texts)
    for i, words in tokens.items():
        r = got.loc[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (fold(i, 7) == 2, len(words), sum(w in counts for w in words), n)
        assert abs(r["base_score"] - sum(np.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in words)) < 1e-6 * len(words)
        assert r["score"] < 0


def test_toxicity_scores(spark, duck):
    got = QUERIES["op7_toxicity"](spark, DATA).toPandas()
    ids = {r[0] for r in duck.sql("SELECT doc_id FROM documents").fetchall()}
    assert set(got["doc_id"]) == ids and len(got) == len(ids)
    assert all(h == (fold(i, 4) == 2) for i, h in zip(got["doc_id"], got["held_out"], strict=True))
    assert got["score"].between(0, 1).all() and ((got["score"] >= 0.3) == (got["predicted"] == 1)).all()


def test_packed_pieces(spark, duck):
    from tokenizers import Tokenizer

    from flowspark.llm.packing import tokenizer_path

    whole = Tokenizer.from_file(tokenizer_path())
    got = QUERIES["op5_packing"](spark, DATA).toPandas()
    want = {}
    for i, t in duck.sql("SELECT doc_id, text FROM documents").fetchall():
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for k, at in enumerate(range(0, len(ids), 4096)):
            want[i, k] = (at, len(ids[at : at + 4096]), zlib.crc32(ids[at : at + 4096].tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got.itertuples()} == want and len(got) == len(want)
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert (g["offset"].to_numpy() == np.cumsum(g["length"]) - g["length"]).all() and g["length"].sum() <= 4096
    assert got["sequence_id"].nunique() == got["n_sequences"].iloc[0] >= got["least_sequences"].iloc[0]
