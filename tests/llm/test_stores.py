"""Media chunks, packing, archives, near copies, the pipeline."""

import collections
import hashlib
import io
import random
import zipfile
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flowspark.llm import hmm, media, warc
from flowspark.llm.linededup import drop_repeated_lines
from flowspark.llm.minhash import Shingler, Sketcher, drop_near_copies, near_copies, odd_limit
from flowspark.llm.mixing import OP9_SQL, mix
from flowspark.llm.packing import TextEncoder, WordEncoder, best_fit_decreasing, encoder_of, lower_bound, pack, pack_lengths, tokenizer_path
from flowspark.llm.quality import quality_filter
from flowspark.llm.toxicity import reject_toxic

from .conftest import EN, words
from .test_native import brute_lines


def test_chunks_follow_content():
    rng = np.random.default_rng(1)
    body, gear = rng.integers(0, 256, 60_000, dtype=np.uint8).tobytes(), media.gear_table()
    parts = media.chunks_of(body, gear)
    assert b"".join(parts) == body and all(media.LEAST <= len(p) <= media.MOST for p in parts[:-1])
    assert len(set(parts) & set(media.chunks_of(b"inserted" + body, gear))) >= len(parts) - 4
    slow, h = [], 0
    for i, b in enumerate(body[:5000]):
        h = (2 * h + int(gear[b])) & 0xFFFFFFFF
        slow.append(h)
    assert media.cuts(body[:5000], gear)[0] == next(i + 1 for i, h in enumerate(slow) if i + 1 >= media.LEAST and h >> (32 - media.MASK_BITS) == 0 or i + 1 == media.MOST)
    assert media.from_wav(media.to_wav(body)) == body and media.chunks_of(b"", gear) == []


def test_media_round_trip(awkward, empty):
    docs, store = media.media_columns(awkward)
    rows = {r["doc_id"]: r for r in docs.join(media.read_back(store), "media_key").collect()}
    assert docs.count() == 9 and store.count() == 6
    for r in awkward.collect():
        body = (r["text"] or "").encode()
        payload = media.payload_of(body)
        got = rows[r["doc_id"]]
        assert (got["n_bytes"], got["payload_sha256"], got["tail_crc32"]) == (len(body), hashlib.sha256(payload).digest(), zlib.crc32(payload[-64:]))
        assert got["media_sha256"] == hashlib.sha256(media.to_wav(payload)).digest() and got["feature"] == media.feature_of(payload)
    docs, store = media.media_columns(empty)
    assert docs.count() == 0 and media.read_back(store).count() == 0


def test_shared_chunks_are_stored_once(spark):
    rnd = random.Random(9)
    passage = " ".join(f"{rnd.random()}" for _ in range(3000))
    docs = spark.createDataFrame([(i, f"head {i} {passage} tail {i * 7}") for i in range(12)], "doc_id long, text string")
    seen, store = media.media_columns(docs)
    rows = store.collect()
    unique = len({bytes(d) for r in rows for d in r["digests"]})
    assert sum(len(r["digests"]) - len(r["foreign"]) for r in rows) == unique < sum(len(r["digests"]) for r in rows) / 4
    assert media.read_back(store).count() == 12
    broken = store.withColumn("digests", F.expr("transform(digests, x -> unhex('00'))"))
    with pytest.raises(Exception, match="missing or damaged"):
        media.read_back(broken).count()


def brute_bins(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + items[i] <= capacity and bins[j] not in bins[:j]:
                bins[j] += items[i]
                go(i + 1, bins)
                bins[j] -= items[i]
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best[0]


def test_packing_is_optimal_on_small_cases():
    rnd = random.Random(1)
    for _ in range(150):
        capacity = rnd.choice([20, 50, 100])
        items = [rnd.randint(1, capacity if rnd.random() < 0.3 else capacity // 2) for _ in range(rnd.randint(1, 10))]
        counts, got = collections.Counter(items), collections.Counter()
        patterns = pack_lengths(counts, capacity)
        for filling, n in patterns:
            assert sum(a * b for a, b in filling) <= capacity
            for length, k in filling:
                got[length] += k * n
        assert got == counts
        best = brute_bins(items, capacity)
        assert sum(n for _, n in patterns) == best >= lower_bound(counts, capacity)
    assert pack_lengths({}, 10) == [] and sum(n for _, n in best_fit_decreasing({10: 10**9, 5: 2 * 10**9}, 10)) == 2 * 10**9


def test_encoder_is_the_tokenizer():
    whole = Tokenizer.from_file(tokenizer_path())
    texts = ["Hello, WORLD!! it's 42 naïve café’s", "a<|endoftext|>b x<|y", "É é   ñandú z", "İstanbul ΣΑΣ ß", "", "\x1c\x85 tab\tnew\nline", "\U0001f600\U0001f600 ok.ok", "don't we'll I'M", EN]
    encoder = WordEncoder(tokenizer_path())
    bodies = pa.array([t.encode() for t in texts], pa.binary())
    for _ in range(2):
        ids, ends = encoder(bodies)
        assert [x.tolist() for x in np.split(ids, ends[:-1])] == [whole.encode(t, add_special_tokens=False).ids for t in texts]
    ids, ends = encoder(bodies.slice(2, 3))
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == [whole.encode(t, add_special_tokens=False).ids for t in texts[2:5]]


def test_other_tokenizers_take_whole_texts():
    import public_tokenizers

    assert isinstance(encoder_of(tokenizer_path()), WordEncoder)
    assert isinstance(encoder_of(public_tokenizers.path("byte_bpe_50k.json")), TextEncoder)


@pytest.mark.parametrize("tokenizer", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_pieces_against_the_tokenizer(spark, tokenizer):
    whole = Tokenizer.from_file(tokenizer_path(tokenizer))
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice(["Tree", "house,", "ñu", "X1", "don't", "\n", "--"]) for _ in range(n)) for n in (0, 1, 5, 63, 64, 65, 200)] + [None]
    rows = pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), capacity=64, tokenizer=tokenizer).collect()
    check_packed(rows, 64)
    got = {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows}
    want = {}
    for i, t in enumerate(texts):
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for k, at in enumerate(range(0, len(ids), 64)):
            want[i, k] = (at, len(ids[at : at + 64]), zlib.crc32(ids[at : at + 64].tobytes()))
    assert got == want and len(rows) == len(want)
    assert rows[0]["n_sequences"] == len({r["sequence_id"] for r in rows}) >= rows[0]["least_sequences"]


def check_packed(rows, capacity):
    by_sequence = collections.defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


def test_packing_remembers_words_that_come_again(monkeypatch):
    """Words of every text are encoded once, however many rare words come between them; ids are those of the tokenizer."""
    from flowspark.llm import packing

    monkeypatch.setattr(packing, "CACHE_WORDS", 400)
    encoder, asked = WordEncoder(tokenizer_path()), []
    for name in ("encoded", "new_cores"):
        kept = getattr(encoder, name)
        monkeypatch.setattr(encoder, name, lambda words, *a, kept=kept, **b: (asked.extend(words), kept(words, *a, **b))[1])
    letters = "abcdefghijklmnopqrstuvwxyz"
    rare = [f"{letters[i // 26]}q{letters[i % 26]}x" for i in range(600)]
    texts = [" ".join(["Again", "again,", "naïve;", "42%", *rare[at : at + 60], "ÉTÉ."]) for at in range(0, 600, 60)]
    for text in texts:
        ids, _ = encoder(pa.array([text.encode()], pa.binary()))
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert [asked.count(w) for w in ("again", rare[0], rare[-1], "42%")] == [1, 1, 1, 1]
    assert len(encoder.cores.young) + len(encoder.cores.old) <= 400


def test_packing_edge_cases(awkward, empty):
    rows = pack(awkward, capacity=64).collect()
    n = check_packed(rows, 64)
    assert n <= -(-sum(r["length"] for r in rows) // 64) + 1
    assert sum(r["length"] == 1 for r in rows if r["doc_id"] in (3, 4, 5)) == 3
    assert pack(empty).count() == 0


def test_zip_directories():
    members = [("a/b.bin", b"x" * 1000), ("empty", b""), ("ñ.txt", bytes(range(256)))]
    for zip64 in (False, True):
        body = warc.zip_bytes(members, zip64)
        assert zipfile.ZipFile(io.BytesIO(body)).testzip() is None
        read = lambda at, n, body=body: body[at : at + n]
        found = warc.read_directory(read, len(body))
        assert {n: read(warc.data_offset(read, m), m.size) for n, m in found.items()} == dict(members)
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        z.writestr("x", b"abc")
        z.comment = b"PK\x05\x06 not the end"
        with z.open("y", "w", force_zip64=True) as f:
            f.write(b"def")
    body = held.getvalue()
    read = lambda at, n: body[at : at + n]
    found = warc.read_directory(read, len(body))
    assert read(warc.data_offset(read, found["y"]), 3) == b"def"
    with pytest.raises(ValueError):
        warc.read_directory(lambda at, n: b"nothing", 7)


@pytest.mark.parametrize("zip64", [False, True])
def test_archives(spark, tmp_path, zip64):
    same, tiny = "<p>" + "s" * 200 + "</p>", "<p>t</p>"
    rows = [(3, "http://a/ x", same), (1, "http://b", same), (2, None, same), (4, "u\r\nv", tiny), (5, "u", tiny), (6, "u", None), (7, "u", ""), (None, "u", same), (8, "ü", "ñ" * 60), (8, "ü", "ñ" * 60), (9, "z", "\r\n\r\n" * 40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("x"))
    archives = warc.write_archives(warc.classified(pages), f"file://{tmp_path}/w", zip64, archive_bytes=500)
    assert archives.count() > 1
    got = collections.Counter(map(tuple, warc.read_archives(archives, 300).collect()))
    want = collections.Counter()
    for page, _, html in rows:
        body = (html or "").encode()
        revisit = html == same and page != 1
        want[page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", 1 if revisit else None] += 1
    assert got == want
    assert warc.read_archives(warc.write_archives(warc.classified(pages.limit(0)), f"file://{tmp_path}/e")).count() == 0


def brute_near(rows, size, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        n = min(size, len(w))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def near_corpus(rnd, families, copies, edits):
    rows = []
    for f in range(families):
        base = [f"f{f}w{i}" for i in range(rnd.randint(40, 160))]
        for _ in range(copies):
            text = list(base)
            for _ in range(rnd.randint(0, edits)):
                text[rnd.randrange(len(text))] = f"e{rnd.randrange(1000)}"
            rows.append((len(rows), " ".join(text)))
    return rows + [(900, "one"), (901, "One"), (902, "one two"), (903, ""), (904, None), (905, " \n"), (906, "one two three")]


@pytest.mark.parametrize(("words_", "percent", "rows_", "bands"), [(3, 85, 5, 30), (5, 80, 4, 37)])
def test_near_copies_against_brute_force(spark, words_, percent, rows_, bands):
    rows = near_corpus(random.Random(7), 12, 20, 4)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n"], r["component"]) for r in near_copies(docs, words=words_, percent=percent, rows=rows_, bands=bands).collect()}
    assert got == brute_near(rows, words_, percent)


def test_sketches_tell_similarity():
    rng = np.random.default_rng(5)
    sketcher, limit = Sketcher(), odd_limit(150, 85)
    ones = lambda a, b: sum(int(x).bit_count() for x in (a[:4] ^ b[:4]).view(np.uint64))
    base = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    near, far = base.copy(), base.copy()
    near[:160] = rng.integers(0, 1 << 63, 160, dtype=np.uint64)
    far[:1400] = rng.integers(0, 1 << 63, 1400, dtype=np.uint64)
    a, b, c = (sketcher(np.unique(x))[0] for x in (base, near, far))
    assert ones(a, b) <= limit < ones(a, c)
    one, two, same, other = Shingler()(pa.array([b"a b", b"A b c d", b"A b  c", b"a B c\n"], pa.binary()))
    assert len(one) == 1 and len(two) == 2 and (same == other).all()


def test_near_copies_of_equal_ids(spark):
    """An id with several texts is one document that is linked by each of them; every row gets a result."""
    a, b = [f"a{i}" for i in range(60)], [f"b{i}" for i in range(60)]
    rows = [(5, a), (5, b), (7, [*a[:-1], "x"]), (9, [*b[:-1], "x"]), (11, [f"c{i}" for i in range(60)]), (None, a), (5, a)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["n"], r["component"]) for r in near_copies(docs).collect()), key=str)
    assert got == sorted([(5, 58, 5), (5, 58, 5), (5, 58, 5), (7, 58, 5), (9, 58, 5), (11, 58, 11), (None, 58, None)], key=str)


def test_rows_of_an_id_that_is_not_the_least(spark):
    """A repeated id has one component over all of its texts, but each row stays or goes by its own text."""
    rnd = random.Random(3)
    families = [[f"f{k}x{i}" for i in range(60)] for k in range(8)]
    rows = []
    for _ in range(60):
        words_ = list(rnd.choice(families))
        for _ in range(rnd.randrange(3)):
            words_[rnd.randrange(60)] = f"n{rnd.randrange(9)}"
        rows.append((rnd.randrange(25), " ".join(words_)))
    rows += [(1, "a b c d e f"), (7, "a b c d e f"), (7, "wholly other words that match nothing here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    shingles = [{tuple(t.split()[i : i + 3]) for i in range(len(t.split()) - 2)} for _, t in rows]
    alike = lambda a, b: 100 * len(a & b) >= 85 * len(a | b)

    def least(same):
        lead = [i for i, _ in rows]
        while True:
            new = [min(lead[y] for y in range(len(rows)) if same(x, y)) for x in range(len(rows))]
            if new == lead:
                return lead
            lead = new

    links = [[alike(a, b) for b in shingles] for a in shingles]
    lead, component = least(lambda x, y: links[x][y]), least(lambda x, y: links[x][y] or rows[x][0] == rows[y][0])
    got = near_copies(docs).collect()
    assert sorted((r["doc_id"], r["lead"], r["component"]) for r in got) == sorted((i, a, c) for (i, _), a, c in zip(rows, lead, component, strict=True))
    kept = sorted((r["doc_id"], r["text"]) for r in drop_near_copies(docs).collect())
    assert kept == sorted(r for r, a in zip(rows, lead, strict=True) if r[0] == a) and (7, rows[-1][1]) in kept


STAGES = {
    "toxicity": lambda docs, labels: reject_toxic(docs, labels),
    "line_dedup": lambda docs, labels: drop_repeated_lines(docs),
    "near_dedup": lambda docs, labels: drop_near_copies(docs),
    "mixing": lambda docs, labels: mix(docs),
    "quality": lambda docs, labels: quality_filter(docs),
    "packing": lambda docs, labels: pack(docs, capacity=64),
    "media": lambda docs, labels: media.media_columns(docs)[0],
    "scores": lambda docs, labels: hmm.scored(docs, head_size=20),
}


@pytest.mark.parametrize("name", sorted(STAGES))
def test_columns_with_clashing_names(spark, name):
    """Extra columns may have the names that operators use within, and backticks, dots and spaces."""
    names = ["_gone", "_mix_words", "_mix_copy", "tox_score", "_tox_text", "score", "spans", "doc", "row", "words", "copies", "copy", "class", "salt", "rank", "mark", "line_no", "id", "key", "body",
             "n", "component", "_row", "_text", "_removed", "a `b` c", "x.y", "length", "piece", "sequence_id", "bits", "codes", "first", "n_words"]
    rows = [(i, " ".join(f"w{(i * 7 + k) % 90}" for k in range(40)), "en", "s", *[f"{c}{i}" for c in names]) for i in range(12)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", *names])
    if name in ("line_dedup", "near_dedup", "mixing", "media"):  # ids of any type
        named = docs.withColumn("doc_id", F.concat(F.lit("id-"), F.col("doc_id").cast("string")))
        found = {r["doc_id"] for r in STAGES[name](named, None).select("doc_id").collect()}
        assert found and found <= {f"id-{i}" for i in range(12)}
    labels = spark.createDataFrame([(i, int(i % 2)) for i in range(12)], "doc_id long, toxic int")
    got = STAGES[name](docs, labels)
    if name in ("packing", "media", "scores"):
        assert {r["doc_id"] for r in got.collect()} == set(range(12))
        return
    assert got.columns == docs.columns
    for r in got.collect():
        assert [r[docs.columns.index(c)] for c in names] == [f"{c}{r['doc_id']}" for c in names]


def test_near_copies_edge_cases(awkward, empty):
    kept = drop_near_copies(awkward)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [(False, 1), (False, 1), (False, 3), (False, 4), (False, 5), (False, 6), (False, 7), (True, 0)]
    assert kept.columns == awkward.columns and drop_near_copies(empty).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    rnd = random.Random(11)
    clean = [(i, "\n".join(" ".join(f"t{rnd.randrange(5000)}" for _ in range(25)) for _ in range(4)), "en", "ab"[i % 2], 0) for i in range(60)]
    passage = words(0, 60)
    rows = clean + [(100, clean[0][1], "en", "a", 0), (101, clean[1][1].replace("t1", "x1", 1), "en", "a", 0), (102, f"{passage}\nfirst unique line here now ok", "en", "b", 0), (103, f"{passage}\nother special line there then fine", "en", "b", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    seen, frames = {}, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        frames[name] = docs.toPandas()
        seen[name] = dict(zip(frames[name]["doc_id"], frames[name]["text"], strict=True))
    assert set(range(60)) <= seen["toxicity"].keys() and set(range(60)) <= seen["near_dedup"].keys()
    assert 100 not in seen["line_dedup"] and passage in seen["line_dedup"][102] and passage not in seen["line_dedup"][103]
    assert all(seen["line_dedup"][i] == t for i, t, *_ in clean)

    # Each stage against a plain version of it, on what the stage before kept.
    gone = brute_lines(list(seen["toxicity"].items()))
    left = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in seen["toxicity"].items()}
    assert seen["line_dedup"] == {i: t for i, t in left.items() if t.split()}
    kept = {i for i, (_, root) in brute_near(list(seen["line_dedup"].items()), 5, 80).items() if root == i}
    assert seen["near_dedup"].keys() == kept
    duck = duckdb.connect()
    duck.register("documents", frames["near_dedup"])
    copies = {r[0]: r[1] for r in duck.sql(f"SELECT doc_id, copies FROM ({OP9_SQL})").fetchall()}
    assert collections.Counter(frames["mixing"]["doc_id"].tolist()) == collections.Counter({i: n for i, n in copies.items() if n})
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert rows and check_packed(rows, 4096) == 1 + sum(r["length"] for r in rows) // 4096
    whole = Tokenizer.from_file(tokenizer_path())
    want = collections.Counter()
    for i, t in zip(frames["mixing"]["doc_id"].tolist(), frames["mixing"]["text"], strict=True):
        ids = np.array([*whole.encode(t, add_special_tokens=False).ids, 1], dtype="<u4")
        want.update((i, k, zlib.crc32(ids[at : at + 4096].tobytes())) for k, at in enumerate(range(0, len(ids), 4096)))
    assert collections.Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in rows) == want
