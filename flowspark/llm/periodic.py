"""Runs (maximal periodic stretches) of a text's words, by longest previous factors, and texts without their repetitions.

A run is a stretch of consecutive words with smallest period q that holds at least two periods and MIN_WORDS words and that no neighbouring
word extends. The texts of a group are worked on together, as one sequence of words in which each text has words of its own:

* a suffix array by doubling: suffixes are ranked by 1, 2, 4, ... words, and only those that are not yet alone are sorted again; the ranks of
  all rounds are kept, as they tell how far two places agree, forwards and backwards, in one look for each power of two;
* LCP of neighbours in the array; the longest previous factor at each place (LPF) from its neighbours in the array that stand earlier in the text;
* Lempel-Ziv blocks: from its begin, a block is as long as its previous factor, or one new word;
* runs that touch the border of two blocks (Main): a period there is less than both blocks together, so each such period is tried at
  the border: how far the words agree with those one period on, to both sides;
* runs inside a block: copied, by their begins, from the block's earlier occurrence, where they were found before.

A text in which no six words occur twice has no run of twelve words (its second half would be an earlier factor) and ends there.

Defined cases: null and empty texts have no words and no runs; rows stay rows, whatever their ids (null, repeated, of any type); very long
texts are worked on whole (memory grows with their words and the logarithm of their longest repeat); an empty table gives an empty table; only the id and the text are read, so other columns may
have any names.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import WORD, coded_words, groups, table

MIN_WORDS = 12
#: Bytes of text that are worked on together.
PART_BYTES = 2_000_000
Run = tuple[int, int, int]  # start, length, period


def repeated(codes: np.ndarray, owner: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """The owners (texts) in which some `size` words in a row occur twice, by hashes: a few others may be among them."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    h = np.zeros(n, dtype=np.uint64)
    words = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(size):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + words[k : k + n]
    inside = owner[:n] == owner[size - 1 :]
    of = owner[:n][inside]
    h = (h[inside] ^ (h[inside] >> np.uint64(32))) * np.uint64(0x94D049BB133111EB) + of.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    order = np.argsort(h)
    return np.unique(of[order[1:][h[order[1:]] == h[order[:-1]]]])


class Suffixes:
    """The suffixes of some texts in order, and how far places agree. Texts share no words, so that no agreement goes beyond a text."""

    def __init__(self, words: np.ndarray):
        """words: numbers from 0, each used in one text only."""
        n = self.n = len(words)
        self.array = np.argsort(words, kind="stable")
        first = np.empty(n, dtype=np.int32)  # a suffix's rank: the first place of those that agree so far
        in_order = words[self.array]
        new = np.append(True, in_order[1:] != in_order[:-1])
        first[self.array] = np.flatnonzero(new)[np.cumsum(new) - 1]
        self.ranks = [first]
        step = 1
        alone = new & np.append(new[1:], True)
        active = np.flatnonzero(~alone)  # places in the array
        while len(active):
            rank = self.ranks[-1]
            at = self.array[active]
            ahead = np.where(at + step < n, rank[np.minimum(at + step, n - 1)].astype(np.int64) + 1, 0)
            key = rank[at].astype(np.int64) * (n + 1) + ahead
            order = np.argsort(key, kind="stable")
            at, key = at[order], key[order]
            self.array[active] = at
            new = np.append(True, key[1:] != key[:-1])
            rank = rank.copy()
            rank[at] = active[np.flatnonzero(new)[np.cumsum(new) - 1]]
            self.ranks.append(rank)
            active = active[~(new & np.append(new[1:], True))]
            step *= 2

    def agree(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a on are those from b on; a and b differ."""
        a, b = a.copy(), b.copy()
        out = np.zeros(len(a), dtype=np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank, n = self.ranks[k], self.n - 1
            same = (a <= n) & (b <= n) & (rank[np.minimum(a, n)] == rank[np.minimum(b, n)])
            step = same.astype(np.int64) << k
            out += step
            a += step
            b += step
        return out

    def agree_back(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before a are those before b; a and b differ."""
        a, b = a.copy(), b.copy()
        out = np.zeros(len(a), dtype=np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank, size = self.ranks[k], 1 << k
            same = (a >= size) & (b >= size) & (rank[np.maximum(a - size, 0)] == rank[np.maximum(b - size, 0)])
            step = same.astype(np.int64) << k
            out += step
            a -= step
            b -= step
        return out

    def previous(self) -> tuple[np.ndarray, np.ndarray]:
        """For each place, the longest previous factor and where it begins (-1 if there is none)."""
        n, array = self.n, self.array
        lcp = np.zeros(n, dtype=np.int64)
        lcp[1:] = self.agree(array[:-1], array[1:])
        best, source = np.zeros(n, dtype=np.int64), np.full(n, -1, dtype=np.int64)
        for back in (True, False):
            # The nearest neighbour in the array that stands earlier in the text, by jumps along what is known; least: the least LCP on the way.
            order = array if back else array[::-1]
            least = lcp.copy() if back else np.append(0, lcp[:0:-1])
            to = np.arange(n) - 1
            open_ = np.flatnonzero(least > 0)
            to[least == 0] = -1
            while len(open_):
                open_ = open_[order[to[open_]] > order[open_]]
                via = to[open_]
                far, low = to[via].copy(), np.minimum(least[open_], least[via])
                ends = (far < 0) | (low == 0)
                to[open_] = np.where(ends, -1, far)
                least[open_] = np.where(ends, 0, low)
                open_ = open_[~ends]
            found = np.flatnonzero(to >= 0)
            longer = found[least[found] > best[order[found]]]
            best[order[longer]] = least[longer]
            source[order[longer]] = order[to[longer]]
        return best, source


def blocks(longest: list[int], begin: int, end: int) -> list[int]:
    """Where the Lempel-Ziv blocks of the text from begin to end begin."""
    out = []
    while begin < end:
        out.append(begin)
        begin += longest[begin] or 1
    return out


def across(suffixes: Suffixes, words: np.ndarray, borders: np.ndarray, before: np.ndarray, after: np.ndarray, least: int) -> np.ndarray:
    """Runs (start, end, period) that touch a border; before and after: the sizes of the blocks on its sides.

    Either the words from the border on agree with those a period on, or those before it with those a period back, far enough to make two periods.
    """
    most = np.maximum(before + after - 1, 0)
    keep = most > 0
    border = np.repeat(borders[keep], most[keep])
    period = np.arange(len(border)) - np.repeat(np.cumsum(most[keep]) - most[keep], most[keep]) + 1
    found = []
    for a, b in ((border, border + period), (border - period, border)):
        some = (a >= 0) & (b <= len(words))
        a, b, p = a[some], b[some], period[some]
        at = lambda i: words[np.clip(i, 0, len(words) - 1)]
        some = ((b < len(words)) & (at(a) == at(b))) | ((a > 0) & (at(a - 1) == at(b - 1)))
        a, b, p = a[some], b[some], p[some]
        left, right = suffixes.agree_back(a, b), suffixes.agree(a, b)
        some = (left + right >= p) & (left + right + p >= least)
        found.append(np.stack([a[some] - left[some], b[some] + right[some], p[some]], axis=1))
    return np.concatenate(found)


def runs_of(codes: np.ndarray, ends: np.ndarray, least: int = MIN_WORDS) -> list[list[Run]]:
    """The runs of each text, by start and period. codes: the numbers of all texts' words; ends: where each text's words end."""
    out: list[list[Run]] = [[] for _ in ends]
    starts = np.append(0, ends[:-1])
    owner = np.repeat(np.arange(len(ends)), ends - starts)
    some = repeated(codes, owner, starts, max(1, least // 2))
    if not len(some):
        return out
    chosen = np.zeros(len(ends), dtype=bool)
    chosen[some] = True
    taken = chosen[owner]
    sizes = (ends - starts)[some]
    own = np.cumsum(sizes) - sizes
    keys = np.repeat(np.arange(len(some)), sizes) * (int(codes.max()) + 1) + codes[taken]
    words = np.unique(keys, return_inverse=True)[1].reshape(-1)
    suffixes = Suffixes(words)
    longest, source = suffixes.previous()
    listed, earlier = longest.tolist(), source
    begins = [blocks(listed, b, b + s) for b, s in zip(own.tolist(), sizes.tolist(), strict=True)]
    border = np.fromiter((x for bs, b, s in zip(begins, own, sizes, strict=True) for x in [*bs, b + s]), dtype=np.int64)
    each = np.fromiter((len(bs) + 1 for bs in begins), dtype=np.int64, count=len(begins))
    size = np.diff(border, append=border[-1])
    last = np.cumsum(each) - 1
    size[last] = 0
    before = np.append(0, size[:-1])  # a text's first border has nothing before it: the size at the end of the text before is 0
    found = across(suffixes, words, border, before, size, least)
    # Of equal stretches, the smallest period.
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    if len(found):
        found = found[np.append(True, (found[1:, :2] != found[:-1, :2]).any(axis=1))]
    cut = np.searchsorted(found[:, 0], [*own.tolist(), len(words)])
    for i, (k, b, bs) in enumerate(zip(some.tolist(), own.tolist(), begins, strict=True)):
        runs = [tuple(r) for r in found[cut[i] : cut[i + 1]].tolist()]
        if runs:
            out[k] = [(s - b, e - s, p) for s, e, p in sorted(with_copies(runs, bs, b + int(sizes[i]), earlier, least), key=lambda r: (r[0], r[2]))]
    return out


def with_copies(runs: list[Run], begins: list[int], end: int, earlier: np.ndarray, least: int) -> list[Run]:
    """Runs (start, end, period) that touch borders, and those inside blocks, which are copies of runs in the block's earlier occurrence."""
    kept = sorted(runs)
    for begin, upto in zip(begins, [*begins[1:], end], strict=True):
        shift = begin - int(earlier[begin])
        if upto - begin <= least or earlier[begin] < 0:
            continue
        i = bisect.bisect_right(kept, (begin - shift, end, 0))
        while i < len(kept) and kept[i][0] < upto - shift:
            s, e, p = kept[i]
            if e < upto - shift:
                copy = s + shift, e + shift, p
                at = bisect.bisect_left(kept, copy)
                if at == len(kept) or kept[at] != copy:
                    kept.insert(at, copy)
            i += 1
    return kept


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words but those in a run after its first period, joined by blanks."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    stays = np.cumsum(gone[:-1]) == 0
    return b" ".join([words[i] for i in np.flatnonzero(stays).tolist()])


def word_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_words, runs (an array of struct(start, length, period), by start and period), collapsed: one row for each row of docs.

    collapsed: the text's words without those that a run repeats, joined by blanks.
    """
    named = lambda c: F.col("`" + c.replace("`", "``") + "`")
    chosen = docs.select(named(doc_id).alias("doc_id"), F.coalesce(named(text), F.lit("")).cast("binary").alias("text"))
    kind = chosen.schema["doc_id"].dataType
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    out = pa.schema([("doc_id", to_arrow_type(kind)), ("n_words", pa.int64()), ("runs", run_type), ("collapsed", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in groups(whole, 1, PART_BYTES):
                _, codes, ends = coded_words(batch.column(1))
                found = runs_of(codes, ends, least)
                rest = [collapsed(t.as_py().split(), r) for t, r in zip(batch.column(1), found, strict=True)]
                flat = np.asarray([r for rs in found for r in rs], dtype=np.int64).reshape(-1, 3)
                upto = np.cumsum([0, *map(len, found)]).astype(np.int32)
                structs = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], names=["start", "length", "period"])
                lists = pa.ListArray.from_arrays(pa.array(upto), structs).cast(run_type)
                yield pa.RecordBatch.from_arrays([batch.column(0).cast(out.field(0).type), pa.array(np.diff(ends, prepend=0), pa.int64()), lists, pa.array(rest, pa.binary()).cast(pa.string())], schema=out)

    return chosen.mapInArrow(run, f"doc_id {kind.simpleString()}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, or for each tenth document (by a hash of its id) its words with a period from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("words"), F.floor(h / 10).alias("g"))
    placed = chosen.withColumn("a", F.when(F.size("words") > 0, F.col("g") % F.size("words")))
    placed = placed.withColumn("p", 1 + F.floor((F.size("words") - F.col("a")) / (3 + F.col("g") % 8)))
    at = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")
    again = F.array_join(F.transform(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.get("words", at(i))), " ")
    return placed.select("doc_id", F.when(F.size("words") > 0, again).otherwise(F.col("text")).alias("text"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = word_runs(planted(table(spark, sf_dir, "documents")))
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    told = found.withColumns({"top": top, "lines": F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))})
    return told.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.start")).alias("start"),
        "top.length",
        (-F.col("top.period")).alias("period"),
        F.expr("1000 * top.length div -top.period").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
