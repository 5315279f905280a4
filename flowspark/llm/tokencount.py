"""Exact token counts at every prefix of a text, for byte-level BPE tokenizers, by dynamic programming.

BPE splits a piece of text so that its tokens are a valid encoding exactly if each two neighbours are (merged from their bytes they stay
apart). So the tokens of a prefix are those of a shorter prefix and one token more: of all tokens that end there, the one that stays apart
from the last token of the prefix before it. That gives a count for each prefix of a piece from the counts before. Pieces are found for all texts
of a group together, from classes of characters; each distinct piece is worked out once, and a text's counts are those of its pieces
added up. The count of a prefix is that of the prefix as a text of its own: white space at its end is one piece, and a special token
that is cut is ordinary text. What is stored answers how many tokens the first n characters have, or how many characters fit into a
budget, without encoding again; counts don't always grow, as one more character can join tokens.

Defined cases: null and empty texts have no tokens; rows stay rows, whatever their ids (null, repeated, of any type); very long texts are counted whole,
in parts that end before white space; an empty table gives an empty table; only the id and the text are read, so other columns may have any names.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import groups, of_worker, table

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512
#: Bytes of text that are worked on together, pieces and pairs of tokens that a worker remembers.
PART_BYTES, PIECES, PAIRS = 2_000_000, 200_000, 1_000_000
OTHER, LETTER, NUMBER, SPACE = range(4)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_names() -> dict[str, int]:
    """The characters that stand for bytes in vocabularies: printable ones for themselves, all others, in order, from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Kinds:
    """The class of each character, as the library's splitter has it; found when a character is first seen."""

    def __init__(self):
        from tokenizers import pre_tokenizers

        self.split = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
        self.known = np.full(0x110000, -1, dtype=np.int8)

    def kind(self, character: str) -> int:
        """It makes one piece with others of its class."""
        return next((kind for one, kind in (("a", LETTER), ("1", NUMBER), ("-", OTHER)) if len(self.split(one + character)) == 1), SPACE)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        kinds = self.known[points]
        if (kinds < 0).any():
            for p in np.unique(points[kinds < 0]).tolist():
                self.known[p] = self.kind(chr(p))
            kinds = self.known[points]
        return kinds


class Vocabulary:
    """Tokens by their bytes, how each was merged, and the special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        model, pre = told["model"], told["pre_tokenizer"] or {}
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and told["normalizer"] is None
        if model["type"] != "BPE" or not plain or model.get("dropout") or model.get("ignore_merges") or any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in told["added_tokens"]):
            raise ValueError("only plain byte-level BPE tokenizers are known here")
        names = byte_names()
        ids = model["vocab"]
        self.specials = sorted((a["content"].encode() for a in told["added_tokens"]), key=len, reverse=True)
        self.left, self.right, self.made = ([-1] * (max(ids.values()) + 1) for _ in range(3))
        self.rank: dict[tuple[int, int], int] = {}
        for r, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            t = ids[a + b]
            self.rank[ids[a], ids[b]] = r
            self.left[t], self.right[t], self.made[t] = ids[a], ids[b], r
        special = {s.decode() for s in self.specials}
        whole = [True] * len(self.made)
        for t in sorted((t for s, t in ids.items() if s not in special), key=self.made.__getitem__):
            if self.made[t] >= 0:  # its own bytes come back as this token
                a, b = self.left[t], self.right[t]
                whole[t] = whole[a] and whole[b] and self.apart(a, b, self.made[t])
        self.tokens = {bytes(names[c] for c in s): t for s, t in ids.items() if s not in special and whole[t]}

    def apart(self, a: int, b: int, before: float = float("inf")) -> bool:
        """Whether tokens a and b, side by side, aren't merged across their border by any merge of a rank below `before`.

        The merges that made the two sides are undone from the last one on; equal merges are made from left to right.
        """
        while True:
            if self.rank.get((a, b), before) < before:
                return False
            if self.made[a] > self.made[b]:
                before, a = self.made[a], self.right[a]
            elif self.made[b] >= 0:
                before, b = self.made[b] + 0.5, self.left[b]
            else:
                return True


class PrefixCounter:
    """Token counts of all prefixes of texts."""

    def __init__(self, path: str):
        import ahocorasick

        self.vocabulary = Vocabulary(path)
        self.ends = ahocorasick.Automaton()  # over bytes, each as one character
        for token, t in self.vocabulary.tokens.items():
            self.ends.add_word(token.decode("latin-1"), (len(token), t))
        self.ends.make_automaton()
        self.kinds = Kinds()
        self.special = re.compile(b"|".join(map(re.escape, self.vocabulary.specials))) if self.vocabulary.specials else None
        self.pieces: dict[bytes, tuple[int, bytes]] = {}
        self.pairs: dict[int, bool] = {}

    def at_bytes(self, piece: bytes) -> list[int]:
        """The tokens of each prefix of a piece, by bytes, from the empty one on."""
        pairs, apart = self.pairs, self.vocabulary.apart
        counts, last, done = [0] * (len(piece) + 1), [0] * (len(piece) + 1), 0
        for end, (size, t) in self.ends.iter(piece.decode("latin-1")):  # all tokens by their ends, the longest first
            if end < done:
                continue
            if j := end + 1 - size:
                pair = last[j] << 32 | t
                if (ok := pairs.get(pair)) is None:
                    if len(pairs) >= PAIRS:
                        pairs.clear()
                    ok = pairs[pair] = apart(last[j], t)
                if not ok:
                    continue
            done = end + 1
            counts[done], last[done] = counts[j] + 1, t
        return counts

    def of_piece(self, piece: bytes) -> tuple[int, bytes]:
        """Its tokens, and those of its prefixes by characters (32-bit numbers)."""
        if (known := self.pieces.get(piece)) is not None:
            return known
        counts = self.at_bytes(piece)
        if piece.isascii():
            inner = counts[1:]
        else:
            inner = [counts[i] for i in range(1, len(piece)) if piece[i] & 0xC0 != 0x80] + counts[-1:]
        if len(piece) == 3 and piece[:1] == b"'" and piece[1:].isalpha():  # 're 've 'll: while the last letter is missing, two pieces
            inner[1] = self.at_bytes(piece[:1])[-1] + self.at_bytes(piece[1:2])[-1]
        if len(self.pieces) >= PIECES:
            self.pieces.clear()
        known = self.pieces[piece] = inner[-1], array("i", inner).tobytes()
        return known

    def begins(self, points: np.ndarray, kinds: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """Where pieces begin. points: characters of all parts; heads: where parts begin."""
        n = len(points)
        run = heads.copy()
        run[1:] |= kinds[1:] != kinds[:-1]
        begin = run.copy()
        after = np.flatnonzero(run & ~heads & (kinds != SPACE))
        after = after[kinds[after - 1] == SPACE]  # the last of the white space stands alone or, if it is a blank, with what follows
        begin[after - 1] = True
        begin[after[points[after - 1] == 32]] = False
        # 's 't 'm 'd 're 've 'll, where the apostrophe begins a piece and stands alone
        quote = np.flatnonzero(begin & run & (points == 39))
        quote = quote[quote + 1 < n]
        quote = quote[(kinds[quote + 1] == LETTER) & ~heads[quote + 1]]
        one = points[quote + 1]
        two = np.where((quote + 2 < n) & ~heads[np.minimum(quote + 2, n - 1)], points[np.minimum(quote + 2, n - 1)], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        begin[quote[short | long] + 1] = False
        upto = np.concatenate([quote[short] + 2, quote[long] + 3])
        begin[upto[upto < n]] = True
        return begin

    def coded(self, pieces: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of some pieces: their numbers, and by number the tokens, where its prefixes' counts begin, and these counts."""
        found = pieces.dictionary_encode()
        told = [self.of_piece(p) for p in found.dictionary.to_pylist()]
        inner = np.frombuffer(b"".join(t[1] for t in told), dtype=np.int32)
        sizes = np.fromiter((len(t[1]) // 4 for t in told), dtype=np.int64, count=len(told))
        return found.indices.to_numpy(zero_copy_only=False), np.fromiter((t[0] for t in told), dtype=np.int64, count=len(told)), np.cumsum(sizes) - sizes, inner

    def of_parts(self, parts: list[bytes]) -> list[np.ndarray]:
        """The counts of all prefixes of each part, by characters."""
        body = b"".join(parts)
        if not body:
            return [np.zeros(0, dtype=np.int64) for _ in parts]
        points = np.frombuffer(body.decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        n = len(points)
        first = np.flatnonzero((np.frombuffer(body, dtype=np.uint8) & 0xC0) != 0x80)  # the first byte of each character
        sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        starts = np.searchsorted(first, np.cumsum(sizes) - sizes)  # characters before each part
        heads = np.zeros(n, dtype=bool)
        heads[starts[sizes > 0]] = True
        kinds = self.kinds(points)
        begin = np.flatnonzero(self.begins(points, kinds, heads))
        offsets = np.append(first[begin], len(body)).astype(np.int32)
        codes, tokens, inside, inner = self.coded(pa.BinaryArray.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(body)]))
        lengths = np.diff(np.append(begin, n))
        full = tokens[codes]
        before = np.cumsum(full) - full
        owner = np.searchsorted(begin, starts[sizes > 0])
        before -= np.repeat(before[owner], np.diff(np.append(owner, len(begin))))
        counts = np.repeat(before, lengths) + inner[np.arange(n) + np.repeat(inside[codes] - begin, lengths)]
        # A prefix that ends with white space of two characters or more: one piece.
        space = kinds == SPACE
        from_, upto = np.flatnonzero(space & np.append(True, ~space[:-1] | heads[1:])), np.flatnonzero(space & np.append(~space[1:] | heads[1:], True))
        wide = upto > from_
        from_, upto = from_[wide], upto[wide]
        if len(from_):
            ends = np.append(first, len(body))
            edges = np.stack([ends[from_], ends[upto + 1]], axis=1).ravel().astype(np.int32)
            runs = pa.BinaryArray.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(body)])
            codes, tokens, _, _ = self.coded(runs.take(pa.array(np.arange(0, len(edges) - 1, 2))))
            counts[upto] = before[np.searchsorted(begin, from_)] + tokens[codes]
        return np.split(counts, starts[1:])

    def cut(self, text: bytes) -> list[tuple[bytes, int]]:
        """A text's parts and, for one before a special token, how many bytes at its end are that token without its last character."""
        parts, at = [], 0
        for m in self.special.finditer(text) if self.special else ():
            tail = m[0].decode()[:-1].encode()
            parts.append((text[at : m.start()] + tail, len(tail)))
            at = m.end()
        parts.append((text[at:], 0))
        out, safe = [], re.compile(rb"(?<=[^\x00-\x20\x7f-\xff])[ \n]")  # white space after what isn't
        for part, tail in parts:
            at = 0
            while len(part) - at > PART_BYTES and (m := safe.search(part, at + PART_BYTES)) and m.start() < len(part) - tail:
                out.append((part[at : m.start()], -1))
                at = m.start()
            out.append((part[at:], tail))
        return out

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        """The counts of all prefixes of each text, by characters."""
        special = {i: self.cut(t) for i, t in enumerate(texts) if len(t) > PART_BYTES or self.special and self.special.search(t)}
        out = self.of_parts([b"" if i in special else t for i, t in enumerate(texts)])
        for i, parts in special.items():
            base, counts = 0, []
            for part, tail in parts:
                (own,) = self.of_parts([part])
                counts.append(own + base)
                if tail > 0:
                    size = len(own) - len(part[len(part) - tail :].decode())
                    base += (int(own[size - 1]) if size else 0) + 1
                    counts.append(np.asarray([base]))
                elif len(own):
                    base += int(own[-1])
            out[i] = np.concatenate(counts)
        return out


def token_prefixes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, n_bytes, n_chars, n_tokens, steps: one row for each row of docs.

    steps: for each prefix, by characters, how many tokens more (or less) it has than the one before, as 16-bit numbers, lowest byte first.
    """
    named = lambda c: F.col("`" + c.replace("`", "``") + "`")
    chosen = docs.select(named(doc_id).alias("doc_id"), F.coalesce(named(text), F.lit("")).cast("binary").alias("text"))
    kind = chosen.schema["doc_id"].dataType
    out = pa.schema([("doc_id", to_arrow_type(kind)), ("n_bytes", pa.int64()), ("n_chars", pa.int64()), ("n_tokens", pa.int64()), ("steps", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer_path(tokenizer)
        with of_worker(("prefix-counter", path), lambda: PrefixCounter(path)) as counter:
            for whole in batches:
                for batch in groups(whole, 1, PART_BYTES):
                    counts = counter(batch.column(1).to_pylist())
                    steps = [np.diff(c, prepend=0).astype("<i2").tobytes() for c in counts]
                    totals = [int(c[-1]) if len(c) else 0 for c in counts]
                    sizes = [pa.array(x, pa.int64()) for x in ([len(t.as_py()) for t in batch.column(1)], list(map(len, counts)), totals)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).cast(out.field(0).type), *sizes, pa.array(steps, pa.binary())], schema=out)

    return chosen.mapInArrow(run, f"doc_id {kind.simpleString()}, n_bytes bigint, n_chars bigint, n_tokens bigint, steps binary")


def tokens_of(steps: bytes, chars: int) -> int:
    """Tokens of the first so many characters."""
    return int(np.frombuffer(steps, dtype="<i2")[: max(0, chars)].sum(dtype=np.int64))


def longest_within(steps: bytes, budget: int) -> int:
    """Characters of the longest prefix that has at most so many tokens."""
    fits = np.flatnonzero(np.cumsum(np.frombuffer(steps, dtype="<i2"), dtype=np.int64) <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def with_cut(counted: DataFrame, budget: int = LIMIT, out: str = "fit_chars") -> DataFrame:
    """What token_prefixes gave, with the characters of the longest prefix within the budget instead of steps."""
    kept = [c for c in counted.columns if c != "steps"]
    schema = ", ".join(f"`{c}` {counted.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = pa.array([longest_within(s.as_py(), budget) for s in batch.column("steps")], pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], cuts], names=[*kept, out])

    return counted.mapInArrow(run, f"{schema}, `{out}` bigint")


def op11_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = with_cut(token_prefixes(table(spark, sf_dir, "documents")))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), "fit_chars")
