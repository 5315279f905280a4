"""Best-fit packing of documents into sequences by bin completion.

Documents are tokenized and cut into pieces of at most `capacity` tokens. Only the number of pieces
of each length matters for packing, so the solver works on a histogram of at most `capacity`
counts, whatever the size of the corpus, and returns patterns: a filling and how many sequences have it.

The solver is bin completion with branch and bound. The first incumbent is best-fit decreasing.
Then the largest piece left is completed by undominated fillings, fullest first; a branch is cut when
its waste exceeds what a solution better than the incumbent may waste. What a few nodes leave is packed by best fit, as further
incumbents. Fillings are enumerated as they are needed and none is left out; the search ends at the lower bound, when nothing is left
to try, or after `steps` steps. The incumbent is returned, so every result is a whole packing; the rows tell its size and the bound.

Pieces are numbered within their length without gathering a length in one task, and each
number belongs to one place in one pattern.

Defined cases: a null text is an empty text, a document of one token (the end id); a null doc_id is kept;
repeated rows are documents of their own; an empty table gives an empty table; other columns are not used.
"""

from __future__ import annotations

import bisect
import json
import logging
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import coded_words, groups, of_worker, ranked, rows_at_a_time, spread, stash, table

CAPACITY = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
#: Letter sequences in a worker's memory, and four times the other words; those not met for longest are forgotten beyond.
CACHE_WORDS = 400_000
#: Bytes of text, and of them new words, that are encoded together; the tokenizer's objects take some hundred bytes a word.
TEXT_BYTES, WORDS_TOGETHER = 2_000_000, 16_384
#: Documents that a worker is sent at a time; both sides hold a batch beside their other memory.
BATCH_ROWS = 1000
#: Pieces of one length that are numbered together, about.
CELL = 100_000
#: Steps of the search, in nodes and in pieces tried for a filling.
STEPS = 400_000

#: The normalizers and splits of the tokenizer that can go word by word.
NORMALIZERS = [("NFC", None, None), ("Replace", {"Regex": "\\s+"}, " "), ("Lowercase", None, None)]
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPLITS = [("Split", {"Regex": WORD_PATTERN}, "Removed", True, None, None), ("ByteLevel", None, None, None, False, False)]


# --- pieces -----------------------------------------------------------------------------------


class Remembered:
    """Values of words, about `most` at a time. What is asked for again lives on; what isn't while half as many others come is forgotten."""

    def __init__(self, most: int):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.half = most // 2

    def of(self, words: list[str], make) -> list[bytes]:
        """The values of some distinct words; make gives those of a list of new ones."""
        if len(self.young) + len(words) > self.half:
            self.old, self.young = self.young, {}
        found = list(map(self.young.get, words))
        if missing := [w for w, v in zip(words, found, strict=True) if v is None]:
            kept = list(map(self.old.get, missing))
            self.young.update((w, v) for w, v in zip(missing, kept, strict=True) if v is not None)
            if new := [w for w, v in zip(missing, kept, strict=True) if v is None]:
                self.young.update(zip(new, make(new), strict=True))
            found = list(map(self.young.__getitem__, words))
        return found


def gathered(ids: list[bytes], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the words with these codes, one after the other, and the number of ids up to the end of each."""
    sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
    return repeated(np.frombuffer(b"".join(ids), dtype="<u4"), np.cumsum(sizes) - sizes, sizes, codes)


def repeated(ids: np.ndarray, first: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for words whose ids begin at `first`."""
    each = sizes[codes]
    upto = np.cumsum(each)
    at = np.arange(int(upto[-1]) if len(upto) else 0) + np.repeat(first[codes] - (upto - each), each)
    return ids[at], upto


class WordEncoder:
    """Ids of whole texts as little-endian 32-bit bytes.

    The tokenizer drops white space and never joins what white space parts, so that a text's ids are
    those of its space-separated parts. A part of letters and a run of punctuation has the ids of its
    lower-cased letters (its core), then of the run; cores, runs and other parts are remembered. New ones are encoded many at a time,
    parted by spaces. Cores of a to z need no normalizer and no split by patterns: a tokenizer with the same model goes
    from space to space, and a word's last token tells that it is one, as the model marks the ends of words.
    """

    #: Letters whose lower case is one precomposed letter in any implementation, then punctuation that the tokenizer keeps together.
    SIMPLE = r"^(?P<core>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<run>[.,;:!?*&%$#]*)$"
    PLAIN = re.compile("[a-z]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, end = spec["model"], spec["model"].get("end_of_word_suffix")
        self.bare = None
        if model.get("type") == "BPE" and end and not model.get("dropout") and all(c in model["vocab"] and c + end in model["vocab"] for c in "abcdefghijklmnopqrstuvwxyz"):
            self.bare = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": [], "post_processor": None}))
            self.ends = np.zeros(max(model["vocab"].values()) + 1, dtype=bool)
            self.ends[[i for token, i in model["vocab"].items() if token.endswith(end)]] = True
        self.cores, self.others = Remembered(CACHE_WORDS), Remembered(CACHE_WORDS // 4)

    def encoded(self, words: list[str], single: bool = False) -> list[bytes]:
        """The ids of each of some words without white space. single: each is one part to the tokenizer."""
        return [ids for at in range(0, len(words), WORDS_TOGETHER) for ids in self.encoded_together(words[at : at + WORDS_TOGETHER], single)]

    def encoded_together(self, words: list[str], single: bool) -> list[bytes]:
        text = " ".join(words)
        if "<|" in text or len(text.split()) != len(words):  # special tokens and other white space: one by one
            return [np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, dtype="<u4").tobytes() for w in words]
        got = self.tokenizer.encode(text, add_special_tokens=False)
        ids = np.array(got.ids, dtype="<u4").tobytes()
        if single:
            owner = np.array(got.word_ids, dtype=np.int64)
        else:
            first = np.cumsum([0, *[len(w) + 1 for w in words]])[:-1]
            owner = np.searchsorted(first, np.fromiter((o[0] for o in got.offsets), dtype=np.int64, count=len(got.ids)), side="right") - 1
        return parted(ids, np.cumsum(np.bincount(owner, minlength=len(words))))

    def bare_cores(self, cores: list[str]) -> list[bytes]:
        """The ids of some cores of a to z."""
        out = []
        for at in range(0, len(cores), WORDS_TOGETHER):
            ids = np.array(self.bare.encode_batch_fast([" ".join(cores[at : at + WORDS_TOGETHER])], add_special_tokens=False)[0].ids, dtype="<u4")
            out += parted(ids.tobytes(), np.flatnonzero(self.ends[ids]) + 1)
        return out

    def new_cores(self, cores: list[str]) -> list[bytes]:
        plain = [self.bare is not None and self.PLAIN.fullmatch(c) is not None for c in cores]
        quick = iter(self.bare_cores([c for c, p in zip(cores, plain, strict=True) if p]))
        slow = iter(self.encoded([c.lower() for c, p in zip(cores, plain, strict=True) if not p], single=True))
        return [next(quick if p else slow) for p in plain]

    def __call__(self, texts: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's ids end."""
        distinct, codes, ends = coded_words(texts)
        words = pa.StringArray.from_buffers(len(distinct), *distinct.buffers()[1:], offset=distinct.offset)
        found = pc.extract_regex(words, self.SIMPLE)
        simple = found.is_valid().to_numpy(zero_copy_only=False)
        found, other = found.filter(pa.array(simple)), words.filter(pa.array(~simple)).to_pylist()
        cores, runs = pc.ascii_lower(found.field("core")).dictionary_encode(), found.field("run").dictionary_encode()
        core_list, run_list = cores.dictionary.to_pylist(), runs.dictionary.to_pylist()
        ids = self.cores.of(core_list, self.new_cores)
        ids += self.others.of(other + [r for r in run_list if r], self.encoded)
        # Of each distinct word: its core and run, or itself (and nothing), among ids.
        places = {r: len(core_list) + len(other) + i for i, r in enumerate(r for r in run_list if r)}
        ids.append(b"")
        nothing = len(ids) - 1
        pairs = np.full((len(distinct), 2), nothing, dtype=np.int64)
        pairs[simple, 0] = cores.indices.to_numpy(zero_copy_only=False)
        pairs[simple, 1] = np.array([places.get(r, nothing) for r in run_list], dtype=np.int64)[runs.indices.to_numpy(zero_copy_only=False)]
        pairs[~simple, 0] = len(core_list) + np.arange(len(other))
        flat, upto = gathered(ids, pairs.ravel())
        stop = upto[1::2]
        sizes = np.diff(stop, prepend=0)
        flat, upto = repeated(flat, stop - sizes, sizes, codes)
        return flat, np.concatenate([[0], upto])[ends]


def parted(ids: bytes, ends: np.ndarray) -> list[bytes]:
    """Pieces of 32-bit ids, up to each of the ends."""
    at = (ends * 4).tolist()
    return [ids[a:b] for a, b in zip([0, *at], at, strict=False)]


class TextEncoder:
    """The same for any tokenizer, text by text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)

    def __call__(self, texts: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        lists = [self.tokenizer.encode(t.decode(), add_special_tokens=False).ids for t in texts.to_pylist()]
        return np.array([i for ids in lists for i in ids], dtype="<u4"), np.cumsum([len(ids) for ids in lists], dtype=np.int64)


def encoder_of(path: str):
    """Word by word if the tokenizer is known to allow it: it lower-cases, and its split drops white space and keeps words and runs of punctuation apart."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    steps = lambda x, inner: [x] if x and x.get("type") != "Sequence" else (x or {}).get(inner, [])
    normal = [(n["type"], n.get("pattern"), n.get("content")) for n in steps(spec.get("normalizer"), "normalizers")]
    split = [(n["type"], n.get("pattern"), n.get("behavior"), n.get("invert"), n.get("add_prefix_space"), n.get("use_regex")) for n in steps(spec.get("pre_tokenizer"), "pretokenizers")]
    special = all(t["content"].startswith("<|") and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in spec.get("added_tokens", []))
    return WordEncoder(path) if (normal, split) == (NORMALIZERS, SPLITS) and special else TextEncoder(path)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32."""
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    id_type = chosen.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    out = pa.schema([("doc_id", to_arrow_type(id_type)), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer_path(tokenizer)
        end = np.asarray([end_id], dtype="<u4").tobytes()
        with of_worker(("encoder", path), lambda: encoder_of(path)) as encoder:
            for whole in batches:
                for batch in groups(whole, 1, TEXT_BYTES):
                    ids, ends = encoder(batch.column(1))
                    body = memoryview(ids).cast("B")
                    sizes = np.diff(ends, prepend=0) + 1
                    cuts = -(-sizes // capacity)
                    owner = np.repeat(np.arange(len(sizes)), cuts)
                    piece = np.arange(len(owner)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
                    start = piece * capacity
                    upto = np.minimum(sizes[owner], start + capacity)
                    begin = (ends - sizes + 1)[owner]
                    crcs = [zlib.crc32(body[4 * a : 4 * b]) for a, b in zip((begin + start).tolist(), (begin + np.minimum(upto, sizes[owner] - 1)).tolist(), strict=True)]
                    crcs = [zlib.crc32(end, c) if last else c for c, last in zip(crcs, (upto == sizes[owner]).tolist(), strict=True)]
                    columns = [batch.column(0).take(pa.array(owner)), pa.array(piece, pa.int32()), pa.array(start), pa.array(upto - start), pa.array(crcs, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, schema=out)

    schema = f"doc_id {id_type.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return chosen.mapInArrow(cut, schema)


# --- the solver -------------------------------------------------------------------------------

Filling = tuple[tuple[int, int], ...]  # (length, copies), longest first


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs: by total length, and by lengths of which no two (over half) or three fit together.

    The latter for each length `small` at most half: pieces beyond capacity - small are alone, and those over half have no more room than they leave.
    """
    n = np.zeros(capacity + 1, dtype=np.int64)
    for length, many in counts.items():
        n[length] = many
    weight = n * np.arange(capacity + 1)
    upto, load = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(weight)])  # of lengths below an index
    half = capacity // 2
    small = np.arange(1, half + 1)
    fixed = upto[-1] - upto[capacity - small + 1]
    middle = upto[capacity - small + 1] - upto[half + 1]
    free = middle * capacity - (load[capacity - small + 1] - load[half + 1])
    rest = load[half + 1] - load[small]
    needed = fixed + middle + np.maximum(0, -(-(rest - free) // capacity))
    return int(max(-(-int(load[-1]) // capacity), upto[-1] - upto[half + 1], needed.max(initial=0)))


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Each length, longest first, goes into the fullest sequences that have room. Equal sequences are handled together."""
    open_by_room: dict[int, dict[Filling, int]] = {}
    rooms: list[int] = []

    def put(filling: Filling, room: int, n: int) -> None:
        if n:
            if room not in open_by_room:
                open_by_room[room] = {}
                bisect.insort(rooms, room)
            open_by_room[room][filling] = open_by_room[room].get(filling, 0) + n

    def place(filling: Filling, room: int, n: int, length: int, left: int) -> int:
        """Fill n equal sequences with left pieces one sequence after the other; returns the pieces left."""
        each = room // length
        full = min(n, left // each)
        put((*filling, (length, each)), room - each * length, full)
        left, n = left - full * each, n - full
        if n and left:
            put((*filling, (length, left)), room - left * length, 1)
            left, n = 0, n - 1
        put(filling, room, n)
        return left

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            i = bisect.bisect_left(rooms, length)
            if i == len(rooms):
                each = capacity // length
                left = place((), capacity, -(-left // each), length, left)
            else:
                room = rooms.pop(i)
                for filling, n in sorted(open_by_room.pop(room).items(), reverse=True):
                    left = place(filling, room, n, length, left) if left else (put(filling, room, n), 0)[1]
    done: Counter[Filling] = Counter()
    for group in open_by_room.values():
        for filling, n in group.items():
            merged: Counter[int] = Counter()
            for length, k in filling:
                merged[length] += k
            done[tuple(sorted(merged.items(), reverse=True))] += n
    return list(done.items())


def dominates(a: list[int], b: list[int]) -> bool:
    """Whether b's pieces fit into a's pieces as bins, so that a solution with b can be turned into one with a."""
    if not b:
        return True
    if sum(b) > sum(a) or max(b) > max(a, default=0):
        return False
    head, rest = b[0], b[1:]
    tried = set()
    for i, room in enumerate(a):
        if room >= head and room not in tried:
            tried.add(room)
            if dominates(sorted([*a[:i], room - head, *a[i + 1 :]], reverse=True), rest):
                return True
    return False


class Budget:
    """Steps that the search may still take."""

    def __init__(self, steps: int):
        self.left = steps

    def spend(self) -> bool:
        self.left -= 1
        return self.left >= 0


class Supply:
    """The pieces that are left, by length; one of them may be set aside. Generators over it go on only when it is as they left it."""

    def __init__(self, counts: dict[int, int]):
        self.left, self.lengths = dict(counts), sorted(counts)  # lengths: ascending, those of which some are left

    def change(self, filling: Filling, n: int) -> None:
        for length, k in filling:
            before = self.left[length]
            self.left[length] = before - n * k
            if not before and self.left[length]:
                bisect.insort(self.lengths, length)
            elif before and not self.left[length]:
                del self.lengths[bisect.bisect_left(self.lengths, length)]

    def beside(self, length: int, aside: int) -> int:
        """Pieces of a length that are left beside one of the length aside."""
        return self.left[length] - (length == aside)


def sets_of_sum(total: int, supply: Supply, aside: int, budget: Budget) -> Iterator[list[int]]:
    """The multisets of what is left that have this sum, largest pieces first."""

    def grow(chosen: list[int], total: int, upto: int) -> Iterator[list[int]]:
        if not total:
            yield list(chosen)
            return
        i = bisect.bisect_right(supply.lengths, min(total, upto)) - 1
        while i >= 0 and budget.spend():
            length = supply.lengths[i]
            if supply.beside(length, aside) > (chosen.count(length) if chosen and chosen[-1] == length else 0):
                chosen.append(length)
                yield from grow(chosen, total - length, length)
                chosen.pop()
            i -= 1

    yield from grow([], total, total)


def completions(supply: Supply, aside: int, room: int, waste: int, budget: Budget) -> Iterator[list[int]]:
    """Undominated sets of pieces for the room beside the largest piece (aside) that waste no more than allowed, fullest first, one at a time.

    A set that leaves room for a piece that it doesn't hold is dominated, so the sums end where all the pieces that
    would still fit are more than the sum holds.
    """
    kept: list[list[int]] = []
    fits, load = 0, 0  # lengths[:fits] fit into what a set of this sum wastes; load is all that is left of them
    for total in range(room, max(room - waste, 0) - 1, -1):
        while fits < len(supply.lengths) and supply.lengths[fits] <= room - total:
            load += supply.lengths[fits] * supply.beside(supply.lengths[fits], aside)
            fits += 1
        if load > total or budget.left <= 0:
            return
        for one in sets_of_sum(total, supply, aside, budget):
            held = Counter(one)
            if all(held[x] == supply.beside(x, aside) for x in supply.lengths[:fits]) and not any(dominates(k, one) for k in kept):
                yield one
                if len(one) == 1 and total == room:  # dominates all other fillings of this room
                    return
                kept.append(one)


def packed_lengths(counts: dict[int, int], capacity: int = CAPACITY, steps: int = STEPS) -> tuple[list[tuple[Filling, int]], int]:
    """Patterns that hold all pieces in as few sequences as were found, and the lower bound."""
    counts = {k: n for k, n in counts.items() if n}
    size = lambda patterns: sum(n for _, n in patterns)
    incumbent = best_fit_decreasing(counts, capacity)
    least, total = lower_bound(counts, capacity), sum(k * n for k, n in counts.items())
    best, supply, budget = size(incumbent), Supply(counts), Budget(steps)
    path: list[tuple[Filling, int]] = []

    def options(waste: int) -> Iterator[tuple[Filling, int, int]]:
        largest, allowed = supply.lengths[-1], (best - 1) * capacity - total - waste
        for one in completions(supply, largest, capacity - largest, allowed, budget):
            filling = tuple(sorted(Counter([largest, *one]).items(), reverse=True))
            lost = capacity - sum(k * n for k, n in filling)
            most = min(supply.left[k] // n for k, n in filling)
            # Perfect fillings are repeated at once; others too, while they stay within half of the waste allowed.
            times = most if not lost else max(1, min(most, allowed // (2 * lost)))
            yield filling, times, lost * times

    stack = [(options(0), 0, 0)] if counts and best > least else []
    nodes = 0
    while stack and best > least and budget.spend():
        choices, waste, used = stack[-1]
        step = next(choices, None)
        if step is None:
            stack.pop()
            if stack:
                supply.change(path[-1][0], -path.pop()[1])
            continue
        filling, times, lost = step
        if waste + lost > (best - 1) * capacity - total or used + times >= best:
            continue
        supply.change(filling, times)
        path.append((filling, times))
        nodes += 1
        if nodes & (nodes - 1) == 0 or not supply.lengths:  # what is left by best fit, at a few nodes and at the leaves
            rest = best_fit_decreasing({k: n for k, n in supply.left.items() if n}, capacity)
            if used + times + size(rest) < best:
                incumbent, best = [*path, *rest], used + times + size(rest)
        if supply.lengths:
            stack.append((options(waste + lost), waste + lost, used + times))
        else:
            supply.change(filling, -path.pop()[1])
    logging.getLogger(__name__).info("%d sequences, at least %d, %s", best, least, "search ended" if budget.left > 0 else "steps used up")
    merged: Counter[Filling] = Counter()
    for filling, n in incumbent:
        merged[filling] += n
    return list(merged.items()), least


def pack_lengths(counts: dict[int, int], capacity: int = CAPACITY, steps: int = STEPS) -> list[tuple[Filling, int]]:
    return packed_lengths(counts, capacity, steps)[0]


# --- places -----------------------------------------------------------------------------------


def places(patterns: list[tuple[Filling, int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Of each length: first number, sequence, copies in it, and offset, for runs of pieces numbered within the length."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: Counter[int] = Counter()
    sequence = 0
    for filling, n in patterns:
        offset = 0
        for length, k in filling:
            runs.setdefault(length, []).append((taken[length], sequence, k, offset))
            taken[length] += n * k
            offset += length * k
        sequence += n
    return {length: tuple(np.array(x, dtype=np.int64) for x in zip(*rows, strict=True)) for length, rows in runs.items()}


def pack(docs: DataFrame, capacity: int = CAPACITY, steps: int = STEPS, **options) -> DataFrame:
    """docs' pieces with sequence_id and offset; n_sequences and least_sequences (a lower bound) are the same in all rows."""
    with rows_at_a_time(docs.sparkSession, BATCH_ROWS):
        cut = stash(pieces(docs, capacity=capacity, **options), "pieces")
    counts = {int(r["length"]): int(r["n"]) for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    patterns, least = packed_lengths(counts, capacity, steps)
    runs = places(patterns)
    # So many cells for each length that a cell of the commonest has about CELL pieces.
    salt = spread(F.concat_ws(",", "doc_id", "piece", "ids_crc32"), min(max(64, max(counts.values(), default=0) // CELL), 1 << 16))
    numbered = ranked(cut, ["length"], salt, F.lit(0), ["doc_id", "piece", "start", "ids_crc32"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, numbers = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
            order = np.argsort(lengths, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(order) else []:
                length = int(lengths[rows[0]])
                first, base, copies, start = runs[length]
                i = np.searchsorted(first, numbers[rows], side="right") - 1
                inside = numbers[rows] - first[i]
                sequence[rows] = base[i] + inside // copies[i]
                offset[rows] = start[i] + inside % copies[i] * length
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    schema = f"doc_id {cut.schema['doc_id'].dataType.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    told = {"n_sequences": F.lit(sum(n for _, n in patterns)).cast("long"), "least_sequences": F.lit(least).cast("long")}
    return numbered.mapInArrow(place, schema).withColumns(told)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
