"""Best-fit packing of documents into training sequences by bin completion.

Documents become token ids and an end id; only those above the capacity are cut. Which
lengths share a sequence is decided on the histogram of lengths, which has at most
``capacity`` rows however large the input is: best fit in batches gives the incumbent, and
bin completion improves it unless it meets the lower bound. The bin of the largest length is
completed by every undominated filling, least waste first, by every number of such bins, and
pruned by the waste that a better packing can still have; all fillings are enumerated one by one
as the search asks for them, so that without a budget the search ends with the optimum. The budget
is of work: NODES patterns taken, and STEPS looks at an item or a number of items, whether they lead
to a filling or not; whichever is spent first, the best packing found so far stands. The documents then take their places by their rank within their length; ranks are counted in two
levels, so that a frequent length is not sorted in one task.

Defined results: null and empty texts are the end id alone; texts of any length are tokenized
whole and cut into pieces; pieces of one length go by doc_id, then piece, then checksum within
their group, equal ones in any order; repeated rows are packed one by one; an empty table gives
no rows; other columns, whatever their names, are left alone.
"""

from __future__ import annotations

import bisect
import json
import math
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import lean, materialize, release

CAPACITY = 4096
END_ID = 1
#: Nodes of the bin-completion search, and steps of its enumeration (some seconds); the incumbent stands beyond.
NODES, STEPS = 1_000, 1_000_000
#: Every so many nodes best fit completes the search's state for a new incumbent.
DIVE = 16
#: Rows of a length ranked in one group, about.
GROUP_ROWS = 512

Pattern = tuple[tuple[tuple[int, int], ...], int]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class TokenIds:
    """Token ids of texts, as little-endian unsigned 32-bit bytes.

    Texts of Latin letters and common signs are split here by the vocabulary's own pattern and
    merged by tiktoken, whose ranks are the vocabulary's ids with each word's end as a NUL byte.
    That holds only for files that normalise and split as NORMAL and SPLIT say, and whose ids and
    merges are in one order, which is checked. Other texts, those that may hold a special token,
    and all texts with other files, go through the tokenizer file itself. No piece of such a text
    reaches over a blank, so the ids of its first KEPT different words are kept, and only other words
    are split and merged, all of a text at once with MARK between them.
    """

    NORMAL = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
    SPLIT = {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    }

    SAFE = regex.compile(r"[\t\n\r -~\u00a1-\u017f\u2013-\u2026]*")
    #: The letters and numbers that SAFE texts have in lower case, a dot that lower() leaves above an i among the other signs.
    LETTERS, NUMBERS = ("".join(c for c in map(chr, [*range(0x21, 0x7F), *range(0xA1, 0x180)]) if unicodedata.category(c)[0] == kind) for kind in "LN")
    PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\s{LETTERS}{NUMBERS}]+")
    #: No SAFE text has it.
    MARK = "\x01"
    #: Words whose ids are kept, and their longest (some 200 bytes each).
    KEPT, KEPT_CHARS = 100_000, 40

    def __init__(self, path: str) -> None:
        self.path = path
        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        model = whole["model"]
        vocab, end = model.get("vocab", {}), model.get("end_of_word_suffix")
        merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
        first = len(vocab) - len(merges)
        plain = {"dropout": None, "unk_token": None, "continuing_subword_prefix": None, "byte_fallback": False, "ignore_merges": False}
        known = model.get("type") == "BPE" and whole["normalizer"] == self.NORMAL and whole["pre_tokenizer"] == self.SPLIT
        known = known and all(model.get(k) == v for k, v in plain.items()) and all("<|" in x["content"] for x in whole["added_tokens"])
        known = known and not whole.get("truncation") and not whole.get("post_processor")
        self.fast, self.ids_of_word = None, {}
        if known and end and all(vocab.get(a + b) == first + i for i, (a, b) in enumerate(merges)):
            # byte-level vocabularies write the printable bytes as themselves and the others from U+0100 on
            shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
            byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
            ranks = {}
            for token, i in vocab.items():
                body = token.removesuffix(end)
                ranks[bytes(byte[c] for c in body) + b"\0" * (body != token)] = i
            if len(ranks) == len(vocab):
                self.fast = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})
                (self.mark,) = self.fast.encode_ordinary(f"{self.MARK}\0")

    @cached_property
    def whole(self):  # noqa: ANN202
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def __call__(self, text: str | None) -> bytes:
        text = text or ""
        if self.fast is None or "<|" in text or not self.SAFE.fullmatch(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        words = unicodedata.normalize("NFC", text).lower().split()
        found = list(map(self.ids_of_word.get, words))
        new = [i for i, ids in enumerate(found) if ids is None]
        if new:
            parts = self.PIECE.findall(f" {self.MARK} ".join([words[i] for i in new]))
            ids = self.fast.encode_to_numpy("\0".join([*parts, ""]), disallowed_special=()).astype("<u4")
            data, at = ids.tobytes(), 0
            for i, end in zip(new, [*(4 * np.flatnonzero(ids == self.mark)).tolist(), len(data)]):
                found[i], at = data[at:end], end + 4
                if len(self.ids_of_word) < self.KEPT and len(words[i]) <= self.KEPT_CHARS:
                    self.ids_of_word[words[i]] = found[i]
        return b"".join(found)


@lru_cache(1)
def token_ids(path: str) -> TokenIds:
    """One for each worker: its tables are made once, and the tokenizer is loaded only where a text needs it."""
    return TokenIds(path)


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    id_type = docs.schema[id_col].dataType.simpleString()
    end = np.array([END_ID], "<u4").tobytes()
    names = ["piece", "start", "length", "ids_crc32"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = token_ids(path)
        release()  # what reading the file took
        for batch in batches:
            rows, take = [], []
            for i, x in enumerate(batch.column(1)):
                ids = ids_of(x.as_py()) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    take.append(i)
                    rows.append((k, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(take, pa.int64())), *[pa.array(c, k) for c, k in zip(cols, kinds)]], names=["doc_id", *names])

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(lean(run), f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long")


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing on a histogram: bins that are alike are filled together."""
    open_bins: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = {}
    rests: list[int] = []
    done: list[Pattern] = []

    def put(rest: int, content: tuple[tuple[int, int], ...], n: int) -> None:
        if n and rest:
            if rest not in open_bins:
                open_bins[rest] = []
                bisect.insort(rests, rest)
            open_bins[rest].append((content, n))
        elif n:
            done.append((content, n))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left and (at := bisect.bisect_left(rests, size)) < len(rests):
            rest = rests[at]
            content, n = open_bins[rest].pop()
            if not open_bins[rest]:
                del open_bins[rest], rests[at]
            fit = rest // size
            full = min(n, left // fit)
            put(rest - fit * size, (*content, (size, fit)), full)
            left -= full * fit
            n -= full
            if n and left:  # fewer than fit are left
                put(rest - left * size, (*content, (size, left)), 1)
                left, n = 0, n - 1
            put(rest, content, n)
        fit = capacity // size
        put(capacity - fit * size, ((size, fit),), left // fit)
        if left % fit:
            put(capacity - left % fit * size, ((size, left % fit),), 1)
    return done + [p for group in open_bins.values() for p in group]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """The larger of total over capacity and, for each k, large items plus what the middle ones need."""
    size = np.array(sorted(counts), np.int64)
    n = np.array([counts[s] for s in size.tolist()], np.int64)
    items, room = np.r_[0, np.cumsum(n)], np.r_[0, np.cumsum(n * size)]
    best = -(-int(room[-1]) // capacity)
    half = int(np.searchsorted(size, capacity // 2, "right"))
    for k in [0, *size[:half].tolist()]:
        far, near = max(half, int(np.searchsorted(size, capacity - k, "right"))), int(np.searchsorted(size, k))
        halves = int(items[far] - items[half])
        small = int(room[half] - room[near])
        free = halves * capacity - int(room[far] - room[half])
        best = max(best, int(items[-1] - items[half]) + max(0, -(-(small - free) // capacity)))
    return best


def reachable(sizes: list[int], counts: dict[int, int], rest: int) -> list[int]:
    """For each k the sums up to rest, as bits, that items of sizes[k:] can have."""
    mask, out = (1 << rest + 1) - 1, [1]
    for s in reversed(sizes):
        bits, left, step = out[-1], min(counts[s], rest // s), 1
        while left:
            take = min(step, left)
            bits |= bits << s * take
            left, step = left - take, 2 * step
        out.append(bits & mask)
    return out[::-1]


class Spent(Exception):
    """The search has looked at all that its budget allows."""


class Budget:
    """What a search may look at: steps of the enumeration, dominated and dead ends too, and what preparing them takes."""

    def __init__(self, steps: float) -> None:
        self.left = steps

    def take(self, steps: int = 1) -> None:
        self.left -= steps
        if self.left < 0:
            raise Spent


Filling = tuple[tuple[int, int], ...]


def exact_fillings(
    sizes: list[int], counts: dict[int, int], reach: list[int], total: int, waste: int, budget: Budget, after: Filling | None = None, at: int = 0, free: int = 1 << 62
) -> Iterator[Filling]:
    """All undominated choices of items with that total, as (size, number), larger sizes first; those behind `after` in
    this order, if given. free: the smallest size so far of which items are left."""
    if not total:
        # of the sizes that are left, and so free, none may fit into the waste or take the place of a smaller one
        if after is None and not (waste and at < len(sizes) and sizes[-1] <= waste):
            yield ()
        return
    for i in range(at, len(sizes)):
        budget.take()
        if not reach[i] >> total & 1:
            return
        s = sizes[i]
        if after and s > after[0][0]:
            free = s
            continue
        resumed = after is not None and bool(after) and s == after[0][0]
        # an item that a larger free one could replace within the waste is dominated; so is a free one that fits into it
        if free - s > waste:
            for k in range(after[0][1] if resumed else min(counts[s], total // s), 0, -1):
                budget.take()
                left = k < counts[s]
                if not (left and s <= waste) and reach[i + 1] >> total - k * s & 1:
                    for more in exact_fillings(sizes, counts, reach, total - k * s, waste, budget, after[1:] if resumed else None, i + 1, s if left else free):
                        yield ((s, k), *more)
                resumed = False
        after = None
        if s <= waste:
            return
        free = s


def fillings(sizes: list[int], counts: dict[int, int], rest: int, most_waste: int, budget: Budget | None = None, after: tuple[int, Filling] | None = None) -> Iterator[tuple[int, Filling]]:
    """(waste, filling) of all undominated fillings of the rest up to a waste, least waste first: to none can another
    item be added, and none has an item that a larger free one could replace within the rest. after: goes on behind that one."""
    budget = budget or Budget(math.inf)
    sizes = [s for s in sizes if s <= rest]
    budget.take(len(sizes))
    reach = reachable(sizes, counts, rest)
    for waste in range(after[0] if after else 0, min(rest, most_waste) + 1):
        budget.take()
        if reach[0] >> rest - waste & 1:
            for filling in exact_fillings(sizes, counts, reach, rest - waste, waste, budget, after[1] if after else None):
                yield waste, filling
        after = None


def bin_completion(counts: dict[int, int], capacity: int = CAPACITY, nodes: float | None = None, steps: float | None = None) -> list[Pattern]:
    """Patterns (content of a bin, number of such bins) that hold all items in as few bins as found. nodes, steps: None
    for NODES and for STEPS; with nodes of math.inf the search ends with the optimum."""
    counts = {s: n for s, n in counts.items() if n}
    fixed = [(((s, 1),), n) for s, n in counts.items() if s == capacity]
    counts.pop(capacity, None)
    best = best_fit(counts, capacity)
    n_best, bound = sum(n for _, n in best), lower_bound(counts, capacity)
    total = sum(s * n for s, n in counts.items())
    left = NODES if nodes is None else nodes
    budget = Budget(steps if steps is not None else math.inf if left == math.inf else STEPS)
    # depth first with one state that is changed and restored: a level is the pattern taken, from which its fillings go on;
    # only those of the last level are held
    now, path, bins, waste, step = dict(counts), [], 0, 0, 0

    def room() -> int:
        """The waste that a better packing can still have."""
        return (n_best - 1) * capacity - total - waste

    def tried(after: Pattern | None = None) -> Iterator[Pattern]:
        """What the bins of the largest length can hold, and how many of them, after what was tried last."""
        sizes = sorted(now, reverse=True)
        large = sizes[0]
        rest = now | {large: now[large] - 1}
        behind = None
        if after:
            content, times = after
            lost = capacity - sum(s * k for s, k in content)
            behind = lost, tuple((s, k - (s == large)) for s, k in content if k > (s == large))
            yield from ((content, t) for t in range(times - 1, 0, -1) if lost * t <= room())
        for lost, filling in fillings([s for s in sizes if rest[s]], rest, capacity - large, room(), budget, behind):
            need = dict(filling)
            need[large] = need.get(large, 0) + 1
            content = tuple(sorted(need.items(), reverse=True))
            most = min(now[s] // k for s, k in content)
            if lost > room():
                return
            for times in range(min(most, room() // lost) if lost else most, 0, -1):
                if lost * times <= room():
                    yield content, times

    def change(pattern: Pattern, sign: int) -> None:
        nonlocal bins, waste
        content, times = pattern
        for s, k in content:
            now[s] = now.get(s, 0) - sign * k * times
            if not now[s]:
                del now[s]
        bins += sign * times
        waste += sign * times * (capacity - sum(s * k for s, k in content))

    def dive() -> None:
        nonlocal best, n_best
        rest_best = best_fit(now, capacity)
        if bins + (n := sum(k for _, k in rest_best)) < n_best:
            best, n_best = [*path, *rest_best], bins + n

    ahead = tried() if n_best > bound else None
    try:
        while ahead and step < left and n_best > bound:
            step += 1
            pattern = next(ahead, None)
            if pattern is None:
                if not path:
                    break
                change(path[-1], -1)
                ahead = tried(path.pop())
                continue
            change(pattern, 1)
            path.append(pattern)
            if step % DIVE == 0 or not now:
                dive()
            ahead = tried() if now else iter(())
    except Spent:
        dive()
    return fixed + best


def places(spark: SparkSession, patterns: list[Pattern]) -> DataFrame:
    """For each length, ranges of ranks and the sequences they go to. Its rows follow the number of
    different lengths (at most the capacity), not the number of documents."""
    rows, taken, base = [], {}, 0
    for content, n in patterns:
        at = 0
        for size, k in content:
            first = taken.get(size, 0)
            rows.append((size, first, first + k * n, base, k, at))
            taken[size] = first + k * n
            at += k * size
        base += n
    return spark.createDataFrame(rows, "length long, first long, last long, base long, per_bin long, start_at long")


def pack(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    cut = materialize(pieces(docs, path or tokenizer_path(), id_col, text_col, capacity), "pack-pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most capacity rows
    plan = places(spark, bin_completion(histogram, capacity))
    groups = max(1, -(-max(histogram.values(), default=0) // GROUP_ROWS))
    group = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups))
    grouped = cut.withColumn("group", group)
    sizes = grouped.groupBy("length", "group").agg(F.count("*").alias("n"))
    ahead = F.sum("n").over(Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("length", "group", F.coalesce(ahead, F.lit(0)).alias("ahead"))
    mine = F.row_number().over(Window.partitionBy("length", "group").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = grouped.withColumn("mine", mine).join(sizes, ["length", "group"]).withColumn("rank", F.col("ahead") + F.col("mine"))
    p = plan.withColumnRenamed("length", "_l")
    # each pattern has some rows, and there are some patterns for each different length, of which there are at most capacity
    placed = ranked.join(F.broadcast(p), (F.col("length") == F.col("_l")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")))
    nth = F.col("rank") - F.col("first")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("base") + F.floor(nth / F.col("per_bin"))).cast("long").alias("sequence_id"),
        (F.col("start_at") + nth % F.col("per_bin") * F.col("length")).cast("long").alias("offset"),
    )
