"""Phrase collocations by pivot partitioning, as in MG-FSM.

Texts are lower-cased (A-Z), cut into pieces at BREAKS and into words at blanks and tabs; every count
is one of a language. After the words are counted, those below the least count end a phrase like
the end of a piece does. Each phrase belongs to its pivot, its rarest word (the first of equally
rare ones). An occurrence of a word is rewritten to its fragment: the words that can stand in a
phrase of which it is the pivot, so those before it up to one as rare, and those after it up to a
rarer one, three at most on either side. Fragments that are alike are counted where they are, then
go to their pivot, whose group mines them: it counts only phrases that hold the pivot, each of which
no other group counts. Pivots with more than PIVOT_ROWS occurrences are dealt over shards, whose
counts are added up. Cuts, scores and containment are joins over the frequent phrases alone.

Words are held as numbers, one for each language and word. Up to MOST_WORDS frequent words are
broadcast to the tasks that read texts; more are joined by shuffle instead.

Defined results: null and empty texts have no words; a null language is ``und``; texts of any length
are read whole (a task holds one piece or SLICE bytes, whichever is more); repeated rows count each;
all ties are settled by score, count and phrase; a language without frequent phrases has no rows,
nor has an empty table; other columns, whatever their names, are left alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, shuffle_partitions
from .hashing import BASE, U, mix

NO_LANG = "und"
LONGEST = 4
LEAST, CONTAINED, SCALE, TOP = 30, 80, 2_000_000, 2_000
#: Frequent words that are broadcast at most; beyond, texts' words are joined with them by shuffle.
MOST_WORDS = 500_000
#: Occurrences of a pivot in one shard, about.
PIVOT_ROWS = 50_000
#: Occurrences of frequent words whose fragments one task mines, about: it holds some 600 bytes for each, and beyond its memory spills them.
MINED = 400_000
#: Bytes of text that are split into words at once; rows of fragments, or different words, that are counted in one go.
SLICE, BUFFER = 1 << 20, 400_000
#: Parts of one word are spread over so many keys when they meet their counts.
SALTS = 16
#: Shards of a language's candidates, each of which names its best before they are compared.
RANK_SHARDS = 16

BREAKS = b".,;:!?\n\x0b\x0c\r"
#: The break is a word of its own here; no word can be a full stop, which is a break.
BREAK = b"."
_SIMPLE = bytes.maketrans(BREAKS + b"\t", b"." * len(BREAKS) + b" ")
REACH = LONGEST - 1
LEFT, RIGHT = [f"l{k}" for k in range(1, LONGEST)], [f"r{k}" for k in range(1, LONGEST)]
WORDS = [f"w{k}" for k in range(1, LONGEST + 1)]


def tokens(text: str | None) -> Iterator[list[bytes]]:
    """The text's words and breaks, in slices that end with a piece."""
    data, at = (text or "").encode().lower().translate(_SIMPLE), 0
    while at < len(data):
        end = data.find(BREAK, at + SLICE) + 1 or len(data)
        yield data[at:end].replace(BREAK, b" . ").split()
        at = end


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(text_col).alias("text"))


def count_words(texts: DataFrame) -> DataFrame:
    """lang, word, f of texts (lang, text): counted in the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, counter in counters.items():
                counter.pop(BREAK, None)
                words = pa.array(list(counter), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang), len(words)), words, pa.array(list(counter.values()), pa.int64())], names=["lang", "word", "f"])
            counters.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                counter = counters.setdefault(lang.as_py(), Counter())
                for words in tokens(text.as_py()):
                    counter.update(words)
                    if sum(map(len, counters.values())) > BUFFER:
                        yield from flush()
                        counter = counters.setdefault(lang.as_py(), Counter())
        yield from flush()

    counted = texts.mapInArrow(run, "lang string, word string, f long")
    return counted.groupBy("lang", "word").agg(F.sum("f").alias("f"))


def fragments_of(ids: np.ndarray, f: np.ndarray, shards: int, pivot_rows: int = PIVOT_ROWS) -> np.ndarray:
    """Fragments of a row of words: pivot, shard, l1 to l3 and r1 to r3 (0: none), one column for each occurrence.
    ids and f (counts) are 0 for breaks and rare words. shard is -1 for pivots that have only one."""
    none = np.zeros(REACH, np.int64)
    ids, f = np.concatenate((none, ids, none)), np.concatenate((none, f, none))
    middle = slice(REACH, len(f) - REACH)
    own = f[middle]
    out = np.zeros((2 + 2 * REACH, len(own)), np.int64)
    out[0] = ids[middle]
    for side, first in ((-1, 2), (1, 2 + REACH)):
        fits = own > 0
        for k in range(1, LONGEST):
            there = slice(middle.start + side * k, middle.stop + side * k)
            fits = fits & (f[there] > own if side < 0 else f[there] >= own)
            out[first + k - 1] = np.where(fits, ids[there], 0)
    many = np.minimum(1 + own // pivot_rows, shards)
    kept = (out[2] != 0) | (out[2 + REACH] != 0)
    out, many = out[:, kept], many[kept]
    out[1] = np.where(many > 1, (_hashes(out[2:]) % many.astype(U)).astype(np.int64), -1)
    return out


def _hashes(rows: np.ndarray) -> np.ndarray:
    h = np.zeros(rows.shape[1], U)
    for row in rows:
        h = mix((h ^ row.astype(U)) * U(BASE) + U(1))
    return h


class _Fragments:
    """Counts equal fragments of some texts before they leave the task."""

    def __init__(self, shards: int, pivot_rows: int, buffer: int) -> None:
        self.shards, self.pivot_rows, self.buffer, self.held, self.n = shards, pivot_rows, buffer, [], 0

    def add(self, ids: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
        got = fragments_of(ids, f, self.shards, self.pivot_rows)
        self.held.append(got)
        self.n += got.shape[1]
        if self.n > self.buffer:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.n:
            rows = np.concatenate(self.held, axis=1)
            # equal rows have equal hashes; others that share one may lie between them, which only leaves two counts of one row
            rows = rows[:, np.argsort(_hashes(rows), kind="stable")]
            new = np.ones(rows.shape[1], bool)
            new[1:] = (rows[:, 1:] != rows[:, :-1]).any(axis=0)
            at = np.flatnonzero(new)
            rows, counts = rows[:, at], np.diff(np.append(at, len(new)))
            for first in range(0, len(at), 50_000):
                part = slice(first, first + 50_000)
                yield pa.RecordBatch.from_arrays([pa.array(c[part]) for c in (*rows, counts)], names=["pivot", "shard", *LEFT, *RIGHT, "c"])
        self.held, self.n = [], 0


FRAGMENT = f"pivot long, shard long, {', '.join(f'{c} long' for c in (*LEFT, *RIGHT))}, c long"


def _by_broadcast(texts: DataFrame, dictionary: DataFrame, *bounds: int) -> DataFrame:
    """Fragments with the frequent words in every task."""
    table = dictionary.select("lang", "word", "id", "f").toArrow()
    index: dict[str, dict[bytes, int]] = {}
    for k, (lang, word) in enumerate(zip(table["lang"].to_pylist(), table["word"].to_pylist()), 1):
        index.setdefault(lang, {})[word.encode()] = k
    columns = [np.concatenate(([0], table[c].to_numpy())) for c in ("id", "f")]
    given = texts.sparkSession.sparkContext.broadcast((index, *columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, ids, f = given.value
        out, none = _Fragments(*bounds), {}
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                known = index.get(lang.as_py(), none)
                for words in tokens(text.as_py()) if known else ():
                    places = np.fromiter(map(known.get, words, repeat(0)), np.int64, len(words))
                    yield from out.add(ids[places], f[places])
        yield from out.flush()

    return texts.mapInArrow(run, FRAGMENT)


def _by_shuffle(texts: DataFrame, dictionary: DataFrame, *bounds: int) -> DataFrame:
    """The same where the frequent words are too many for a task: words meet their numbers in a join, and slices their words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                for words in tokens(text.as_py()):
                    number += 1
                    arrays = [pa.array([lang.as_py()]), pa.array([number], pa.int64()), pa.array([words], pa.list_(pa.binary())).cast(pa.list_(pa.string()))]
                    yield pa.RecordBatch.from_arrays(arrays, names=["lang", "slice", "words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Fragments(*bounds)
        for batch in batches:
            for row in batch.column(0):
                place, number, f = (row.values.field(k).to_numpy() for k in range(3))
                ids, counts = np.zeros((2, int(place.max()) + 1), np.int64)
                ids[place], counts[place] = number, f
                yield from out.add(ids, counts)
        yield from out.flush()

    slices = texts.mapInArrow(cut, "lang string, slice long, words array<string>")
    said = slices.select("lang", "slice", F.posexplode("words").alias("place", "word"))
    found = said.join(dictionary, ["lang", "word"])
    rows = found.groupBy("slice").agg(F.collect_list(F.struct(F.col("place").cast("long").alias("place"), "id", "f")).alias("found"))
    return rows.select("found").mapInArrow(run, FRAGMENT)


def mine(fragments: DataFrame, least: int = LEAST, tasks: int | None = None) -> DataFrame:
    """Phrases that are counted often enough: w1 to w4 (0: none), a. Each pivot's group counts its own, in so many tasks."""
    grams = []
    for before in range(LONGEST):
        for behind in range(LONGEST - before):
            if before + behind:
                names = [*LEFT[:before][::-1], "pivot", *RIGHT[:behind]]
                whole = F.lit(True)
                for edge in (*LEFT[:before][-1:], *RIGHT[:behind][-1:]):
                    whole = whole & (F.col(edge) != 0)
                words = [F.col(n) for n in names] + [F.lit(0).cast("long")] * (LONGEST - len(names))
                grams.append(F.when(whole, F.struct(*[w.alias(n) for w, n in zip(words, WORDS)])))
    group = ["pivot", "shard"]
    dealt = lambda rows, *by: rows.repartition(*[tasks] * bool(tasks), *by)
    own = dealt(fragments, *group).select(*group, "c", F.explode(F.array(*grams)).alias("g")).filter("g IS NOT NULL")
    local = own.select(*group, "c", "g.*").groupBy(*group, *WORDS).agg(F.sum("c").alias("a"))
    # a pivot's only shard has counted whole; the others' counts are added up
    left = local.filter((F.col("shard") >= 0) | (F.col("a") >= least))
    return dealt(left.select(*WORDS, "a"), *WORDS).groupBy(*WORDS).agg(F.sum("a").alias("a")).filter(F.col("a") >= least)


def _n(words: list[str] = WORDS) -> Column:
    return sum((F.when(F.col(w) != 0, 1).otherwise(0) for w in words), F.lit(0))


def _part(first: int, last: int, **more: Column) -> Column:
    """A struct of the words from first up to, not including, last; the longest part has all but one."""
    words = [F.col(WORDS[k]) for k in range(first, last)] + [F.lit(0).cast("long")] * (REACH - last + first)
    return F.struct(*[w.alias(f"p{k}") for k, w in enumerate(words, 1)], *[v.alias(k) for k, v in more.items()])


PART = [f"p{k}" for k in range(1, LONGEST)]


def scored(phrases: DataFrame, dictionary: DataFrame) -> DataFrame:
    """w1 to w4, a, l, r, score by the lowest-scoring cut."""
    cuts = []
    for n in range(2, LONGEST + 1):
        for k in range(1, n):
            for left, (x, y) in ((True, (0, k)), (False, (k, n))):
                cuts.append((n, _part(x, y, k=F.lit(k), left=F.lit(left))))
    asked = phrases.select(*WORDS, "a", F.explode(F.array(*[F.when(_n() == n, part) for n, part in cuts])).alias("x")).filter("x IS NOT NULL")
    salt = lambda key: F.when(F.col("p2") == 0, key).otherwise(0).cast("int")
    asked = asked.select(*WORDS, "a", "x.*").withColumn("salt", salt(F.pmod(F.xxhash64(*WORDS), F.lit(SALTS))))
    # frequent words are parts of many phrases, so they meet them under several keys
    single = dictionary.select(F.col("id").alias("p1"), *[F.lit(0).cast("long").alias(p) for p in PART[1:]], "f", F.explode(F.array(*map(F.lit, range(SALTS)))).alias("salt"))
    several = phrases.filter(F.col(WORDS[-1]) == 0).select(*[F.col(w).alias(p) for w, p in zip(WORDS, PART)], F.col("a").alias("f"), F.lit(0).alias("salt"))
    both = asked.join(single.unionByName(several), [*PART, "salt"])
    sides = both.groupBy(*WORDS, "a", "k").agg(F.max(F.when(F.col("left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("left"), F.col("f"))).alias("r"))
    value = F.expr(f"(CAST(a AS DECIMAL(20, 0)) * {SCALE}) div (CAST(l AS DECIMAL(20, 0)) + r)")
    lowest = F.min(F.struct(value.alias("score"), "k", "l", "r")).alias("cut")
    return sides.groupBy(*WORDS, "a").agg(lowest).select(*WORDS, "a", "cut.l", "cut.r", "cut.score")


def free_standing(phrases: DataFrame, share: int = CONTAINED) -> DataFrame:
    """w1 to w4 of the phrases that no longer one contains with so many hundredths of their count."""
    inner = []
    for n in range(3, LONGEST + 1):
        for size in range(2, n):
            inner += [(n, _part(at, at + size)) for at in range(n - size + 1)]
    held = phrases.select("a", F.explode(F.array(*[F.when(_n() == n, part) for n, part in inner])).alias("x")).filter("x IS NOT NULL")
    most = held.select("x.*", "a").groupBy(*PART).agg(F.max("a").alias("longer"))
    most = most.select(*[F.col(p).alias(w) for p, w in zip(PART, WORDS)], F.lit(0).cast("long").alias(WORDS[-1]), "longer")
    exact = lambda c, n: F.col(c).cast("decimal(20,0)") * F.lit(n)
    kept = F.col("longer").isNull() | (exact("longer", 100) < exact("a", share))
    return phrases.join(most, WORDS, "left").filter(kept).select(*WORDS)


def written(rows: DataFrame, dictionary: DataFrame, few: bool) -> DataFrame:
    """The rows with their lang and phrase instead of w1 to w4."""
    others = [c for c in rows.columns if c not in WORDS]
    each = rows.select(F.struct(*others).alias("row"), F.struct(*WORDS).alias("key"), F.posexplode(F.array(*WORDS)).alias("place", "id")).filter("id <> 0")
    names = dictionary.select("id", "lang", "word")
    found = each.join(F.broadcast(names) if few else names, "id")
    whole = found.groupBy("key").agg(F.first("row").alias("row"), F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("place", "word"))).alias("w"))
    return whole.select("lang", F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("phrase"), "row.*")


def best(rows: DataFrame, top: int = TOP) -> DataFrame:
    """Each language's first rows with their rank: the best of its shards are compared."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    shard = F.pmod(F.xxhash64("phrase"), F.lit(RANK_SHARDS))
    near = rows.withColumn("shard", shard).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "shard").orderBy(*order))).filter(F.col("rank") <= top)
    last = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return last.filter(F.col("rank") <= top).drop("shard")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases of 2 to 4 words."""
    spark, texts = docs.sparkSession, _texts(docs, text_col, lang_col)
    counts = materialize(count_words(texts), "collocations-words")
    dictionary = materialize(counts.filter(F.col("f") >= least).withColumn("id", F.monotonically_increasing_id() + 1), "collocations-frequent")
    n, said = dictionary.agg(F.count("*"), F.coalesce(F.sum("f"), F.lit(0))).first()
    few, tasks = n <= MOST_WORDS, max(shuffle_partitions(spark), -(-said // MINED))
    fragments = (_by_broadcast if few else _by_shuffle)(texts, dictionary, tasks, PIVOT_ROWS, BUFFER)
    phrases = materialize(mine(fragments, least, tasks), "collocations-phrases")
    rows = written(scored(phrases, dictionary).join(free_standing(phrases), WORDS), dictionary, few)
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    return best(rows, top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
