"""Toxicity by multiple-instance learning.

Labels belong to documents, toxicity to sentences: each different sentence of a document gets a
probability from its words, and a document is toxic unless all its sentences are clean (noisy-or).
The weights are fitted to the document labels through that combination; afterwards the sentence
scores say where the offence is.

Length does not decide: a sentence counts once however often it stands in a document, sentences
without a word that speaks for toxicity (log-odds above LEAST_ODDS) count for nothing, nor do
those below CLEAN in a score, and what labels have that no sentence explains is one chance for
a document, not one for each sentence.

Labels are learnt from a bounded sample (SAMPLE_ROWS labelled rows, those whose ids hash lowest,
never held-out ones), of which whole texts are read: features are counted, and sentences reduced
to the features that matter, where the rows are; one task fits the weights from what is left.
Every document is scored over its whole text.

Defined results: null and empty texts have one empty sentence and get the score of the chance
alone, as have texts of any length without such words; repeated rows score alike; of rows that
share a labelled id the one of the smallest text hash is learnt from, once, and its label is the
largest of that id; ties in the sample's order go by id; an empty table gives no rows; without
labels of both kinds every score is 0; other columns, whatever their names, are left alone and
never read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize

#: Labelled rows that a fit reads at most.
SAMPLE_ROWS = 8_000
#: Samples up to this many rows are broadcast as ids and labels (some 20 bytes each), larger ones are joined by shuffle.
BROADCAST_ROWS = 500_000
#: Features with a weight are in so many documents at least, and have such log-odds.
LEAST_DOCS, LEAST_ODDS = 5, 1.5
#: Documents whose share of toxic ones is blended into a feature's odds.
SHRINK = 10.0
#: Probability below which a sentence is clean.
CLEAN = 0.05
#: Letters of the beginnings of words that are features beside the words.
BEGINNINGS = (3, 4, 5)
#: Words whose weights a worker remembers (about 60 MB).
REMEMBERED = 400_000
#: One in FOLDS ids is held out.
FOLDS = 5

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS)) == 0


def features(word: str) -> list[str]:
    """A word, its beginnings (insults are inflected and compounded), each marked by its kind."""
    return [word, *[f"{word[:k]}-" for k in BEGINNINGS if len(word) > k]]


class WordWeights(dict):
    """Sum of a word's feature weights, remembered for up to REMEMBERED words."""

    def __init__(self, weights: dict[str, float]) -> None:
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) > REMEMBERED:
            self.clear()
        got = self[word] = sum(self.weights.get(f, 0.0) for f in features(word))
        return got


@dataclass(frozen=True)
class Model:
    """chance and bias are log-odds: of a label that no sentence explains, and of a sentence before its words."""

    chance: float
    bias: float
    weights: dict[str, float]

    @cached_property
    def of_word(self) -> WordWeights:
        return WordWeights(self.weights)

    def sentence_logits(self, text: str | None) -> list[tuple[int, int, float]]:
        """(start, end, logit) of every sentence; a text without any has one empty sentence."""
        of, bias = self.of_word.__getitem__, self.bias
        out = [(m.start(), m.end(), bias + sum(sorted(map(of, set(WORD.findall(m[0].lower())))))) for m in SENTENCE.finditer(text or "")]
        return out or [(0, 0, bias)]

    def combined(self, text: str | None, parts: list[tuple[int, int, float]]) -> float:
        """Noisy-or of the chance and the different sentences that are not clean."""
        seen = {frozenset(WORD.findall((text or "")[a:b].lower())): z for a, b, z in parts if z > max(CLEAN_LOGIT, self.bias)}
        return -math.expm1(-sum(softplus(z) for z in (self.chance, *sorted(seen.values()))))

    def score(self, text: str | None) -> float:
        return self.combined(text, self.sentence_logits(text))

    def offending(self, text: str | None, least: float = 0.5) -> list[tuple[int, int, float]]:
        """(start, end, probability) of the sentences that reach a probability."""
        return [(a, b, p) for a, b, z in self.sentence_logits(text) if (p := 1 / (1 + math.exp(-z))) >= least]


CLEAN_LOGIT = math.log(CLEAN / (1 - CLEAN))
NOTHING = Model(-40.0, -40.0, {})


def softplus(z: float) -> float:
    return max(z, 0.0) + math.log1p(math.exp(-abs(z)))


def bag_of(text: str | None) -> list[frozenset[str]]:
    """The different sentences of a text, as sets of words."""
    return list(dict.fromkeys(frozenset(WORD.findall(x.lower())) for x in SENTENCE.findall(text or "")))


def features_of(sentence: Iterable[str]) -> set[str]:
    return {f for w in sentence for f in features(w)}


def log_odds(n: Column, hit: Column, base: float) -> Column:
    """Of toxicity among the documents with a feature against that among all, shrunken."""
    return F.log((hit + SHRINK * base) / (n - hit + SHRINK * (1 - base))) - math.log(base / (1 - base))


def fit_weights(y: np.ndarray, doc_of: np.ndarray, rows: np.ndarray, cols: np.ndarray, prior: np.ndarray, rounds: int = 200, rate: float = 0.1, ridge: float = 2e-4) -> tuple[float, float, np.ndarray]:
    """Noisy-or regression by Adam on all sentences at once: chance, bias, weights. doc_of has the document of each
    sentence, (rows, cols) its features; weights are pulled to half their log-odds."""
    s, size = len(doc_of), len(y)
    prior = 0.5 * prior
    w, ends = prior.copy(), np.array([-4.0, -4.0])
    m1, m2 = np.zeros(len(w) + 2), np.zeros(len(w) + 2)
    for t in range(1, rounds + 1):
        z = ends[1] + np.bincount(rows, w[cols], minlength=s)
        p, chance = 1 / (1 + np.exp(-z)), 1 / (1 + math.exp(-ends[0]))
        clean = np.bincount(doc_of, np.logaddexp(0, z), minlength=size) + np.logaddexp(0, ends[0])  # -log of the chance that all are clean
        # labels are not perfect: the pull of an unexplained positive is bounded by the floor
        p_doc = np.clip(-np.expm1(-clean), 1e-3, None)
        pull = np.where(y, (1 - p_doc) / p_doc, -1.0)
        g = pull[doc_of] * p
        grad = np.concatenate([-np.bincount(cols, g[rows], minlength=len(w)) / size + ridge * (w - prior), [-(pull * chance).sum() / size, -g.sum() / size]])
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad**2
        step = rate * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.99**t)) + 1e-6)
        w, ends = w - step[:-2], ends - step[-2:]
    return float(ends[0]), float(ends[1]), w


def sample_of(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int) -> DataFrame:
    """_id, _y, _t: the labelled rows that are learnt from."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("_id")).agg((F.max(label_col) > 0).cast("int").alias("_y"))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    chosen = F.broadcast(chosen) if sample <= BROADCAST_ROWS else chosen
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t")).join(chosen, "_id")
    return texts.groupBy("_id").agg(F.first("_y").alias("_y"), F.min(F.struct(F.xxhash64("_t"), "_t"))["_t"].alias("_t"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE_ROWS) -> Model:
    """Learns on the executors; the driver gets the features that have weights."""
    rows = materialize(sample_of(docs, labels, id_col, text_col, label_col, sample), "toxicity-sample")
    n_rows, n_toxic = rows.agg(F.count("*"), F.coalesce(F.sum("_y"), F.lit(0))).first()
    if not 0 < n_toxic < n_rows:
        return NOTHING
    base = n_toxic / n_rows

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["feature", "n", "hit"]

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64()), pa.array([hit.get(f, 0) for f in n], pa.int64())], names=names)

        n, hit = Counter(), Counter()
        for x in batches:
            for y, t in zip(x.column(0).to_pylist(), x.column(1)):
                found = set().union(*map(features_of, bag_of(t.as_py())))
                n.update(found)
                if y:
                    hit.update(found)
                if len(n) > REMEMBERED:
                    yield flush()
                    n, hit = Counter(), Counter()
        yield flush()

    counted = rows.select("_y", "_t").mapInArrow(count, "feature string, n long, hit long").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("hit").alias("hit"))
    kept = counted.filter(F.col("n") >= LEAST_DOCS).select("feature", log_odds(F.col("n"), F.col("hit"), base).alias("odds")).filter(F.col("odds") > LEAST_ODDS)
    kept = sorted((r["feature"], r["odds"]) for r in kept.collect())  # some of the sample's features
    if not kept:
        discard(rows)
        return NOTHING
    place = {f: i for i, (f, _) in enumerate(kept)}
    prior = np.array([v for _, v in kept])
    shared = docs.sparkSession.sparkContext.broadcast((place, prior))  # its size follows the sample

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value[0]
        for x in batches:
            sizes, cols = [], []
            for t in x.column(2):
                held = [sorted(at[f] for f in features_of(sentence) if f in at) for sentence in bag_of(t.as_py())]
                held = sorted(c for c in held if c)
                sizes.append(np.array([len(c) for c in held], "<i4").tobytes())
                cols.append(np.array([i for c in held for i in c], "<i4").tobytes())
            yield pa.RecordBatch.from_arrays([x.column(0), x.column(1), pa.array(sizes, pa.binary()), pa.array(cols, pa.binary())], names=["_id", "_y", "sizes", "cols"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y, in_doc, sizes, cols = [], [], [], []
        for x in batches:
            y += x.column(1).to_pylist()
            for a, b in zip(x.column(2).to_pylist(), x.column(3).to_pylist()):
                sizes.append(np.frombuffer(a, "<i4"))
                cols.append(np.frombuffer(b, "<i4"))
                in_doc.append(len(sizes[-1]))
        if not y:
            return
        sizes, cols = np.concatenate(sizes), np.concatenate(cols)
        doc_of = np.repeat(np.arange(len(y)), in_doc)
        chance, bias, w = fit_weights(np.array(y, bool), doc_of, np.repeat(np.arange(len(sizes)), sizes), cols, shared.value[1])
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *range(len(w))], pa.int32()), pa.array([chance, bias, *w.tolist()], pa.float64())], names=["place", "weight"])

    reduced = rows.select("_id", "_y", "_t").mapInArrow(reduce, f"_id {rows.schema['_id'].dataType.simpleString()}, _y int, sizes binary, cols binary")
    got = {r["place"]: r["weight"] for r in reduced.repartition(1).sortWithinPartitions("_id").mapInArrow(learn, "place int, weight double").collect()}
    discard(rows)
    return Model(got[-2], got[-1], {f: got[i] for f, i in place.items() if abs(got[i]) > 0.05})


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted, n_offending and the place of the worst sentence."""
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size follows the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            score, n, first, last = [], [], [], []
            for x in batch.column(1):
                text = x.as_py()
                parts = m.sentence_logits(text)
                worst = max(parts, key=lambda p: (p[2], -p[0]))
                score.append(m.combined(text, parts))
                n.append(sum(p[2] >= 0 for p in parts))
                first.append(worst[0])
                last.append(worst[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score, pa.float64()), pa.array([int(v >= 0.5) for v in score], pa.int32()), pa.array(n, pa.int64()), pa.array(first, pa.int64()), pa.array(last, pa.int64())],
                names=["doc_id", "score", "predicted", "n_offending", "worst_start", "worst_end"],
            )

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scored = picked.mapInArrow(run, f"doc_id {id_type}, score double, predicted int, n_offending long, worst_start long, worst_end long")
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", "predicted", "n_offending", "worst_start", "worst_end")
