"""Topics by expectation maximisation over (document, term) rows, as joins and sums.

One step gives each row's n to the topics by weight of its term and share of its document, and sums that by document and
by term. Nothing of it is a model in a task: models of many groups are fitted together, keyed by group, and a group of most
rows is dealt by its documents and terms like all others. Documents are held in blocks, so that a term meets its weights and
leaves its sums once for each block, not for each document. The tables of weights and shares are written in every step, so
that a lost executor costs the step.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.clustering import LDAModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import discard, materialize
from . import em
from .ids import dense_ids
from .ranking import first_rows
from .tfidf import BROADCAST_TERMS, split_blocks

#: Groups whose totals are broadcast at most (k numbers each).
BROADCAST_GROUPS = 10_000


@dataclass(frozen=True)
class Mixtures:
    #: by, term, weights (array of k; each topic's sum to 1 over the terms of its group).
    terms: DataFrame
    #: by, doc, shares (array of k, sum 1).
    shares: DataFrame

    def named(self, term: str) -> Mixtures:
        return Mixtures(self.terms.withColumnRenamed("_w", term), self.shares)


def _noise(by: list[str], seed: int, i: int) -> Column:
    """What a topic weighs for a term at first, of their hash."""
    return F.lit(0.5) + F.pmod(F.xxhash64(*by, "_w", F.lit(seed * 1_000 + i)), F.lit(1 << 20)) / float(1 << 20)


def _normed(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return F.transform(values, lambda x: x / total)


def _sums(rows: DataFrame, keys: list[str], k: int, name: str, beyond: float = 0.0) -> DataFrame:
    """keys and the sums of an array _c of k numbers, each with something added."""
    sums = rows.groupBy(*keys).agg(*[F.sum(F.col("_c")[i]).alias(f"_s{i}") for i in range(k)])
    return sums.select(*keys, F.array(*[F.col(f"_s{i}") + beyond for i in range(k)]).alias(name))


def _given(rows: DataFrame, left: str, right: str) -> DataFrame:
    """_n of each row dealt over the topics: _c."""
    parts = F.zip_with(left, right, lambda w, s: w * s)
    total = F.aggregate("_p", F.lit(0.0), lambda a, x: a + x)
    return rows.withColumn("_p", parts).withColumn("_t", total).withColumn("_c", F.transform("_p", lambda x: F.when(F.col("_t") > 0, x * F.col("_n") / F.col("_t")).otherwise(0.0)))


def _concentrations(k: int, doc: float, topic: float) -> tuple[float, float]:
    """Given ones, or those that EM chooses by itself; EM takes ones above 1."""
    doc, topic = 50 / k + 1 if doc == -1 else doc, 1.1 if topic == -1 else topic
    if not (doc >= 1 and topic >= 1):
        raise ValueError(f"EM takes concentrations of 1 or above, not {doc} and {topic}")
    return doc, topic


def fit_mixtures(
    rows: DataFrame, by: list[str], doc: list[str], k: int = 20, iterations: int = 80, doc_concentration: float = -1, topic_concentration: float = -1, seed: int = 1, term: str = "term", count: str = "n"
) -> Mixtures:
    """A topic model of each group (by) of rows (by, doc, term, count). Without groups (by empty) one model of all rows.

    Defined results: rows whose count is null or not above 0 are left out; terms and documents are those of the rows; an
    empty table gives empty ones; a group of fewer terms than topics has topics that are alike.
    """
    alpha, eta = _concentrations(k, doc_concentration, topic_concentration)
    used = rows.filter(F.col(count) > 0).select(*by, *doc, F.col(term).alias("_w"), F.col(count).cast("double").alias("_n")).dropna(subset=[*by, *doc, "_w"])
    blocks = _blocks(used, by, doc, k)
    said = blocks.filter("code is not null").select("block", "code", *by, "_w")
    terms = materialize(said.select(*by, "_w").distinct().select(*by, "_w", F.array(*[_noise(by, seed, i) for i in range(k)]).alias("weights")), "mixture-terms")
    groups = max(1, terms.select(*by).distinct().count()) if by else 1
    step = None
    for _ in range(iterations):
        now = materialize(_step(blocks, said, terms, step, by, k, alpha), "mixture-step")
        now_terms = materialize(_weights(_sums(now.filter("_w is not null"), [*by, "_w"], k, "weights", eta - 1), by, k, groups), "mixture-terms")
        discard(terms, *([step] if step else []))
        terms, step = now_terms, now
    docs = blocks.filter("docs is not null").select("block", "docs")
    shares = docs.join(_shares(step), "block") if step else docs.withColumn("_s", F.array_repeat(F.lit(1.0), F.size("docs") * k))
    each = shares.select("_s", F.posexplode("docs").alias("_at", "_d")).select(*[F.col("_d")[c].alias(c) for c in [*by, *doc]], F.slice("_s", F.col("_at") * k + 1, k).alias("shares"))
    own = F.transform("shares", lambda x: F.greatest(x - (alpha - 1), F.lit(0.0)))
    return Mixtures(terms.withColumnRenamed("_w", term), each.select(*by, *doc, _normed(own).alias("shares")))


#: Rows (document and term) of a block, about, times topics: what its terms' weights take.
BLOCK_WEIGHTS = 2_000_000


def _blocks(rows: DataFrame, by: list[str], doc: list[str], k: int) -> DataFrame:
    """Documents by blocks in which a term of a group has a code: a written table of two kinds of rows, as stem_blocks has them. Of
    a block there is one row with docs, an array of (by, doc, codes, counts), and for each of its terms one of (code, by, _w)."""
    bags = rows.groupBy(*by, *doc).agg(F.collect_list(F.struct("_w", "_n")).alias("_v"))
    # documents of a group have terms in common
    bags = bags.sortWithinPartitions(*by) if by else bags
    schema, n_keys = rows.schema, len(by) + len(doc)
    typed = lambda names, sep: ", ".join(f"`{c}`{sep} {schema[c].dataType.simpleString()}" for c in names)
    most = max(1, BLOCK_WEIGHTS // k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 33
        for batch in batches:
            for first, size in split_blocks(batch.column(n_keys), most, batch.num_rows):
                part, block = batch.slice(first, size), block + 1
                at = pa.array(np.r_[0, np.cumsum(pc.list_value_length(part.column(n_keys)).to_numpy(zero_copy_only=False))], pa.int32())
                words, counts = part.column(n_keys).flatten().flatten()
                doc_of = np.repeat(np.arange(size), np.diff(at.to_numpy()))
                # a term's code stands for its group's term
                groups = np.zeros(size, np.int64)
                for c in part.columns[: len(by)]:
                    e = c.dictionary_encode()
                    groups = np.unique(groups * len(e.dictionary) + e.indices.to_numpy(), return_inverse=True)[1].reshape(-1)
                e = words.dictionary_encode()
                _, where, codes = np.unique(groups[doc_of] * len(e.dictionary) + e.indices.to_numpy(), return_index=True, return_inverse=True)
                different = len(where)
                lists = [pa.ListArray.from_arrays(at, x) for x in (pa.array(codes.reshape(-1), pa.int32()), counts)]
                each = pa.StructArray.from_arrays([*part.columns[:n_keys], *lists], names=[*by, *doc, "codes", "counts"])
                of_docs = pa.ListArray.from_arrays(pa.array([0, size], pa.int32()), each)
                own = [c.take(pa.array(doc_of[where])) for c in part.columns[: len(by)]]
                columns = [
                    [pa.array([block] * (different + 1), pa.int64())], [of_docs, pa.nulls(different, of_docs.type)], [pa.nulls(1, pa.int32()), pa.array(np.arange(different), pa.int32())],
                    *[[pa.nulls(1, c.type), c] for c in [*own, words.take(pa.array(where))]],
                ]
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in columns], names=["block", "docs", "code", *by, "_w"])

    types = f"block long, docs array<struct<{typed([*by, *doc], ':')}, codes: array<int>, counts: array<double>>>, code int, {typed([*by, '_w'], '')}"
    return materialize(bags.mapInArrow(run, types), "mixture-blocks")


def _shares(step: DataFrame) -> DataFrame:
    return step.filter("_s is not null").select("block", "_s")


def _step(blocks: DataFrame, said: DataFrame, terms: DataFrame, before: DataFrame | None, by: list[str], k: int, alpha: float) -> DataFrame:
    """One step over all blocks: of a block a row with _s, its documents' shares one behind the other, and for each of its terms a
    row (by, _w) with _c, what its occurrences give to each topic. before: the step before, if there was one."""
    weighed = said.join(terms, [*by, "_w"]).groupBy("block").agg(F.collect_list(F.struct("code", *by, "_w", "weights")).alias("w"))
    both = blocks.filter("docs is not null").select("block", F.col("docs.codes").alias("codes"), F.col("docs.counts").alias("counts")).join(weighed, "block")
    both = both.join(_shares(before), "block") if before else both.withColumn("_s", F.lit(None).cast("array<double>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                codes, counts, w, s = (batch.column(c).slice(i, 1).flatten() for c in ("codes", "counts", "w", "_s"))
                doc_of = np.repeat(np.arange(len(codes)), pc.list_value_length(codes).to_numpy(zero_copy_only=False))
                code, *names, weights = w.flatten()
                place = np.empty(len(code), np.int64)
                place[code.to_numpy()] = np.arange(len(code))
                at = place[codes.flatten().to_numpy()]
                shares = s.to_numpy().reshape(-1, k) if len(s) else np.ones((len(codes), k))
                given = weights.flatten().to_numpy().reshape(-1, k)[at] * shares[doc_of]
                total = given.sum(axis=1)
                given *= np.divide(counts.flatten().to_numpy(), total, out=np.zeros_like(total), where=total > 0)[:, None]
                summed = lambda of, n: np.stack([np.bincount(of, given[:, j], n) for j in range(k)], axis=1).reshape(-1)  # noqa: B023, E731
                lists = [pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * m, pa.int32()), pa.array(x)) for n, m, x in ((1, len(codes) * k, summed(doc_of, len(codes)) + (alpha - 1)), (len(code), k, summed(at, len(code))))]
                columns = [[batch.column("block").slice(i, 1), pa.nulls(len(code), pa.int64())], [lists[0], pa.nulls(len(code), lists[0].type)], *[[pa.nulls(1, c.type), c] for c in names], [pa.nulls(1, lists[1].type), lists[1]]]
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in columns], names=["block", "_s", *by, "_w", "_c"])

    types = ", ".join(f"`{c}` {said.schema[c].dataType.simpleString()}" for c in [*by, "_w"])
    return both.select("block", "codes", "counts", "w", "_s").mapInArrow(run, f"block long, _s array<double>, {types}, _c array<double>")


def _weights(counts: DataFrame, by: list[str], k: int, groups: int) -> DataFrame:
    """Counts of terms as shares of their topics' totals in their group."""
    totals = counts.groupBy(*by).agg(F.array(*[F.sum(F.col("weights")[i]) for i in range(k)]).alias("_all"))
    few = F.broadcast(totals) if groups <= BROADCAST_GROUPS else totals
    both = counts.join(few, by) if by else counts.crossJoin(few)  # without groups one row
    return both.select(*by, "_w", F.zip_with("weights", "_all", lambda w, a: F.when(a > 0, w / a).otherwise(0.0)).alias("weights"))


def training_shares(rows: DataFrame, weights: DataFrame, doc: list[str], k: int, iterations: int = 20, doc_concentration: float = -1, term: str = "term", count: str = "n") -> DataFrame:
    """doc, shares (array of k, sum 1): the posterior that EM has of its training documents, found by its steps with the topics'
    term weights (term, weights) held fast. Terms without weights are left out, and so are documents without others."""
    alpha, _ = _concentrations(k, doc_concentration, -1)
    known = rows.filter(F.col(count) > 0).select(*doc, F.col(term).alias("_w"), F.col(count).cast("double").alias("_n")).join(weights.select(F.col(term).alias("_w"), "weights"), "_w")
    known = known.filter(F.exists("weights", lambda w: w > 0)).repartition(*doc).persist()
    shares = None
    for _ in range(max(1, iterations)):
        rows_now = known.join(shares, doc) if shares else known.withColumn("shares", F.array(*[F.lit(1.0)] * k))
        after = materialize(_sums(_given(rows_now, "weights", "shares"), doc, k, "shares", alpha - 1), "training-shares")
        if shares:
            discard(shares)
        shares = after
    known.unpersist()
    return shares.select(*doc, _normed(F.transform("shares", lambda x: F.greatest(x - (alpha - 1), F.lit(0.0)))).alias("shares"))


def term_weights(model: LDAModel, size: int, name: str = "term") -> DataFrame:
    """term (its place in the vocabulary), weights (array over topics) of a fitted model of so many terms."""
    topics = model.describeTopics(max(size, 1))
    each = topics.select("topic", F.explode(F.arrays_zip("termIndices", "termWeights")).alias("x")).select("topic", F.col("x.termIndices").cast("long").alias(name), F.col("x.termWeights").alias("w"))
    rows = each.groupBy(name).agg(F.sort_array(F.collect_list(F.struct("topic", "w"))).alias("_w"))
    return rows.select(name, F.transform("_w", lambda x: x["w"]).alias("weights"))


def best_terms(fitted: Mixtures, by: list[str], n: int = 10, term: str = "term") -> DataFrame:
    """by, topic, place (from 1), term, weight of each topic's n heaviest terms; ties by name."""
    each = fitted.terms.select(*by, term, F.posexplode("weights").alias("topic", "weight"))
    rows = first_rows(each, [*by, "topic"], [F.desc("weight"), F.asc(term)], n, [term])
    return rows.select(*by, "topic", "place", term, "weight")


def fit_small(
    rows: DataFrame, by: list[str], doc: list[str], k: int = 20, iterations: int = 80, doc_concentration: float = -1, topic_concentration: float = -1, seed: int = 1, term: str = "term", count: str = "n"
) -> Mixtures:
    """fit_mixtures, where all groups' weights are few enough to be broadcast to a step (em.MOST_NUMBERS): documents stay in the
    files of their blocks, and nothing is shuffled in a step. More are fitted as fit_mixtures does."""
    alpha, eta = _concentrations(k, doc_concentration, topic_concentration)
    used = rows.filter(F.col(count) > 0).select(*by, *doc, F.col(term).alias("_w"), F.col(count).cast("double").alias("_n")).dropna(subset=[*by, *doc, "_w"])
    used = materialize(used.groupBy(*by, *doc, "_w").agg(F.sum("_n").alias("_n")), "mixture-rows")
    known = materialize(dense_ids(used.select(*by, "_w").distinct(), [*by, "_w"], "_code"), "mixture-codes")
    n = known.count()
    if not n or iterations < 1 or n * k > em.MOST_NUMBERS:
        return fit_mixtures(used, by, doc, k, iterations, doc_concentration, topic_concentration, seed, "_w", "_n").named(term)
    # a group's terms have numbers in a row
    bounds = known.groupBy(*by).agg(F.min("_code").alias("_first")) if by else known.agg(F.min("_code").alias("_first"))
    first = np.sort(bounds.select("_first").toArrow()["_first"].to_numpy())
    start = known.select("_code", F.array(*[_noise(by, seed, i) for i in range(k)]).alias("weights")).toArrow()
    weights = np.empty((n, k))
    weights[start["_code"].to_numpy()] = start["weights"].combine_chunks().flatten().to_numpy().reshape(-1, k)
    coded = used.join(F.broadcast(known) if n <= BROADCAST_TERMS else known, [*by, "_w"])
    bags = coded.groupBy(*by, *doc).agg(F.sort_array(F.collect_list(F.struct("_code", "_n"))).alias("_v"))
    parts = bags.select(F.struct(*by, *doc).alias("key"), F.transform("_v", lambda x: x["_code"]).alias("ids"), F.transform("_v", lambda x: x["_n"]).alias("counts"))
    # documents of a group have terms in common
    parts = materialize(parts.sortWithinPartitions("key"), "mixture-bags")
    fitted = em.fit(parts, "key", n, k, iterations, alpha, eta, seed, first, weights)
    made = used.sparkSession.createDataFrame(pa.table({"_code": np.arange(n), "weights": pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * k, pa.int32()), pa.array(fitted.weights().T.reshape(-1)))}))
    terms = materialize(known.join(made, "_code").select(*by, F.col("_w").alias(term), "weights"), "mixture-terms")
    return Mixtures(terms, fitted.shares(used.sparkSession).select("id.*", "shares"))
