"""EM over blocks of documents against an EM of its own, by the formulas of MLlib's optimizer."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from textloom import queries
from textloom.operators import em, mixtures, vectors
from textloom.operators import topics as tp
from textloom.plans import apps

K, ALPHA, ETA = 3, 1.7, 1.2


def bags(n: int = 90) -> list[tuple[int, list[int], list[float]]]:
    r = random.Random(5)
    out = []
    for d in range(n):
        words = r.choices(range(4 * (d % 3), 4 * (d % 3) + 4), k=20) + r.choices(range(12), k=3)
        ids = sorted(set(words))
        out.append((d, ids, [float(words.count(i)) for i in ids]))
    return out


def plain_em(rows, seeds, iterations: int, seed: int):
    """Counts of documents and terms, log-likelihood."""
    gamma = {}
    for d, ids, counts in rows:
        for i, n in zip(ids, counts):
            p = np.array([em._starts(np.array([i]), np.array([0]), np.array([seeds[d]], np.uint64), seed, j)[0] for j in range(K)])
            gamma[d, i] = n * p / p.sum()
    for _ in range(iterations + 1):
        docs = {d: sum(gamma[d, i] for i in ids) for d, ids, _ in rows}
        terms = np.zeros((12, K))
        for (_, i), g in gamma.items():
            terms[i] += g
        weights = (terms + ETA - 1) / (terms.sum(axis=0) + 12 * (ETA - 1))
        fits = 0.0
        for d, ids, counts in rows:
            theta = docs[d] + ALPHA - 1
            for i, n in zip(ids, counts):
                p = weights[i] * theta
                gamma[d, i] = n * p / p.sum()
                fits += n * np.log(weights[i] @ (theta / theta.sum()))
    return docs, terms, fits


def fitted(spark, rows, iterations: int):
    frame = spark.createDataFrame(rows, "id int, ids array<long>, counts array<double>")
    made = vectors.ml_vectors(frame, 12)
    return made, tp.fit_lda(made, K, iterations, ALPHA, ETA, seed=4)


@pytest.mark.parametrize("block,looked", [(50_000, 1_000_000), (40, 30)])
def test_topics_are_those_of_em_without_a_graph(spark, monkeypatch, block, looked):
    """one block or many, whole or in pieces."""
    for name, value in (("LEAST_BLOCK", block), ("BLOCK", block), ("LOOKED", looked)):
        monkeypatch.setattr(em, name, value)
    rows = bags()
    made, model = fitted(spark, rows, 6)
    assert not model.isDistributed() and model.vocabSize() == 12
    seeds = {r["id"]: r["s"] & (1 << 64) - 1 for r in made.select("id", F.xxhash64("id").alias("s")).collect()}
    _, terms, _ = plain_em(rows, seeds, 6, 4)
    assert np.abs(model.topicsMatrix().toArray() - terms).max() < 1e-9
    for x in tp.topic_terms(model, [str(i) for i in range(12)], 4).collect():
        assert abs(x["weight"] - terms[int(x["term"]), x["topic_id"]] / terms[:, x["topic_id"]].sum()) < 1e-9


def test_documents_are_counted_where_they_are(spark):
    """only lines that share an id are shuffled."""
    lines = [(1, "Haus Haus Garten und"), (2, "Auto Auto Rad"), (3, None), (None, "Haus")]
    options = apps.LdaOptions(vocab_size=3)
    for extra in ([], [(2, "Rad Auto x"), (None, "Garten Haus")]):
        features, words, size = apps.lda_corpus(spark.createDataFrame(lines + extra, "doc_id int, text string"), options, "text", key="doc_id")
        names = {r["term_id"]: r["term"] for r in words.collect()}
        want = {}
        for d, text in lines + extra:
            for w in (text or "").lower().split():
                if w in names.values():
                    want.setdefault(d, {}).setdefault(w, 0)
                    want[d][w] += 1
        parts = vectors.vector_parts(features).collect()
        assert size == 3 and len(parts) == len(want) and all(list(r["ids"]) == sorted(r["ids"]) for r in parts)
        assert {r["id"]: {names[i]: int(n) for i, n in zip(r["ids"], r["counts"])} for r in parts} == want


def test_nothing_to_fit(spark):
    made, model = fitted(spark, [], 2)
    assert made.count() == 0 and not np.asarray(model.topicsMatrix().toArray()).any()


def test_shares_of_training_documents_are_those_of_em(spark, monkeypatch):
    """the counts that EM ends with, which needs no steps after the fit."""
    monkeypatch.setattr(em, "LEAST_BLOCK", 40)
    monkeypatch.setattr(em, "BLOCK", 40)
    rows = bags()
    made, model = fitted(spark, rows, 5)
    seeds = {r["id"]: r["s"] & (1 << 64) - 1 for r in made.select("id", F.xxhash64("id").alias("s")).collect()}
    docs, _, _ = plain_em(rows, seeds, 5, 4)
    got = {r["id"]: np.array(r["shares"]) for r in model._fitted.shares(spark).collect()}
    assert got.keys() == docs.keys() and all(np.abs(got[d] - docs[d] / docs[d].sum()).max() < 1e-9 for d in docs)


def test_shares_query_has_all_documents(spark, monkeypatch):
    """no joins of a document's terms in the query."""
    monkeypatch.setattr(queries.mixtures, "training_shares", None)
    rows = queries.lda_training_shares(spark, "/root/testdata/sf0.001").collect()
    assert all(0.05 < r["score"] <= 1 + 1e-9 for r in rows) and {r["topic_id"] for r in rows} <= set(range(20))


def test_report_of_a_fit(spark, monkeypatch):
    """the log-likelihood of the training documents, without a graph."""
    monkeypatch.setattr(em, "LEAST_BLOCK", 40)
    monkeypatch.setattr(em, "BLOCK", 40)
    rows = bags()
    made, model = fitted(spark, rows, 5)
    seeds = {r["id"]: r["s"] & (1 << 64) - 1 for r in made.select("id", F.xxhash64("id").alias("s")).collect()}
    _, _, fits = plain_em(rows, seeds, 5, 4)
    row = tp.report(model, made, 12).first()
    assert (row["n_topics"], row["n_docs"], row["n_words"]) == (3, 90, 12) and abs(row["log_likelihood_per_doc"] - fits / 90) < 1e-9


def test_topics_of_documents_are_inferred_as_mllib_does(spark):
    """the local model of a fit infers what MLlib's model of the same counts does."""
    rows = bags()
    made = fitted(spark, rows, 0)[0]
    model = tp.fit_lda(made, K, 60, 1.05, 1.05, seed=4)
    got = {r["id"]: r["topics"] for r in tp.document_topics(model, made, ["id"], 1).collect()}
    assert len(got) == 90 and all(t[0]["score"] > 0.5 for t in got.values())
    assert all(len({got[d][0]["topicId"] for d in range(g, 90, 3)}) == 1 for g in range(3))


def test_articles_run_with_the_defaults(spark, monkeypatch):
    """F8: 50 topics in 70 iterations, as the application has them."""
    asked = []
    monkeypatch.setattr(queries.articles, "assemble", lambda made, as_of, options=queries.articles.Options(): asked.append(options))
    queries._assembled(spark, "/root/testdata/sf0.001")
    assert [(o.topics, o.iterations) for o in asked] == [(50, 70)]


@pytest.mark.parametrize("by,block,most", [(["g"], 50_000, 1 << 20), (["g"], 60, 1 << 20), ([], 60, 1 << 20), (["g"], 60, 10)])
def test_mixtures_without_a_shuffle_in_a_step_are_the_same(spark, monkeypatch, by, block, most):
    """groups' weights that are few are broadcast, others are joined."""
    for name, value in (("LEAST_BLOCK", block), ("BLOCK", block), ("MOST_NUMBERS", most)):
        monkeypatch.setattr(em, name, value)
    r = random.Random(2)
    rows = [(g, d, f"w{w}", r.randint(1, 3)) for g in "ab" for d in range(30) for w in r.sample(range(12), 5)] + [("c", 1, "x", 1), ("c", 2, "x", 0), ("a", None, "w1", 1)]
    frame = spark.createDataFrame(rows, "g string, d int, term string, n int")
    doc = ["d"] if by else ["g", "d"]
    want, got = (f(frame, by, doc, 2, 5, seed=3) for f in (mixtures.fit_mixtures, mixtures.fit_small))
    for name, keys, value in (("terms", [*by, "term"], "weights"), ("shares", [*by, *doc], "shares")):
        a, b = ({tuple(x[c] for c in keys): np.array(x[value]) for x in getattr(m, name).collect()} for m in (want, got))
        assert a.keys() == b.keys() and all(np.abs(a[x] - b[x]).max() < 1e-9 for x in a)


def test_comments_run_with_the_defaults(spark, monkeypatch):
    """20 topics in 80 iterations for the comments of each topic."""
    asked = []
    monkeypatch.setattr(queries, "_assembled", lambda *_: None)
    monkeypatch.setattr(queries.articles, "comment_topics", lambda result, k=20, iterations=80, **_: asked.append((k, iterations)))
    queries.comment_topics(spark, "/root/testdata/sf0.001")
    assert asked == [(20, 80)]
