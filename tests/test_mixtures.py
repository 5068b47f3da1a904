import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from textloom.operators import mixtures, vocabulary
from textloom.operators import topics as tp

PLANTED = {"g": ["haus garten zaun dach", "motor auto rad strasse"], "h": ["wasser fisch boot see", "brot ofen mehl salz"]}


def planted(seed=1, docs=80):
    """Documents of one topic each, with a word of the other now and then; group g has most rows."""
    r = random.Random(seed)
    rows = []
    for g, topics in PLANTED.items():
        for d in range(docs * (6 if g == "g" else 1) // 4):
            words = r.choices(topics[d % 2].split(), k=8) + r.choices(topics[(d + 1) % 2].split(), k=1)
            rows += [(g, d, w, words.count(w)) for w in set(words)]
    return rows


def test_planted_topics_of_each_group(spark):
    rows = spark.createDataFrame([*planted(), ("g", 0, "null", None), ("g", 1, "zero", 0)], "g string, d int, term string, n int")
    fitted = mixtures.fit_mixtures(rows, ["g"], ["d"], k=2, iterations=30, doc_concentration=1.1, topic_concentration=1.01)
    found = {}
    for x in mixtures.best_terms(fitted, ["g"], 4).collect():
        found.setdefault((x["g"], x["topic"]), set()).add(x["term"])
    for g, topics in PLANTED.items():
        assert sorted(sorted(found[g, t]) for t in (0, 1)) == sorted(sorted(t.split()) for t in topics)
    shares = {(x["g"], x["d"]): x["shares"] for x in fitted.shares.collect()}
    assert all(abs(sum(s) - 1) < 1e-9 and max(s) > 0.7 for s in shares.values())
    for g in PLANTED:
        even, odd = (np.mean([np.argmax(shares[g, d]) for d in range(k, 20, 2)]) for k in (0, 1))
        assert {even, odd} == {0.0, 1.0}
    sums = fitted.terms.groupBy("g").agg(*[F.sum(F.col("weights")[i]).alias(f"s{i}") for i in (0, 1)]).collect()
    assert all(abs(x[f"s{i}"] - 1) < 1e-9 for x in sums for i in (0, 1))


def numpy_em(rows, k, iterations, alpha, eta, start):
    """The same steps on dense matrices."""
    docs, terms = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    n = np.zeros((len(docs), len(terms)))
    for d, t, c in rows:
        n[docs.index(d), terms.index(t)] = c
    weights, shares = np.array([start[t] for t in terms]), np.ones((len(docs), k))
    for _ in range(iterations):
        p = shares[:, None, :] * weights[None]
        c = n[..., None] * p / p.sum(axis=2, keepdims=True)
        shares, counts = c.sum(axis=1) + alpha - 1, c.sum(axis=0) + eta - 1
        if eta:
            weights = counts / counts.sum(axis=0)
    own = shares - (alpha - 1)
    return {d: own[i] / own[i].sum() for i, d in enumerate(docs)}, {t: weights[i] for i, t in enumerate(terms)}


@pytest.mark.parametrize("alpha", [-1, 1.0, 2.5])
def test_shares_against_an_independent_em(spark, alpha):
    """With weights held fast, and without groups a whole fit from the same start."""
    r = np.random.default_rng(5)
    rows = [(int(d), f"t{t}", int(r.integers(1, 5))) for d in range(12) for t in r.choice(15, 6, replace=False)]
    weights = {f"t{t}": r.dirichlet(np.ones(3)).tolist() for t in range(15)}
    frame = spark.createDataFrame(rows, "d int, term string, n int")
    table = spark.createDataFrame(list(weights.items()), "term string, weights array<double>")
    got = {x["d"]: np.array(x["shares"]) for x in mixtures.training_shares(frame, table, ["d"], 3, 6, doc_concentration=alpha).collect()}
    value = 50 / 3 + 1 if alpha == -1 else alpha
    docs, terms = sorted({x[0] for x in rows}), sorted(weights)
    n, w = np.zeros((len(docs), len(terms))), np.array([weights[t] for t in terms])
    for d, t, c in rows:
        n[docs.index(d), terms.index(t)] = c
    shares = np.ones((len(docs), 3))
    for _ in range(6):
        p = shares[:, None, :] * w[None]
        shares = (n[..., None] * p / p.sum(axis=2, keepdims=True)).sum(axis=1) + value - 1
    own = shares - (value - 1)
    for i, d in enumerate(docs):
        assert abs(got[d].sum() - 1) < 1e-9 and np.abs(got[d] - own[i] / own[i].sum()).max() < 1e-9


def test_a_fit_against_an_independent_em(spark):
    rows = [(d, t, n) for g, d, t, n in planted(3, 20) if g == "h"]
    frame = spark.createDataFrame(rows, "d int, term string, n int")
    start = {x["term"]: x["weights"] for x in mixtures.fit_mixtures(frame, [], ["d"], 2, 0, 1.5, 1.2).terms.collect()}
    fitted = mixtures.fit_mixtures(frame, [], ["d"], 2, 4, 1.5, 1.2)
    shares, weights = numpy_em(rows, 2, 4, 1.5, 1.2, start)
    assert all(np.abs(np.array(x["shares"]) - shares[x["d"]]).max() < 1e-9 for x in fitted.shares.collect())
    assert all(np.abs(np.array(x["weights"]) - weights[x["term"]]).max() < 1e-9 for x in fitted.terms.collect())


def test_shares_of_a_fitted_model(spark):
    """Training documents of one planted topic belong to one topic of the model."""
    rows = [(d, t, n) for g, d, t, n in planted(4, 100) if g == "g"]
    frame = spark.createDataFrame(rows, "d int, term string, n int")
    words = sorted({t for _, t, _ in rows})
    bags = frame.groupBy("d").agg(F.flatten(F.collect_list(F.array_repeat("term", F.col("n")))).alias("terms"))
    model = tp.fit_lda(vocabulary.term_vectors(bags, words), 2, 30, 1.1, 1.1)
    each = vocabulary.term_vectors(bags, words).select("d", F.posexplode(vector_to_array("features")).alias("term", "n")).filter("n > 0").withColumn("term", F.col("term").cast("long"))
    got = {x["d"]: x["shares"] for x in mixtures.training_shares(each, mixtures.term_weights(model, len(words)), ["d"], 2, 20, 1.1).collect()}
    assert len(got) == len({d for d, _, _ in rows}) and all(abs(sum(s) - 1) < 1e-9 for s in got.values())
    even, odd = ({int(np.argmax(s)) for d, s in got.items() if d % 2 == k} for k in (0, 1))
    assert len(even) == len(odd) == 1 and even != odd


def test_nothing_and_bad_concentrations(spark):
    none = spark.createDataFrame([], "g string, d int, term string, n int")
    fitted = mixtures.fit_mixtures(none, ["g"], ["d"], 2, 2)
    assert fitted.terms.collect() == [] and fitted.shares.collect() == []
    with pytest.raises(ValueError, match="1 or above"):
        mixtures.fit_mixtures(none, ["g"], ["d"], 2, 2, doc_concentration=0.5)
