"""Operators for groups, vocabularies and files of any size, against their plain forms."""

import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from textloom.operators import ids, ranking, vectors, vocabulary
from textloom.operators import topics as tp


def scored(spark, n=600):
    r = random.Random(n)
    rows = [(r.choice(["hot", "hot", "hot", "b", None]), i, float(r.choice([1, 2, 3, r.randint(4, 200)])) if i % 17 else None) for i in range(n)]
    return spark.createDataFrame([*rows, ("one", -1, 5.0), ("null", -2, None)], "g string, i int, s double")


@pytest.mark.parametrize("n", [1, 2, 7, 100, 10_000])
def test_top_of_hot_groups(spark, n):
    df = scored(spark)
    want = sorted(ranking.retain_top(df, ["g"], "s", n).collect(), key=str)
    got = ranking.retain_top_hot(df, ["g"], "s", n)
    assert got.columns == df.columns and sorted(got.collect(), key=str) == want


@pytest.mark.parametrize("share", [0.0, 0.01, 0.1, 0.5, 1.0])
def test_share_of_hot_groups(spark, share):
    df = scored(spark)
    assert sorted(ranking.retain_top_share_hot(df, ["g"], "s", share).collect(), key=str) == sorted(ranking.retain_top_share(df, ["g"], "s", share).collect(), key=str)


def test_hot_groups_checks(spark):
    df = scored(spark, 5)
    with pytest.raises(ValueError, match="starts at 1"):
        ranking.retain_top_hot(df, ["g"], "s", 0)
    with pytest.raises(ValueError, match="between 0 and 1"):
        ranking.retain_top_share_hot(df, ["g"], "s", 2)
    assert ranking.retain_top_hot(df.limit(0), ["g"], "s", 3).collect() == []


def test_first_rows(spark):
    df = scored(spark)
    order = [F.desc("s"), F.asc("i")]
    got = ranking.first_rows(df, ["g"], order, 5, ["i"]).collect()
    groups = {}
    for g, i, s in df.collect():
        groups.setdefault(g, []).append((-s if s is not None else 1e9, i))
    want = sorted((str(g), i, place) for g, rows in groups.items() for place, (_, i) in enumerate(sorted(rows)[:5], 1))
    assert sorted((str(r["g"]), r["i"], r["place"]) for r in got) == want


def test_no_task_sees_more_of_a_hot_group(spark):
    """A third of the scores of one group in each range, not all in one."""
    df = spark.range(9_000).select(F.lit("hot").alias("g"), F.col("id").alias("s"))
    places = ids.score_places(df, ["g"], "s")
    assert places.filter(F.col("before") != 8_999 - F.col("s")).count() == 0
    spark.range(1).count()
    parts = ids._ranges(df, [F.col("g"), F.desc("s")], "test").groupBy("_part").count().collect()
    assert len(parts) > 1 and max(r["count"] for r in parts) < 9_000 / 2


def test_dense_ids(spark):
    r = random.Random(1)
    rows = [(r.choice("abc"), k, "x") for k in r.sample(range(3_000), 700)] + [(None, 1, "x"), ("a", None, None)]
    df = spark.createDataFrame(rows, "_part string, _k0 int, _row string").repartition(5)
    got = ids.dense_ids(df, ["_part", "_k0"], "n").collect()
    want = sorted(rows, key=lambda x: (x[0] is not None, x[0] or "", x[1] is not None, x[1] or 0))
    assert [tuple(x[:3]) for x in sorted(got, key=lambda x: x["n"])] == want and sorted(x["n"] for x in got) == list(range(702))
    assert ids.dense_ids(df.limit(0), ["_k0"]).collect() == []


def test_numbered_lines(spark, tmp_path):
    """Ids follow files and lines, however the files are split."""
    for f in ("a", "b", "c"):
        (tmp_path / f"{f}.txt").write_text("".join(f"{f}{k}\n" for k in range({"a": 4_000, "b": 0, "c": 2_500}[f])))
    want = [*[f"a{k}" for k in range(4_000)], *[f"c{k}" for k in range(2_500)]]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "4k", "1k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = ids.numbered_lines(spark, str(tmp_path)).collect()
            assert [x["value"] for x in sorted(got, key=lambda x: x["line_id"])] == want and sorted(x["line_id"] for x in got) == list(range(6_500))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("binary", [False, True])
def test_sparse_vectors_are_those_of_the_driver(spark, binary):
    r = random.Random(3)
    docs = [(d, [r.choice("abcdefgh") for _ in range(r.randint(0, 30))]) for d in range(50)]
    frame = spark.createDataFrame(docs, "d int, terms array<string>")
    known = sorted(set("abcdef"))
    plain = {x["d"]: list(x["v"]) for x in vocabulary.term_vectors(frame, known, binary=binary).select("d", vector_to_array("features").alias("v")).collect() if sum(x["v"])}
    counts = frame.select("d", F.explode("terms").alias("term")).groupBy("d", "term").agg(F.count("*").alias("n"))
    ids_ = vocabulary.vocabulary(spark.createDataFrame([(w,) for w in known], "term string"))
    rows = vectors.sparse_rows(counts, ids_, ["d"], binary=binary)
    assert all(list(x["ids"]) == sorted(x["ids"]) for x in rows.collect())
    made = vectors.ml_vectors(rows, len(known))
    assert {x["d"]: list(x["v"]) for x in made.select("d", vector_to_array("features").alias("v")).collect()} == plain
    assert "Python" not in made._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="at most"):
        vectors.ml_vectors(rows, 1 << 31)


PLANTED = ["haus garten zaun dach", "motor auto rad strasse", "wasser fisch boot see"]


def test_online_topics_are_the_planted_ones(spark):
    """With smoothing of 0.1 for documents and terms the words of a topic come back together."""
    r = random.Random(7)
    docs = [(i, [w for t in ([i % 3] * 5 + [r.randrange(3)]) for w in r.choices(PLANTED[t].split(), k=6)]) for i in range(240)]
    frame = spark.createDataFrame(docs, "id int, terms array<string>")
    words = sorted({w for t in PLANTED for w in t.split()})
    features = vocabulary.term_vectors(frame, words).cache()
    model = tp.fit_lda(features, 3, 20, doc_concentration=0.1, topic_concentration=0.1)
    assert not model.isDistributed()
    found = {}
    rows = tp.topic_terms(model, words, 4).collect()
    for x in rows:
        found.setdefault(x["topic_id"], set()).add(x["term"])
    table = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "term string, term_id long")
    assert sorted(map(tuple, tp.topic_terms(model, table, 4).collect())) == sorted(map(tuple, rows))
    assert sorted(map(sorted, found.values())) == sorted(sorted(t.split()) for t in PLANTED)
    shares = {x["id"]: x["topics"] for x in tp.document_topics(model, features, ["id"]).collect()}
    assert all(abs(sum(t["score"] for t in s) - 1) < 1e-6 and s[0]["score"] > 0.5 for s in shares.values())
    row = tp.report(model, features, len(words)).first()
    assert (row["n_topics"], row["n_docs"], row["n_words"]) == (3, 240, 12) and row["log_likelihood_per_doc"] < 0
    features.unpersist()
