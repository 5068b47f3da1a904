import json
import math

import pytest
from pyspark.sql import functions as F

from textloom.functions.text import single_terms
from textloom.functions.words import written_forms
from textloom.operators import counts, ranking, tfidf, vocabulary
from textloom.operators import opinions as ops
from textloom.operators import topics as tp
from textloom.plans import apps, articles
from textloom.sources import readers, sinks
from textloom.streaming.activity import daily_activity


def scores(spark, corpus, min_df):
    docs = spark.createDataFrame(list(enumerate(corpus)), "doc long, text string")
    tf = tfidf.augmented_tf(docs.select("doc", tfidf_words(F.col("text")).alias("terms")), ["doc"])
    return {(r["doc"], r["term"]): r["score"] for r in tfidf.tfidf(tf, docs, ["doc"], min_df).collect()}


def tfidf_words(text):
    return single_terms(text)


def test_tfidf(spark):
    one, two = "word1 word1 word2 word1 word2 word3 word1", "word4 word4 word5 word4 word5 word6 word1"
    assert scores(spark, [one], 1) == {}
    half = math.log(3 / 2)
    got = scores(spark, [one, two], 1)
    expected = {(0, "word2"): 0.5 * half, (0, "word3"): 0.25 * half, (1, "word4"): half, (1, "word5"): 2 / 3 * half, (1, "word6"): 1 / 3 * half}
    assert got.keys() == expected.keys() and all(abs(got[k] - v) < 1e-12 for k, v in expected.items())
    assert scores(spark, [one, two], 2) == {}


def test_idf_against_ml(spark):
    from pyspark.ml.feature import IDF, CountVectorizer

    rows = spark.createDataFrame([(["a", "b"],), (["a"],), (["b", "c"],), (["d"],)], "terms array<string>")
    vectors = CountVectorizer(inputCol="terms", outputCol="v").fit(rows)
    model = IDF(inputCol="v", outputCol="w", minDocFreq=2).fit(vectors.transform(rows))
    theirs = dict(zip(vectors.vocabulary, model.idf.toArray()))
    freq = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    ours = {r["term"]: r["idf"] for r in tfidf.idf(freq, 4, 2).collect()}
    assert ours.keys() == theirs.keys() and all(abs(ours[k] - theirs[k]) < 1e-12 for k in ours)


def test_surface_forms_and_stems(spark):
    tf = spark.createDataFrame([(1, "Menschen", 1.0), (1, "Mensch", 0.5), (2, "Menschen", 1.0)], "d int, term string, tf double")
    assert tfidf.surface_forms(tf).first()[:2] == ("mensch", "Menschen")
    assert {(r["d"], r["term"]): r["tf"] for r in tfidf.stemmed_tf(tf, ["d"]).collect()} == {(1, "mensch"): 1.5, (2, "mensch"): 1.0}


TERMS = [("hello", 0.1), ("world", 0.3), ("you", 0.35), ("lorenz", 0.2)]


@pytest.mark.parametrize("n, kept", [(1, {"you"}), (2, {"you", "world"})])
def test_top(spark, n, kept):
    rows = spark.createDataFrame([(1, *t) for t in TERMS], "d int, t string, s double")
    assert {r["t"] for r in ranking.retain_top(rows, ["d"], "s", n).collect()} == kept


@pytest.mark.parametrize("share, n", [(0.1, 1), (0.3, 1), (0.6, 2), (1.0, 4), (0.0, 1)])
def test_top_share(spark, share, n):
    rows = spark.createDataFrame([(1, *t) for t in TERMS], "d int, t string, s double")
    assert ranking.retain_top_share(rows, ["d"], "s", share).count() == n


def test_top_keeps_ties_and_checks(spark):
    rows = spark.createDataFrame([(1, s) for s in (0.1, 0.3, 0.3, 0.35)], "d int, s double")
    assert ranking.retain_top(rows, ["d"], "s", 2).count() == 3
    for bad in (-0.1, 1.1):
        with pytest.raises(ValueError):
            ranking.retain_top_share(rows, ["d"], "s", bad)
    with pytest.raises(ValueError):
        ranking.retain_top(rows, ["d"], "s", 0)


@pytest.mark.parametrize("values, n, expected", [([2, 4, 3, 1], 2, 3), ([4, 3], 2, 3), ([4], 2, 4)])
def test_nth_largest(spark, values, n, expected):
    assert spark.createDataFrame([(values,)], "v array<int>").select(ranking.nth_largest(F.col("v"), n)).first()[0] == expected


def test_counts_and_vocabulary(spark):
    lines = spark.createDataFrame([("b a, b",), ("",), (" c!",)], "value string")
    assert dict(counts.word_count(lines).collect()) == {"a": 1, "b": 2, "c": 1}
    assert counts.total_words(lines).first()[0] == 4 and counts.line_count(lines).first()[0] == 3
    terms = spark.createDataFrame([(t,) for t in ("zz", "a", "ab", "a", "ä")], "term string")
    assert [(r["term"], r["term_id"]) for r in vocabulary.vocabulary(terms).orderBy("term").collect()] == [("a", 0), ("ab", 1), ("zz", 2), ("ä", 3)]
    assert [r["word"] for r in vocabulary.top_words(counts.word_count(lines), 2).collect()] == ["b", "a"]


LINES = [
    {"_id": "u1", "date_published": "2014-12-23T14:00:11Z", "title": "Ein Titel", "lead": None, "text": "Die Menschen im Haus", "tags": ["Zürich", "Sport"], "author": "x", "comments": [{"id": "c1", "text": "Das Haus ist schön", "votes_up": 3, "date_created": "2014-12-23T15:00:00Z"}, {"id": "c2", "text": None}]},
    {"_id": "u2", "text": "Menschen und Häuser", "tags": ["sport"], "comments": [{"id": "c1", "text": "Häuser sind teuer"}]},
    {"_id": "u3"},
]


@pytest.fixture(scope="module")
def sample(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("in") / "a.json"
    path.write_text("\n".join(map(json.dumps, LINES)))
    return readers.read_articles(spark, str(path))


def test_read_articles(spark, sample, tmp_path):
    rows = {r["_id"]: r for r in sample.collect()}
    assert rows["u3"]["text"] is None and rows["u3"]["comments"] is None and rows["u1"]["date_published"].year == 2014
    line = sample.filter("_id = 'u1'").select("_id", "date_published", "lead").select(sinks.to_json_line("_id", "date_published", "lead")).first()[0]
    assert line == '{"_id":"u1","date_published":"2014-12-23T14:00:11Z"}'
    for bad in ("{nonsense", '{"text": "no id"}'):
        (tmp_path / "bad.json").write_text(bad)
        with pytest.raises(Exception, match="can't parse article line"):
            readers.read_articles(spark, str(tmp_path / "bad.json")).collect()


def test_create_docs(sample):
    docs = {(r["article_id"], r["comment_id"]): r["text"] for r in articles.create_docs(sample).collect()}
    assert docs == {("u1", ""): "Ein Titel  Die Menschen im Haus", ("u1", "c1"): "Das Haus ist schön", ("u2", ""): "  Menschen und Häuser", ("u2", "c1"): "Häuser sind teuer", ("u3", ""): "  "}


def test_assembly_and_sinks(spark, tmp_path):
    rows = [(f"u{i}", f"Haus{'abc'[i % 3]} Menschen{'xyz'[i % 3]} Wasser teuer Garten{i % 4}", f"Kommentar Haus{'abc'[i % 3]} lang Garten{i % 4}") for i in range(24)]
    src = spark.createDataFrame(rows, "_id string, text string, c text string".replace("c text", "comment"))
    made = src.select("_id", F.lit("2015-06-15 10:00:00").cast("timestamp").alias("date_published"), F.array(F.lit("Zürich")).alias("tags"), F.lit(None).cast("array<string>").alias("authors"), F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("lead"), "text",
        F.array(F.struct(F.lit("1").alias("id"), F.lit("2015-06-15 10:00:00").cast("timestamp").alias("date_created"), F.lit("a").alias("author"), F.col("comment").alias("text"), F.lit(1).alias("votes_up"), F.lit(1).alias("votes_down"))).alias("comments"))
    result = articles.assemble(made, F.lit("2015-06-16 10:00:00").cast("timestamp"), articles.Options(topics=3, iterations=3, retain_top=1.0, summary_top=1.0))
    articles.store(result, str(tmp_path / "out"))
    items = spark.read.json(str(tmp_path / "out/topicItems")).collect()
    assert items and all(r["buzzMeta"]["opinionCount"] == 1 and r["opinions"][0]["id"] == "1" for r in items)
    topics = spark.read.json(str(tmp_path / "out/topics")).collect()
    assert len(topics) == 3 and all(len(t["topicTerms"]) <= 10 for t in topics)
    series = [s for t in topics for s in t["timeseries"] or []]
    assert series and all(s["interactionCount"] == 2 * s["opinionCount"] for s in series)
    assert [tuple(r) for r in spark.read.json(str(tmp_path / "out/tags")).select("_id", "score").collect()] == [("zurich", len(items))]
    report = result.report.first()
    assert report["n_topics"] == 3 and 0 < report["n_docs"] <= 24
    result.release()
    (tmp_path / "stop").write_text("Wasser teuer")
    fewer = articles.assemble(made, F.lit("2015-06-16 10:00:00").cast("timestamp"), articles.Options(topics=2, iterations=2, retain_top=1.0, summary_top=1.0, stop_words=str(tmp_path / "stop")))
    assert not {t for r in fewer.topics.collect() for t in r["topicTerms"]} & {"Wasser", "teuer"}
    fewer.release()


def test_run_lengths(spark):
    rows = spark.createDataFrame([(1, ["b", "a", "b", "b"]), (2, []), (3, None), (4, ["x"])], "d int, terms array<string>")
    got = {(r["d"], r["term"]): (r["n"], r["tf"]) for r in tfidf.augmented_tf(rows, ["d"]).collect()}
    assert got == {(1, "b"): (3, 1.0), (1, "a"): (1, 1 / 3), (4, "x"): (1, 1.0)}


def test_comments_without_ids_of_their_own(spark):
    comment = lambda i, t: (i, None, None, t, 1, 0)
    rows = spark.createDataFrame([("u", None, None, None, None, None, None, None, None, "Text", [comment(None, "eins"), comment("c", "zwei"), comment("c", "drei"), comment("d", None)])], readers.ARTICLE)
    assert sorted((r["comment_no"], r["comment_id"] or "", r["text"].strip()) for r in articles.create_docs(rows).collect()) == [(-1, "", "Text"), (0, "", "eins"), (1, "c", "zwei"), (2, "c", "drei")]
    terms = articles.create_docs(rows).select("article_id", "comment_no", F.array(F.struct(F.col("text").alias("normalizedForm"), F.array("text").alias("originalForms"), F.lit(1.0).alias("score"))).alias("terms"))
    got = articles.opinions_of(rows, terms.filter("comment_no >= 0")).select("opinion.id", F.col("opinion.terms")[0]["normalizedForm"].alias("t")).collect()
    assert sorted((r["id"] or "", r["t"]) for r in got) == [("", "eins"), ("c", "drei"), ("c", "zwei")]


def test_written_forms(spark):
    forms = spark.createDataFrame([("mensch", "Menschen"), ("hau", "Haus")], "stem string, form string")
    stems = spark.createDataFrame([("mensch",), ("mensch_x_hau",), ("y",)], "stem string")
    assert {r["stem"]: r["written"] for r in written_forms(stems, forms).collect()} == {"mensch": "Menschen", "mensch_x_hau": "Menschen x Haus", "y": "y"}


def test_limits_are_errors(spark):
    words = spark.createDataFrame([(w,) for w in "abc"], "word string")
    assert sorted(vocabulary.driver_words(words, 3)) == ["a", "b", "c"]
    with pytest.raises(ValueError, match="more than 2 words"):
        vocabulary.driver_words(words, 2)
    for bad in ({"doc_concentration": 0}, {"topic_concentration": -0.5}):
        with pytest.raises(ValueError, match="above 0"):
            tp.fit_lda(words, 2, 1, **bad)


def test_unique_articles(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("b", 3, None)], "_id string, n int, t string")
    assert sorted(tuple(r) for r in readers.unique_articles(rows.repartition(3)).collect()) == [("a", 1, "z"), ("b", 3, None)]


def test_sketch(spark):
    tf = spark.createDataFrame([(d, t) for d in range(9) for t in ("a", "b")[: 1 + d % 2]], "d int, term string")
    asked = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "term string")
    assert {r["term"]: r["estimate"] for r in tfidf.sketched_frequency(tfidf.sketch_counters(tf), asked).collect()} == {"a": 9, "b": 4, "c": 0}
    # too narrow for its terms: never below the exact count, and merged parts are the whole
    many = spark.createDataFrame([(d, f"t{d * d % 97}") for d in range(400)], "d int, term string")
    exact = dict(tfidf.document_frequency(many).collect())
    whole = tfidf.sketch_counters(many, 2, 20)
    merged = tfidf.merge_sketches(*[tfidf.sketch_counters(many.filter(F.col("d") % 3 == k), 2, 20) for k in range(3)])
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, merged.collect())) and whole.count() <= 40
    got = {r["term"]: r["estimate"] for r in tfidf.sketched_frequency(merged, many, 2, 20).collect()}
    assert got.keys() == exact.keys() and all(got[t] >= n for t, n in exact.items()) and got != exact


def test_activity(spark):
    rows = spark.createDataFrame([(0, "2015-06-15 09:00:00", 2, 4), (0, None, 5, 5)], "t int, d string, n_opinions int, n_votes int").withColumn("date_published", F.col("d").cast("timestamp"))
    got = ops.activity(rows, "t").collect()
    assert len(got) == 1 and got[0]["opinion_count"] == 2 and got[0]["interaction_count"] == 4


def test_buzz_meta(spark):
    now = "2015-06-15 12:00:00"
    rows = spark.createDataFrame([("x", "2015-06-14 12:00:00", 4000, 100), ("x", "2015-05-15 11:00:00", 1, 1), ("x", "2014-06-15 12:00:00", 30, 130), ("x", None, 1, 1)], "k string, d string, votes_up int, votes_down int")
    got = ops.buzz_meta(rows.withColumn("date_published", F.col("d").cast("timestamp")), ["k"], F.lit(now).cast("timestamp")).first()
    assert 6 < got["buzz_score"] < 6.2 and got["opinion_count"] == 4 and got["opinion_votes"] == 4264


def test_best_topics(spark):
    got = spark.createDataFrame([([0.1, 0.4, 0.4, 0.01],)], "d array<double>").select(tp.best_topics(F.col("d"), 3).alias("t")).first()["t"]
    assert [tuple(x) for x in got] == [(1, 0.4), (2, 0.4), (0, 0.1)]


def test_apps(spark, tmp_path):
    (tmp_path / "w.xml").write_text('<m><page><title>T</title><id>1</id><revision><text xml:space="preserve">[[Bern]]  ist</text></revision></page><page><title>R</title><id>2</id><revision><text>#REDIRECT x</text></revision></page></m>')
    apps.convert_wiki(spark, str(tmp_path / "w.xml"), str(tmp_path / "txt"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "txt")).collect()] == ["Bern ist"]
    (tmp_path / "l.txt").write_text("\n".join(["haus garten wasser haus"] * 9 + ["motor auto strasse"] * 9))
    apps.count_words(spark, str(tmp_path / "l.txt"), str(tmp_path / "wc"))
    assert dict(r.split(",") for r in (x[0] for x in spark.read.text(str(tmp_path / "wc")).collect()))["haus"] == "18"
    apps.count_all(spark, str(tmp_path / "l.txt"), str(tmp_path / "n"))
    assert spark.read.text(str(tmp_path / "n")).first()[0] == "63"
    (tmp_path / "stop").write_text("wasser\n")
    run = apps.run_lda(spark, [str(tmp_path / "l.txt")], apps.LdaOptions(k=2, iterations=3, stop_words=str(tmp_path / "stop")))
    assert run.report.first()["n_docs"] == 18 and run.report.first()["n_words"] == 5 and min(run.seconds) > 0
    topics = run.topics.collect()
    assert {r["topic_id"] for r in topics} == {0, 1} and "wasser" not in {r["term"] for r in topics}
    apps.word_vectors(spark, str(tmp_path / "l.txt"), str(tmp_path / "v"))
    assert spark.read.parquet(str(tmp_path / "v/vectors")).count() == 6


def test_stream(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2024-01-01 10:00:00"), ("a", "2024-01-01 11:00:00"), ("b", "2024-01-02 01:00:00"), ("a", "2024-01-09 01:00:00")], "k string, t string").withColumn("ts", F.col("t").cast("timestamp"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = daily_activity(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), "k")
    q = stream.writeStream.format("memory").queryName("days").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r["k"], r["n"]) for r in spark.table("days").collect()) == [("a", 2), ("b", 1)]
