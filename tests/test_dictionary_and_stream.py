import json

from pyspark.sql import functions as F

from textloom import queries
from textloom.operators import opinions, terms, tfidf
from textloom.plans import articles
from textloom.sources import readers
from textloom.sources.schemas import ARTICLE
from textloom.streaming import versions

WORDS = ["Menschen", "Mensch", "menschlich", "Häuser", "Haus", "--", "«Pegida»", "St-Gallen"]


def test_terms_are_normalised_once(spark, tmp_path):
    tf = spark.createDataFrame([(d, w, 1.0 / (1 + i)) for d in range(30) for i, w in enumerate(WORDS)], "d int, term string, tf double")
    for strict in (False, True):
        seen = spark.sparkContext.accumulator(0)
        dictionary = terms.normal_forms(tf, seen).persist()
        dictionary.count()
        assert seen.value == len(WORDS)
        for f, keys in ((tfidf.stemmed_tf, (["d"],)), (tfidf.surface_forms, ())):
            plain, joined = (sorted(map(tuple, f(tf, *keys, strict=strict, dictionary=x).collect())) for x in (None, dictionary))
            assert [(*r[:-1], round(r[-1], 9)) for r in plain] == [(*r[:-1], round(r[-1], 9)) for r in joined] and plain
        assert seen.value == len(WORDS)
        dictionary.unpersist()


def test_a_dictionary_grows_over_runs(spark, tmp_path):
    path = str(tmp_path / "forms")
    seen = spark.sparkContext.accumulator(0)
    rows = lambda *w: spark.createDataFrame([(x,) for x in w], "term string")
    first = terms.extend_dictionary(rows("Haus", "Häuser", "Haus", None), path, seen)
    assert seen.value == 2 and {r["term"]: r["form"] for r in first.collect()} == {"Haus": "hau", "Häuser": "hau"}
    second = terms.extend_dictionary(rows("Häuser", "Auto"), path, seen)
    assert seen.value == 3 and {r["term"] for r in second.collect()} == {"Haus", "Häuser", "Auto"}
    assert terms.extend_dictionary(rows(), path, seen).count() == 3 and seen.value == 3
    assert terms.read_dictionary(spark, str(tmp_path / "none")).collect() == []


def line(_id, scraped, published="2015-06-01T08:00:00Z", kind="news", tags=("a",), votes=(1, 2)):
    comments = [{"id": str(i), "text": "x", "votes_up": v} for i, v in enumerate(votes)]
    return json.dumps({"_id": _id, "date_scraped": scraped, "date_published": published, "type": kind, "tags": list(tags), "comments": comments})


PARTS = [
    [line("a", "2015-06-01T10:00:00Z"), line("b", "2015-06-01T10:00:00Z", tags=("a", "b"), votes=(5,)), line("c", "2015-06-01T09:00:00Z", published=None)],
    [line("a", "2015-06-01T12:00:00Z", tags=("c",), votes=(1, 2, 3)), line("b", "2015-06-01T09:00:00Z", tags=("old",)), line("d", "2015-06-01T11:00:00Z", kind=None)],
    [line("a", "2015-06-01T12:00:00Z", tags=("c",), votes=(1, 2, 3)), line("b", "2015-06-02T10:00:00Z", published="2015-06-02T08:00:00Z", tags=()), line("c", "2015-06-02T09:00:00Z"), line("e", None)],
]


def test_versions_over_a_stream_that_stops(spark, tmp_path):
    """A later version replaces an earlier one; after each stop and start the sums are those of the batch so far."""
    for k, part in enumerate(PARTS):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{k}.json").write_text("\n".join(part))
        lines = spark.readStream.schema("value string").text(str(tmp_path / "in"))
        given = versions.article_counts(lines.select(readers.parse_articles(F.col("value")).alias("a")).select("a.*"))
        stream = versions.article_changes(given).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).outputMode("append").trigger(availableNow=True).start(str(tmp_path / "out"))
        assert stream.awaitTermination(120)
        changes = spark.read.schema(versions.CHANGES).parquet(str(tmp_path / "out"))
        last = versions.last_versions(versions.article_counts(readers.read_articles(spark, str(tmp_path / "in"))))
        want = sorted(map(tuple, opinions.activity(last, "by", "day").collect()), key=str)
        assert sorted(map(tuple, versions.activity_of(changes).collect()), key=str) == want and want
        tags = last.select(F.explode("tags").alias("tag")).groupBy("tag").agg(F.count("*").alias("score"))
        assert sorted(map(tuple, versions.tags_of(changes).collect())) == sorted(map(tuple, tags.collect()))
    assert ("c", 1) in [tuple(r) for r in versions.tags_of(changes).collect()] and "old" not in [r["tag"] for r in versions.tags_of(changes).collect()]


def test_versions_that_are_appended_as_they_come(spark, tmp_path):
    """the same sums without a call of Python for each article."""
    for k, part in enumerate(PARTS):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{k}.json").write_text("\n".join(part))
        lines = spark.readStream.schema("value string").text(str(tmp_path / "in"))
        given = versions.article_counts(lines.select(readers.parse_articles(F.col("value")).alias("a")).select("a.*"))
        stream = given.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).outputMode("append").trigger(availableNow=True).start(str(tmp_path / "out"))
        assert stream.awaitTermination(120)
        got = versions.logged_activity(spark.read.schema(given.schema).parquet(str(tmp_path / "out")))
        last = versions.last_versions(versions.article_counts(readers.read_articles(spark, str(tmp_path / "in"))))
        want = sorted(map(tuple, opinions.activity(last, "by", "day").collect()), key=str)
        assert sorted(map(tuple, got.collect()), key=str) == want and want
    assert not any(x in got._jdf.queryExecution().executedPlan().toString() for x in ("Python", "InPandas", "InArrow"))
    assert "article_changes" not in queries.activity_stream.__code__.co_names


def test_assembly_with_a_shared_dictionary(spark, tmp_path):
    texts = ["Haus und Garten im Haus", "Gärten am Haus", "Auto und Motor"]
    rows = spark.createDataFrame([json.dumps({"_id": str(i), "text": t, "comments": [{"id": "1", "text": t}]}) for i, t in enumerate(texts)], "string").select(F.from_json("value", ARTICLE).alias("a")).select("a.*")
    plain = articles.summarise(rows)[2].collect()
    for _ in range(2):
        again = articles.summarise(rows, articles.Options(term_dictionary=str(tmp_path / "forms")))[2].collect()
        assert sorted(map(str, again)) == sorted(map(str, plain)) and plain
    assert terms.read_dictionary(spark, str(tmp_path / "forms")).count() == len({w for t in texts for w in t.split()})
