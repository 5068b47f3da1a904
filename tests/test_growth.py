"""Steps whose cost must not grow faster than their input: what passes through a shuffle, or through Python, and how often."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textloom import queries
from textloom.functions import text
from textloom.functions.normalize import normalize_term
from textloom.operators import mixtures, phrases, tfidf, topics, vectors
from textloom.plans import apps, articles
from textloom.sources import readers
from textloom.sources.tables import materialize

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def word_lists(spark, n=300):
    r = random.Random(5)
    lists = [[f"w{int(r.paretovariate(0.6)) % 40}" for _ in range(r.randint(0, 30))] for _ in range(n)] + [[], None, ["a", None, "a"], ["x"] * 9]
    return lists, spark.createDataFrame(list(enumerate(lists)), "d int, terms array<string>")


def test_totals_of_terms_are_those_of_their_rows(spark):
    lists, docs = word_lists(spark)
    want = {}
    for said in lists:
        n = Counter(said or [])
        for t, k in n.items():
            df, all_, total = want.get(t, (0, 0, 0.0))
            want[t] = df + 1, all_ + k, total + k / max(n.values())
    got = {r["term"]: (r["df"], r["n"], r["total"]) for r in tfidf.term_totals(docs).collect()}
    assert got.keys() == want.keys() and all(got[t][:2] == want[t][:2] and math.isclose(got[t][2], want[t][2]) for t in want)
    by_rows = tfidf.augmented_tf(docs, ["d"])
    assert {(r["term"], r["df"]) for r in tfidf.document_frequency(by_rows).collect()} == {(t, v[0]) for t, v in got.items()}


@pytest.mark.parametrize("most", [500_000, 0])
def test_scores_meet_their_weights_without_a_shuffle_of_terms(spark, monkeypatch, most):
    """few weights are broadcast, more are joined by shuffle, with the same result."""
    monkeypatch.setattr(tfidf, "BROADCAST_TERMS", most)
    lists, docs = word_lists(spark)
    tf = tfidf.augmented_tf(docs, ["d"])
    scored = tfidf.tfidf(tf, docs, ["d"], 2, tfidf.term_totals(docs))
    assert ("strategy=broadcast" in plan(scored)) == bool(most) and plan(scored).count("MapInArrow") == 1
    df = Counter(t for said in lists for t in set(said or []) if t)
    want = {(i, t): k / max(Counter(said).values()) * math.log((len(lists) + 1) / (df[t] + 1)) for i, said in enumerate(lists) for t, k in Counter(said or []).items() if t and df[t] > 1}
    got = {(r["d"], r["term"]): r["score"] for r in scored.collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k]) for k in want)


def test_runs_of_words_are_stemmed_by_their_words(spark):
    """as a run's own normal form, and each document where it is."""
    texts = ["Häuser – und Häuser", "– x", "Haus", "", None, "Straße der  Menschen! 4 Menschen", "-- a -- b", "é ß Σ ΑΣ ΑΣ"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "d int, text string")
    for longest in (1, 2, 3):
        arrays = tfidf.stem_arrays(docs, ["d"], term_words=longest)
        got = {r["d"]: Counter(r["terms"] or []) for r in arrays.collect()}
        runs = tfidf.term_arrays(docs, ["d"], term_words=longest) if longest > 1 else docs.select("d", tfidf.word_tokens(F.col("text")).alias("terms"))
        assert got == {r["d"]: Counter(s for t in r["terms"] or [] if (s := normalize_term(t).strip(" "))) for r in runs.collect()}
    assert "Exchange" not in arrays._jdf.queryExecution().executedPlan().toString()


def test_a_sketch_counts_terms_not_rows(spark):
    """counters of a table of frequencies are those of its rows."""
    _, docs = word_lists(spark)
    tf = tfidf.augmented_tf(docs, ["d"]).filter("term IS NOT NULL")
    once = tfidf.term_totals(docs).filter("term IS NOT NULL").select("term", "df")
    assert sorted(map(tuple, tfidf.sketch_counters(once, 3, 7).collect())) == sorted(map(tuple, tfidf.sketch_counters(tf, 3, 7).collect()))
    # the rows are counted before they are dealt to the sketch's rows
    shown = plan(tfidf.sketch_counters(tf, 3, 7))
    assert shown.index("explode") < shown.index("count(1)")


def test_summaries_are_scored_once(spark):
    """F16: both reads of the kept terms are of a written table."""
    assert "MapInArrow" not in plan(queries.summary_terms(spark, SF))


def test_few_runs_leave_their_texts(spark):
    """runs that are no names stay where they are, and no text is joined row by row in Python."""
    texts = spark.createDataFrame([(str(k), [f"w{(k * 31 + i) % 997}" for i in range(400)]) for k in range(20)], "key string, words array<string>")
    names = spark.createDataFrame([(f"w{i}_w{i + 1}",) for i in range(0, 40, 2)] + [("w1_w2_w3",)], "name string")
    said = [r["words"] for r in texts.collect()]
    keys = {r["name"] for r in names.collect()}
    want = sum("_".join(w[i : i + n]) in keys for w in said for n in (2, 3) for i in range(len(w) - n + 1))
    assert want <= phrases._likely(texts, names, 3).count() <= want + 5
    docs = texts.select("key", F.array_join("words", " ").alias("text"))
    marked = phrases.mark_phrases(docs, phrases.phrase_index(names.withColumnRenamed("name", "key")))
    assert "EvalPython" not in marked._jdf.queryExecution().executedPlan().toString()


def test_a_money_pattern_holds_its_mark():
    """what a pattern matches holds the mark that is looked for first."""
    r = random.Random(3)
    parts = ["12", "1,5", " ", "Fr", "Fr.", "CHF", "Chf", "chf", "EUR", ".-", ".--", " Franken", "x", "\n"]
    hit = Counter()
    for _ in range(60_000):
        t = "".join(r.choice(parts) for _ in range(r.randint(2, 7)))
        for k, ((pattern, _), mark) in enumerate(zip(text.MONEY, text.MONEY_MARKS)):
            if re.fullmatch(pattern, t):
                hit[k] += 1
                assert mark in t, (pattern, t)
    assert len(hit) == len(text.MONEY) == len(text.MONEY_MARKS)


def test_slow_rows_are_dealt_to_more_tasks_as_they_grow(spark, tmp_path, monkeypatch):
    """a single file of one row group is not a single task, nor as many as there are cores."""
    spark.range(20_000).coalesce(1).write.parquet(str(tmp_path / "t"))
    monkeypatch.setattr(readers, "TASK_BYTES", 4_000)
    assert readers.spread(spark.read.parquet(str(tmp_path / "t")), slow=True).rdd.getNumPartitions() > spark.sparkContext.defaultParallelism


def test_documents_of_a_topic_model(spark):
    """Words are found once, lines of one id are one document, and a vector's parts are its entries."""
    lines = spark.createDataFrame([(1, "Haus Haus Garten und"), (1, "Haus Auto"), (2, "Auto"), (3, "x 1"), (4, None)], "doc_id int, text string")
    features, words, size = apps.lda_corpus(lines, apps.LdaOptions(), "text", key="doc_id")
    names = {r["term_id"]: r["term"] for r in words.collect()}
    assert size == 4 and [names[i] for i in range(4)] == ["haus", "auto", "garten", "und"]
    parts = {r["id"]: (list(r["ids"]), list(r["counts"])) for r in vectors.vector_parts(features).collect()}
    assert parts == {1: ([0, 1, 2, 3], [3.0, 1.0, 1.0, 1.0]), 2: ([1], [1.0])}
    assert {r["id"]: (r["features"].indices.tolist(), r["features"].values.tolist()) for r in features.collect()} == parts
    assert "sentences" not in plan(words) and "UDF" not in plan(topics.non_empty(features))


@pytest.mark.parametrize("most", [500_000, 0])
def test_terms_of_sources_leave_their_documents_once(spark, monkeypatch, most):
    """documents are not shuffled to find their terms, but for those that share an id, which are one in each of their sources."""
    monkeypatch.setattr(queries, "BROADCAST_IDS", most)
    rows = [(1, "x", "a b a A"), (2, "y", "a - c"), (3, None, ""), (4, "x", None), (None, "x", "no")]
    alone = queries._sourced_terms(spark.createDataFrame(rows, "doc_id int, source string, text string"))
    assert "Join" not in plan(alone) and "Aggregate" not in plan(alone)
    for extra in ([], [(1, "y", "a d"), (1, "y", "e"), (2, "y", None)]):
        docs = spark.createDataFrame(rows + extra, "doc_id int, source string, text string")
        got = Counter((r["source"], r["form"]) for r in queries._sourced_terms(docs).collect())
        said = {}
        for i, _, words in rows + extra:
            said.setdefault(i, set()).update(w for w in (words or "").replace("-", " ").split() if w)
        assert got == Counter((s, w) for i, s, _ in rows + extra if i is not None for w in said[i])


def test_a_mixture_step_has_a_row_for_each_term_of_a_block(spark, monkeypatch):
    """F8: not one for each term of each document; a document's terms stay in its block."""
    r = random.Random(7)
    rows = [(g, d, f"w{w}", 1) for g in "ab" for d in range(200) for w in r.sample(range(30), 8)]
    written = {}

    def kept(df, tag, *args):
        out = materialize(df, tag, *args)
        written.setdefault(tag, []).append(out.count())
        return out

    monkeypatch.setattr(mixtures, "materialize", kept)
    monkeypatch.setattr(mixtures, "BLOCK_WEIGHTS", 2 * 400)
    docs = spark.createDataFrame(rows, "g string, d int, term string, n int")
    fitted = mixtures.fit_mixtures(docs, ["g"], ["d"], 2, 2)
    assert fitted.shares.count() == 400 and fitted.terms.count() == 60 and all(abs(sum(x["shares"]) - 1) < 1e-9 for x in fitted.shares.collect())
    assert len(written["mixture-step"]) == 2 and all(n < len(rows) / 2 for n in written["mixture-step"])


def test_items_do_not_wait_for_topics(spark, monkeypatch):
    """F2, F8: the topics' table and the report, which run over the model, are made when they are asked for."""

    def asked(*_):
        raise AssertionError

    monkeypatch.setattr(articles, "report", asked)
    monkeypatch.setattr(articles, "_topics", asked)
    assert queries.article_items(spark, SF).count() > 0


def test_articles_are_dealt_to_some_tasks_for_each_core(spark):
    """Adaptive execution does not join the tasks that stem to one and a bit for each core."""
    assert queries.conversation_articles(spark, SF).rdd.getNumPartitions() >= 3 * spark.sparkContext.defaultParallelism


def test_opinions_of_tags_are_not_shuffled(spark):
    """a row's tags are told apart in the row, whatever it carries."""
    rows = [(0, "a", ["o1"], ["Bern", "bern", "BERN!", None, "Zürich"]), (1, "a", ["o1"], ["Bern"]), (0, "b", ["o2"], None), (0, "c", ["o3"], []), (2, "d", None, ["zurich", "Basel"])]
    items = spark.createDataFrame(rows, "topic_id int, _id string, opinions array<string>, tags array<string>")
    found = articles.by_topic_and_tag(items, spark.createDataFrame([("bern",), ("zurich",)], "tag string"), "opinions")
    assert "Aggregate" not in plan(found)
    want = [(0, "bern", ["o1"]), (0, "zurich", ["o1"]), (1, "bern", ["o1"]), (2, "zurich", None)]
    assert sorted((r["topic_id"], r["tag"], r["opinions"]) for r in found.collect()) == want
