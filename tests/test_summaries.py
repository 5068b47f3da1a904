"""Summaries by blocks of documents: the same as with a row for each document and term, of which fewer rows are shuffled."""

import json
import random

import pytest
from pyspark.sql import functions as F

from textloom.operators import tfidf
from textloom.plans import articles
from textloom.sources.schemas import ARTICLE

WORDS = ["Haus", "Häuser", "haus", "Gärten", "Garten", "Schiff", "Schiffe", "12", "'", "Straße", "Strasse", "école", "x", "Menschen", "Mensch", "Fr. 20", "!", "-"]


def made(spark, n=40, seed=3):
    r = random.Random(seed)

    def said():
        return r.choice([None, "", "?", " ".join(WORDS[int(r.paretovariate(0.4)) % len(WORDS)] for _ in range(r.randint(1, 40)))])

    rows = [json.dumps({"_id": str(i), "text": said(), "comments": [{"id": str(c), "text": said()} for c in range(r.randint(0, 4))]}) for i in range(n)]
    return spark.createDataFrame(rows, "string").select(F.from_json("value", ARTICLE).alias("a")).select("a.*").repartition(3)


def plain(rows):
    return sorted(map(str, rows.withColumn("terms", F.transform("terms", lambda t: F.struct(t["normalizedForm"], t["originalForms"], F.round(t["score"], 9)))).collect()))


@pytest.mark.parametrize("options", [{}, {"strict": True}, {"term_words": 2}, {"summary_top": 0.5, "retain_top": 1.0, "min_doc_freq": 0}, {"summary_top": 0.0, "retain_top": 0.3}])
@pytest.mark.parametrize("block", [(2_000, 400_000), (7, 30)])
def test_blocks_give_the_same_summaries(spark, monkeypatch, options, block):
    monkeypatch.setattr(tfidf, "BLOCK_DOCS", block[0])
    monkeypatch.setattr(tfidf, "BLOCK_TERMS", block[1])
    rows, chosen = made(spark), articles.Options(**options)
    kept, forms, summaries, _ = articles.summarise(rows, chosen)
    want_kept, want_forms, want, _ = articles._summarise_rows(articles.create_docs(rows), chosen)
    assert plain(summaries) == plain(want) != []
    assert sorted(map(str, kept.collect())) == sorted(map(str, want_kept.collect())) != []
    same = lambda df: sorted(map(str, df.select("stem", "form", F.round("total", 9)).collect()))
    assert same(forms) == same(want_forms)


def test_a_stem_leaves_a_block_once(spark):
    docs = spark.createDataFrame([(i, ["Haus", "Häuser", "Garten"]) for i in range(500)], "d int, terms array<string>").coalesce(1)
    blocks = tfidf.stem_blocks(docs, ["d"])
    stems = blocks.filter("code is not null")
    assert stems.count() == 2 and sorted(r["df"] for r in stems.collect()) == [500, 500]
    assert blocks.filter("docs is not null").select(F.sum(F.size("docs"))).first()[0] == 500


def test_no_documents(spark):
    none = made(spark).limit(0)
    kept, forms, summaries, _ = articles.summarise(none)
    assert kept.count() == forms.count() == summaries.count() == 0
