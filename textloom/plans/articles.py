"""Articles and comments to topic items, topics and tags."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import all_normalized
from ..functions.words import stop_stems
from ..operators import opinions as ops
from ..operators.mixtures import best_terms, fit_small
from ..operators.ranking import retain_top_share
from ..operators.terms import extend_dictionary, normal_forms
from ..operators.tfidf import best_stems, block_forms, block_idf, document_tf, stem_arrays, stem_blocks, stemmed_tf, surface_forms, term_arrays, term_structs, tfidf
from ..operators.topics import assignments, document_topics, fit_lda, report, topic_terms
from ..operators.vectors import MOST_SIZE, ml_vectors, sparse_rows
from ..operators.vocabulary import vocabulary as term_ids
from ..operators.vocabulary import without_stop_words
from ..sources.readers import read_word_list
from ..sources.sinks import write_json
from ..sources.tables import discard, materialize

#: A text's article and its place among the article's comments: ids of comments may be null or repeat.
KEYS = ["article_id", "comment_no"]
#: The place of an article's own text, and its comment_id.
OWN, OWN_ID = -1, ""


@dataclass(frozen=True)
class Options:
    retain_top: float = 0.05
    iterations: int = 70
    topics: int = 50
    term_words: int = 1
    min_doc_freq: int = 2
    summary_top: float = 0.1
    least_topic_score: float = 0.05
    tags: int = 100
    #: Path of a list of stop words; the built-in one if empty.
    stop_words: str = ""
    #: A vocabulary of more words is an error: an ML vector has no more places.
    most_words: int = MOST_SIZE
    keep_uncommented: bool = False
    strict: bool = False
    seed: int = 1
    #: Path of a dictionary of terms' normal forms that runs share and extend; none if empty.
    term_dictionary: str = ""


def comments_of(articles: DataFrame) -> DataFrame:
    each = articles.select(F.col("_id").alias("article_id"), F.posexplode("comments").alias("comment_no", "c"))
    return each.select("article_id", "comment_no", F.col("c.id").alias("comment_id"), "c.date_created", "c.author", "c.text", "c.votes_up", "c.votes_down")


def create_docs(articles: DataFrame) -> DataFrame:
    """Article and comment texts: article_id, comment_no (-1 for the article's own text), comment_id ('' for it), text. Comments without text are left out."""
    part = lambda c: F.coalesce(F.col(c), F.lit(""))
    own = articles.select(F.col("_id").alias("article_id"), F.lit(OWN).alias("comment_no"), F.lit(OWN_ID).alias("comment_id"), F.concat_ws(" ", part("title"), part("lead"), part("text")).alias("text"))
    return own.unionByName(comments_of(articles).filter(F.col("text").isNotNull()).select(*KEYS, "comment_id", "text"))


def opinions_of(articles: DataFrame, terms: DataFrame) -> DataFrame:
    """Comments with text and summary terms: article_id, opinion struct."""
    both = comments_of(articles).filter(F.col("text").isNotNull()).join(terms, KEYS)
    opinion = F.struct(F.col("comment_id").alias("id"), F.col("date_created").alias("date_published"), "author", "terms", "votes_up", "votes_down")
    return both.select("article_id", opinion.alias("opinion"))


def gathered(rows: DataFrame, by: str, value: str, name: str) -> DataFrame:
    """All values of a group as one sorted array: by, name."""
    return rows.groupBy(by).agg(F.sort_array(F.collect_list(value)).alias(name))


def with_comments(own: DataFrame, grouped: DataFrame, keep_uncommented: bool = False) -> DataFrame:
    """Articles joined with what their comments gather to; those without any are left out unless kept."""
    return own.join(grouped, "article_id", "left" if keep_uncommented else "inner")


def by_topic_and_tag(by_topic: DataFrame, known: DataFrame, value: str) -> DataFrame:
    """topic_id, tag, value of rows (topic_id, an id, value and an array of tags) for each known tag that a row has, once
    for each of its normal forms, which are told apart in the row, so no value is shuffled. known: a column tag of a bounded
    number of rows."""
    named = by_topic.select("topic_id", value, F.explode(F.array_distinct(all_normalized(F.col("tags")))).alias("tag"))
    return named.join(F.broadcast(known.select("tag")), "tag").select("topic_id", "tag", value)


def cogroup(first: DataFrame, *others: DataFrame, on: str = "topic_id") -> DataFrame:
    """All rows of frames with one row for each key, by the key; what a frame lacks is null."""
    for other in others:
        first = first.join(other, on, "full")
    return first


def buzz_of(by: list[str], opinions: DataFrame, as_of: Column) -> DataFrame:
    """by, buzzMeta of opinions (by, opinion)."""
    flat = opinions.select(*by, "opinion.date_published", "opinion.votes_up", "opinion.votes_down")
    meta = ops.buzz_meta(flat, by, as_of)
    each = opinions.select(*by, F.explode("opinion.terms").alias("t")).select(*by, F.col("t.normalizedForm").alias("term"), F.get("t.originalForms", F.lit(0)).alias("form"))
    top = ops.opinion_terms(each, by).groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("place", "form"))).alias("_p"))
    names = F.coalesce(F.transform("_p", lambda p: p["form"]), F.array().cast("array<string>"))
    made = F.struct(F.col("buzz_score").alias("buzzScore"), F.col("opinion_count").cast("int").alias("opinionCount"), F.col("opinion_votes").cast("int").alias("opinionVotes"), names.alias("opinionTerms"))
    return meta.join(top, by, "left").select(*by, made.alias("buzzMeta"))


@dataclass(frozen=True)
class Result:
    items: DataFrame
    tags: DataFrame
    #: Topics and report, which run over the model, are made when they are first asked for.
    make_topics: Callable[[], DataFrame]
    make_report: Callable[[], DataFrame]
    #: Terms of comments in the vocabulary: article_id, comment_no, term.
    comment_terms: DataFrame | None = None
    cached: list[DataFrame] = field(default_factory=list)

    @cached_property
    def topics(self) -> DataFrame:
        return self.make_topics()

    @cached_property
    def report(self) -> DataFrame:
        """One row about the topic model and its corpus."""
        return self.make_report()

    def release(self) -> None:
        """Gives back what is cached; what is not yet read is computed anew."""
        for df in self.cached:
            df.unpersist()


def summarise(articles: DataFrame, options: Options = Options()) -> tuple[DataFrame, DataFrame, DataFrame, list[DataFrame]]:
    """Each document's terms for the vocabulary (KEYS, term), the written forms of stems, each document's summary terms, and what is cached."""
    docs = create_docs(articles)
    if options.term_dictionary or (options.strict and options.term_words > 1):
        return _summarise_rows(docs, options)
    terms = term_arrays(docs, KEYS, strict=options.strict) if options.term_words <= 1 else stem_arrays(docs, KEYS, term_words=options.term_words)
    blocks = stem_blocks(terms, KEYS, options.strict)
    forms = materialize(block_forms(blocks), "forms")
    weights = materialize(block_idf(blocks, options.min_doc_freq).join(forms.select("stem", "form"), "stem"), "weights")
    best = materialize(best_stems(blocks, weights, KEYS, options.summary_top, options.retain_top), "summaries")
    discard(blocks, weights)
    return best.select(*KEYS, F.explode("kept").alias("term")), forms, best.select(*KEYS, "terms"), []


def _summarise_rows(docs: DataFrame, options: Options) -> tuple[DataFrame, DataFrame, DataFrame, list[DataFrame]]:
    """The same with a row for each document and term, which join the dictionary of a path."""
    tf = document_tf(docs, KEYS, term_words=options.term_words, strict=options.strict).persist()
    # each different term is normalised once; with a path, once in all runs
    forms_of = (extend_dictionary(tf, options.term_dictionary) if options.term_dictionary else normal_forms(tf)).persist()
    forms = surface_forms(tf, options.strict, forms_of).persist()
    scored = tfidf(stemmed_tf(tf, KEYS, options.strict, forms_of), docs, KEYS, options.min_doc_freq).persist()
    summaries = term_structs(retain_top_share(scored, KEYS, "score", options.summary_top), forms, KEYS).persist()
    kept = retain_top_share(scored, KEYS, "score", options.retain_top).select(*KEYS, "term")
    return kept, forms, summaries, [tf, forms_of, forms, scored, summaries]


def assemble(articles: DataFrame, as_of: Column, options: Options = Options()) -> Result:
    """Topic items, topics and tags of articles. Articles without a commented summary are left out unless kept."""
    kept, forms, summaries, cached = summarise(articles, options)
    own = summaries.filter(F.col("comment_no") == OWN).select("article_id", "terms")
    opinions = opinions_of(articles, summaries.filter(F.col("comment_no") != OWN)).persist()

    stop = read_word_list(articles.sparkSession, options.stop_words) if options.stop_words else None
    stems = stop_stems([r["word"] for r in stop.collect()]) if stop else stop_stems()  # a word list
    vocabulary = without_stop_words(kept, stems).persist()
    words = term_ids(vocabulary).persist()
    size = words.count()
    if size > options.most_words:
        raise ValueError(f"the vocabulary has more than {options.most_words} words; select fewer")
    bags = vocabulary.filter(F.col("comment_no") == OWN).select("article_id", "term").distinct()
    vectors = ml_vectors(sparse_rows(bags, words, ["article_id"], binary=True), size).persist()
    model = fit_lda(vectors, options.topics, options.iterations, seed=options.seed)

    items = with_comments(articles.withColumnRenamed("_id", "article_id").select("article_id", "date_published", "authors", "tags", "title", "lead"), own, options.keep_uncommented)
    items = with_comments(items, gathered(opinions, "article_id", "opinion", "opinions"), options.keep_uncommented)
    items = items.join(document_topics(model, vectors, ["article_id"]), "article_id").join(buzz_of(["article_id"], opinions, as_of), "article_id", "left")
    items = items.select(F.col("article_id").alias("_id"), F.col("article_id").alias("url"), "date_published", "authors", "tags", "topics", "terms", "title", "lead", "opinions", "buzzMeta").persist()
    tags = ops.tag_counts(items, n=options.tags).persist()
    make_topics = lambda: _topics(items, tags, topic_terms(model, words), forms, as_of, options)
    named = tags.select(F.col("tag").alias("_id"), F.col("score").cast("int").alias("score"))
    return Result(items, named, make_topics, lambda: report(model, vectors, size), vocabulary.filter(F.col("comment_no") != OWN).select(*KEYS, "term"), [*cached, opinions, vocabulary, words, vectors, items, tags])


def comment_topics(result: Result, k: int = 20, iterations: int = 80, least_topic_score: float = Options.least_topic_score, n: int = 10, seed: int = 1) -> DataFrame:
    """Topics of the comments on each topic's articles: topic_id, topic, place, term, weight. A comment counts for all topics
    of its article above a score; all topics' models are fitted together, keyed by topic."""
    topics = assignments(result.items.select("_id", "topics"), least_topic_score).select(F.col("_id").alias("article_id"), "topic_id")
    rows = result.comment_terms.join(topics, "article_id").withColumn("n", F.lit(1))
    return best_terms(fit_small(rows, ["topic_id"], KEYS, k, iterations, seed=seed), ["topic_id"], n)


def _topics(items: DataFrame, tags: DataFrame, terms: DataFrame, forms: DataFrame, as_of: Column, options: Options) -> DataFrame:
    by_topic = assignments(items, options.least_topic_score)
    opinions = by_topic.select("topic_id", F.explode("opinions").alias("opinion"))
    named = terms.join(forms, terms["term"] == forms["stem"], "left")
    words = named.groupBy("topic_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("term", F.coalesce("form", "term").alias("form")))), lambda t: t["form"]).alias("topicTerms"))
    sums = by_topic.select(
        "topic_id", "date_published", F.size("opinions").alias("n_opinions"),
        F.aggregate("opinions", F.lit(0).cast("long"), lambda a, o: a + F.coalesce(o["votes_up"], F.lit(0)) + F.coalesce(o["votes_down"], F.lit(0))).alias("n_votes"),
    )
    day = F.struct(F.col("day").alias("date"), F.col("opinion_count").cast("int").alias("opinionCount"), F.col("interaction_count").cast("int").alias("interactionCount"))
    series = ops.activity(sums, "topic_id").groupBy("topic_id").agg(F.sort_array(F.collect_list(day)).alias("timeseries"))
    # there are options.tags known tags at most
    tagged = by_topic_and_tag(by_topic, tags, "opinions").select("topic_id", "tag", F.explode("opinions").alias("opinion"))
    per_tag = buzz_of(["topic_id", "tag"], tagged, as_of).groupBy("topic_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("tag", "buzzMeta")))).alias("buzzMetaPerTag"))
    topics = cogroup(words, buzz_of(["topic_id"], opinions, as_of), per_tag, series)
    return topics.select(F.col("topic_id").alias("id"), F.lit(None).cast("string").alias("label"), "topicTerms", "buzzMeta", "buzzMetaPerTag", "timeseries")


def store(result: Result, path: str) -> None:
    """The three datasets as compressed JSON lines."""
    for name, df in (("topicItems", result.items), ("topics", result.topics), ("tags", result.tags)):
        write_json(df, f"{path}/{name}")
