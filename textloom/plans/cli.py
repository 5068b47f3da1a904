"""python -m textloom.plans.cli APP ...: the applications from the command line."""

from __future__ import annotations

import argparse
import time

from pyspark.sql import functions as F

from ..session import build_session
from ..sources.readers import read_articles, unique_articles
from . import apps, articles


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="textloom")
    sub = top.add_subparsers(dest="app", required=True)
    a = sub.add_parser("articles", help="articles with comments to topic items, topics and tags")
    for name, kind, value in (("retainTop", float, 0.05), ("ldaIterations", int, 70), ("ldaTopics", int, 50), ("termWords", int, 1), ("minDocFreq", int, 2), ("tasks", int, 0)):
        a.add_argument(f"--{name}", type=kind, default=value)
    for name, kind, value in (("summaryTop", float, 0.1), ("leastTopicScore", float, 0.05), ("tags", int, 100), ("stopwordFile", str, ""), ("termDictionary", str, ""), ("mostWords", int, articles.Options.most_words), ("seed", int, 1)):
        a.add_argument(f"--{name}", type=kind, default=value)
    for name in ("keepUncommented", "strict"):
        a.add_argument(f"--{name}", action="store_true")
    a.add_argument("--asOf", default=None, help="time that opinions' ages are measured at; now if left out")
    lda = sub.add_parser("lda", help="topics of plain-text lines")
    for name, kind, value in (("k", int, 20), ("maxIterations", int, 10), ("topicSmoothing", float, 0.1), ("termSmoothing", float, 0.1), ("vocabSize", int, 10_000), ("stopwordFile", str, "")):
        lda.add_argument(f"--{name}", type=kind, default=value)
    lda.add_argument("inputs", nargs="+")
    for name in ("wordcount", "totalcount", "linecount", "wiki", "vectors"):
        sub.add_parser(name)
    for p in [p for n, p in sub.choices.items() if n != "lda"]:
        p.add_argument("input")
        p.add_argument("output")
    return top


def tell(report: dict) -> None:
    print("\n".join(f"{k}: {v}" for k, v in report.items()))


def main(args: list[str] | None = None) -> None:
    o = parser().parse_args(args)
    spark = build_session(f"textloom {o.app}")
    if o.app == "articles":
        options = articles.Options(
            retain_top=o.retainTop, iterations=o.ldaIterations, topics=o.ldaTopics, term_words=o.termWords, min_doc_freq=o.minDocFreq, summary_top=o.summaryTop, least_topic_score=o.leastTopicScore,
            tags=o.tags, stop_words=o.stopwordFile, term_dictionary=o.termDictionary, most_words=o.mostWords, keep_uncommented=o.keepUncommented, strict=o.strict, seed=o.seed,
        )
        as_of = F.lit(o.asOf).cast("timestamp") if o.asOf else F.current_timestamp()
        began = time.perf_counter()
        given = unique_articles(read_articles(spark, o.input, o.tasks or None)).persist()
        result = articles.assemble(given, as_of, options)
        articles.store(result, o.output)
        comments = given.agg(F.count("*"), F.sum(F.coalesce(F.size("comments"), F.lit(0)))).first()
        print(f"corpus: {comments[0]} articles, {comments[1] or 0} comments")
        tell(result.report.first().asDict() | {"seconds": round(time.perf_counter() - began, 1)})
        result.release()
        given.unpersist()
    elif o.app == "lda":
        options = apps.LdaOptions(o.k, o.maxIterations, o.topicSmoothing, o.termSmoothing, o.vocabSize, o.stopwordFile)
        run = apps.run_lda(spark, o.inputs, options)
        for topic in run.topics.orderBy("topic_id", "place").collect():  # ten terms a topic
            print(f"{topic['topic_id']}\t{topic['place']}\t{topic['term']}\t{topic['weight']:.6f}")
        tell(run.report.first().asDict() | {"preprocessing_seconds": round(run.seconds[0], 1), "training_seconds": round(run.seconds[1], 1)})
    else:
        run = {"wordcount": apps.count_words, "totalcount": apps.count_all, "linecount": apps.count_lines, "wiki": apps.convert_wiki, "vectors": apps.word_vectors}
        run[o.app](spark, o.input, o.output)


if __name__ == "__main__":
    main()
