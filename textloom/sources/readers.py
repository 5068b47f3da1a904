"""Scans: articles as JSON lines, plain text, wiki XML, word lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import space_split
from .schemas import ARTICLE, WIKI_PAGE


#: Inputs of fewer bytes than this for each core, in fewer files than cores, are dealt anew: a file may be a single row
#: group, so a single task.
SMALL_SHARE = 4 << 20
#: Bytes of a stored input for a task, about, where its rows take long.
TASK_BYTES = 4 << 20
#: Tasks for each core that slow rows are dealt to at least.
ROUNDS = 3


def spread(df: DataFrame, slow: bool = False) -> DataFrame:
    """A small input over as many partitions as there are cores; a larger one as its files give it. slow: rows that take long
    are dealt to more tasks as the input grows, however few files hold it."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    parts = max(cores, -(-size // TASK_BYTES)) if slow else cores
    return df.repartition(parts) if (slow or size < SMALL_SHARE * cores) and len(df.inputFiles()) < parts else df


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows by keys over some tasks for each core, more as the input grows. Adaptive execution joins partitions by their bytes to
    hardly more than there are cores, so what takes long for its bytes ends in a second round of few tasks; it leaves these alone."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(max(ROUNDS * df.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES)), *keys)


def parse_articles(lines: Column) -> Column:
    """A JSON line as an article; malformed lines and those without _id raise, and the error names the line."""
    got = F.from_json(lines, ARTICLE, {"mode": "PERMISSIVE", "timeZone": "UTC"})
    ok = F.coalesce(F.get_json_object(lines, "$._id").isNotNull(), F.lit(False)) & got["_id"].isNotNull()
    return F.when(ok, got).otherwise(F.raise_error(F.concat(F.lit("can't parse article line: "), lines)))


def read_articles(spark: SparkSession, path: str | list[str], partitions: int | None = None) -> DataFrame:
    """Articles from JSON lines (a file, folder, glob or compressed files), a row for each line; unique_articles keeps one of each _id."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    articles = lines.select(parse_articles(F.col("value")).alias("a")).select("a.*")
    return articles.repartition(partitions) if partitions else articles


def unique_articles(articles: DataFrame) -> DataFrame:
    """One article of each _id: the one whose line is the first in order of its JSON."""
    line = F.to_json(F.struct(*articles.columns))
    return articles.groupBy("_id").agg(F.min_by(F.struct(*articles.columns), line).alias("a")).select("a.*")


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.text(list(paths))


def read_wiki(spark: SparkSession, path: str) -> DataFrame:
    """Pages of a wiki dump: id, title, text."""
    pages = spark.read.format("xml").option("rowTag", "page").schema(WIKI_PAGE).load(path)
    return pages.select("id", "title", F.coalesce("revision.text", F.lit("")).alias("text"))


def read_token_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines split at single blanks: column words."""
    return spark.read.text(path).select(space_split(F.col("value")).alias("words"))


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """The different words of a list, separated by white space: column word."""
    words = spark.read.text(path).select(F.explode(F.split("value", r"\s+")).alias("word"))
    return words.filter(F.col("word") != "").distinct()


def in_memory(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)
