"""Word and line counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import word_tokens


def word_count(lines: DataFrame, text: str = "value") -> DataFrame:
    """word, n. Words that are empty strings do not count."""
    words = lines.select(F.explode(word_tokens(F.col(text))).alias("word")).filter(F.col("word") != "")
    return words.groupBy("word").agg(F.count("*").alias("n"))


def total_words(lines: DataFrame, text: str = "value") -> DataFrame:
    """One row: n_words."""
    words = F.filter(word_tokens(F.col(text)), lambda w: w != "")
    return lines.agg(F.coalesce(F.sum(F.size(words)), F.lit(0)).cast("long").alias("n_words"))


def line_count(lines: DataFrame) -> DataFrame:
    """One row: n_lines."""
    return lines.agg(F.count("*").alias("n_lines"))
