"""Vocabularies and term vectors."""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ids import dense_ids


def without_stop_words(terms: DataFrame, stop_words: DataFrame | list[str], term: str = "term") -> DataFrame:
    """Rows whose term is no stop word; counts of the others stay as they are."""
    if isinstance(stop_words, list):
        return terms.filter(~F.col(term).isin(stop_words)) if stop_words else terms
    words = stop_words.select(F.col(stop_words.columns[0]).alias(term)).distinct()
    return terms.join(words, term, "left_anti")


def vocabulary(terms: DataFrame) -> DataFrame:
    """Different terms with dense ids in order of their names: term, term_id. No task sorts more than one range of them."""
    return dense_ids(terms.select("term").distinct(), ["term"], "term_id")


def top_words(counts: DataFrame, size: int = -1, count: str = "n", word: str = "word") -> DataFrame:
    """The size most frequent words, ties by name; -1: all."""
    return counts if size == -1 else counts.orderBy(F.desc(count), F.asc(word)).limit(size)


#: Words that a driver can hold for a model; more are an error, not cut off.
MOST_WORDS = 5_000_000


def driver_words(words: DataFrame, most: int = MOST_WORDS) -> list[str]:
    """A column of words as a list, which LDA and count vectors need on the driver. Raises ValueError above most."""
    got = [r[0] for r in words.limit(most + 1).collect()]
    if len(got) > most:
        raise ValueError(f"the vocabulary has more than {most} words; select fewer")
    return got


def term_vectors(docs: DataFrame, words: list[str], column: str = "terms", out: str = "features", binary: bool = False) -> DataFrame:
    """Sparse count vectors of array columns over a given vocabulary; other words are left out."""
    spark_model = CountVectorizerModel.from_vocabulary(words, column, out)
    return spark_model.setBinary(binary).setMinTF(1.0).transform(docs)


def vocabulary_terms(rows: DataFrame, words: DataFrame, term: str = "term") -> DataFrame:
    """Rows whose term is in the vocabulary."""
    return rows.join(words.select(term).distinct(), term)
