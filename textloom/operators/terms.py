"""A dictionary of terms and their normal forms: each different term is normalised once, also over several runs."""

from __future__ import annotations

import pandas as pd
from pyspark.accumulators import Accumulator
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.normalize import normalize_term, term_form

DICTIONARY = "term string, form string"


def normal_forms(terms: DataFrame, seen: Accumulator | None = None) -> DataFrame:
    """term, form of the different terms (a column term): one row of Python for each. seen counts those rows."""
    different = terms.select("term").filter(F.col("term").isNotNull()).distinct()
    if seen is None:
        return different.select("term", term_form(F.col("term"), strict=True).alias("form"))

    @F.pandas_udf(StringType())
    def form(x: pd.Series) -> pd.Series:
        seen.add(len(x))
        return x.map(normalize_term, na_action="ignore")

    return different.select("term", form("term").alias("form"))


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """The dictionary at a path; an empty one where there is none."""
    try:
        return spark.read.schema(DICTIONARY).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], DICTIONARY)


def extend_dictionary(terms: DataFrame, path: str, seen: Accumulator | None = None) -> DataFrame:
    """The dictionary at a path with all of these terms. Only those that it lacks are normalised, and appended to it; of
    runs at one time each appends what it lacks, so readers take a term once (distinct)."""
    spark = terms.sparkSession
    known = read_dictionary(spark, path)
    lacking = terms.select("term").join(known.select("term"), "term", "left_anti")
    normal_forms(lacking, seen).write.mode("append").parquet(path)
    return read_dictionary(spark, path).distinct()


def formed(rows: DataFrame, dictionary: DataFrame | None, strict: bool = False, out: str = "stem") -> DataFrame:
    """The rows (with a column term) and their terms' forms, from the dictionary or, without one, row by row. Unless strict,
    blanks at the ends go, and rows whose form is empty."""
    if dictionary is None:
        named = rows.withColumn(out, term_form(F.col("term"), strict))
    else:
        form = F.col("form") if strict else F.trim("form")
        named = rows.join(dictionary.select("term", form.alias(out)), "term")
    return named if strict else named.filter(F.col(out) != "")
