"""Top-n and top-share selection that keeps ties.

retain_top and retain_top_share rank a group in one task: for groups of bounded size, such as the terms of a document. The
functions for hot groups bound what of a group meets in a task, whatever its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import shuffle_partitions
from .ids import score_places


def nth_largest(values: Column, n: int) -> Column:
    """The n-th largest value of an array, the smallest where it has fewer; null for an empty array."""
    if n < 1:
        raise ValueError("n starts at 1")
    ordered = F.sort_array(values, asc=False)
    return F.get(ordered, F.least(F.lit(n), F.size(values)) - 1)


def retain_top(df: DataFrame, by: list[str], score: str, n: int) -> DataFrame:
    """Rows whose score reaches the n-th highest of their group; ties stay, so there may be more."""
    if n < 1:
        raise ValueError("n starts at 1")
    place = F.rank().over(Window.partitionBy(*by).orderBy(F.desc(score)))
    return df.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")


def retain_top_share(df: DataFrame, by: list[str], score: str, share: float) -> DataFrame:
    """As retain_top with n = share of the group's rows, rounded down, one at least."""
    if not 0 <= share <= 1:
        raise ValueError(f"a share is between 0 and 1, not {share}")
    place = F.rank().over(Window.partitionBy(*by).orderBy(F.desc(score)))
    n = F.greatest(F.floor(F.count("*").over(Window.partitionBy(*by)) * F.lit(float(share))), F.lit(1))
    return df.withColumn("_place", place).withColumn("_n", n).filter(F.col("_place") <= F.col("_n")).drop("_place", "_n")


def top_rows(df: DataFrame, score: str, tie: str, n: int) -> DataFrame:
    """The n rows of the highest score, ties by name."""
    return df.orderBy(F.desc(score), F.asc(tie)).limit(n)


def first_rows(df: DataFrame, by: list[str], order: list[Column], n: int, spread: list[str], place: str = "place") -> DataFrame:
    """The first n rows of each group in a total order, with their places from 1. Rows of a group are dealt by the columns
    spread; each part names its first n, so that of a group n rows for each shuffle partition meet at most."""
    part = F.pmod(F.xxhash64(*spread), F.lit(shuffle_partitions(df.sparkSession)))
    rows = df.withColumn("_part", part)
    near = rows.withColumn(place, F.row_number().over(Window.partitionBy(*by, "_part").orderBy(*order))).filter(F.col(place) <= n)
    return near.drop("_part").withColumn(place, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col(place) <= n)


def _least_scores(df: DataFrame, by: list[str], score: str, wanted: Column) -> DataFrame:
    """by and the least score that is kept (_least; _nulls: rows without a score are kept too). wanted may use _total, the group's rows."""
    places = score_places(df, by, score).select(*[F.col(b).alias(f"_b{i}") for i, b in enumerate(by)], F.col(score).alias("_s"), "n", "before")
    groups = [f"_b{i}" for i in range(len(by))]
    totals = places.groupBy(*[F.col(g).alias(f"_of{g}") for g in groups]).agg(F.sum("n").alias("_total"))
    same = [F.col(g).eqNullSafe(F.col(f"_of{g}")) for g in groups]
    kept = places.join(totals, same).filter(F.col("before") < wanted).select(*groups, "_s")
    return kept.groupBy(*groups).agg(F.min("_s").alias("_least"), F.max(F.col("_s").isNull()).alias("_nulls"))


def _reaching(df: DataFrame, by: list[str], score: str, wanted: Column) -> DataFrame:
    least = _least_scores(df, by, score, wanted)
    same = [F.col(b).eqNullSafe(F.col(f"_b{i}")) for i, b in enumerate(by)]
    return df.join(least, [*same, (F.col(score) >= F.col("_least")) | (F.col(score).isNull() & F.col("_nulls"))]).select(*df.columns)


def retain_top_hot(df: DataFrame, by: list[str], score: str, n: int) -> DataFrame:
    """As retain_top for groups of any size: a group's scores are counted and placed over ranges, and the rows that reach the
    n-th highest row's score are found by a join with one row for each group."""
    if n < 1:
        raise ValueError("n starts at 1")
    return _reaching(df, by, score, F.lit(n))


def retain_top_share_hot(df: DataFrame, by: list[str], score: str, share: float) -> DataFrame:
    """As retain_top_share for groups of any size."""
    if not 0 <= share <= 1:
        raise ValueError(f"a share is between 0 and 1, not {share}")
    return _reaching(df, by, score, F.greatest(F.floor(F.col("_total") * F.lit(float(share))), F.lit(1)))
