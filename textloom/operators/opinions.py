"""Popularity of opinions, their terms, daily activity and tags."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import normalized
from .ranking import first_rows

#: Days after which an opinion counts for nothing.
DAYS = 30


def whole_hours(since: Column, as_of: Column) -> Column:
    """Whole hours between two times, toward zero."""
    return ((F.unix_timestamp(as_of) - F.unix_timestamp(since)) / 3600).cast("long")


def buzz_value(date: Column, up: Column, down: Column, as_of: Column, min_hours: int = 1, strict: bool = False) -> Column:
    """Popularity of one opinion: votes times a decay over DAYS. An age below min_hours counts as min_hours, a date
    in the future as none. Strict: age zero is infinite and a future date not a number."""
    hours = whole_hours(date, as_of)
    votes = F.log(F.lit(math.e) + F.coalesce(up, F.lit(0))) / F.log(F.lit(math.e) + F.coalesce(down, F.lit(0)))
    aged = F.greatest(hours, F.lit(0 if strict else min_hours))
    decay = F.when(aged > 0, F.greatest(F.lit(0.0), F.log(F.lit(float(DAYS)) / (F.when(aged > 0, aged) / 24.0))))
    if strict:
        return F.when(hours < 0, F.lit(math.nan)).when(hours == 0, F.lit(math.inf)).otherwise(votes * decay)
    return F.when(F.unix_timestamp(date) > F.unix_timestamp(as_of), 0.0).otherwise(votes * decay)


def buzz_meta(opinions: DataFrame, by: list[str], as_of: Column, **how: object) -> DataFrame:
    """by, buzz_score (dated opinions only), opinion_count, opinion_votes."""
    value = buzz_value(F.col("date_published"), F.col("votes_up"), F.col("votes_down"), as_of, **how)
    return opinions.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(F.col("date_published").isNotNull(), value)), F.lit(0.0)).alias("buzz_score"),
        F.count("*").alias("opinion_count"),
        F.sum(F.coalesce("votes_up", F.lit(0)).cast("long") + F.coalesce("votes_down", F.lit(0))).alias("opinion_votes"),
    )


def opinion_terms(terms: DataFrame, by: list[str], n: int = 10) -> DataFrame:
    """The n terms in most opinions of a group, in their most frequent written form: by, form, n, place. Terms have
    by, term and form."""
    forms = terms.groupBy(*by, "term", "form").agg(F.count("*").alias("k"))
    best = forms.groupBy(*by, "term").agg(F.sum("k").alias("n"), F.min(F.struct((-F.col("k")).alias("k"), "form"))["form"].alias("form"))
    return first_rows(best, by, [F.desc("n"), F.asc("form"), F.asc("term")], n, ["term"]).select(*by, "form", "n", "place")


def activity(items: DataFrame, by: str, date: str = "date_published") -> DataFrame:
    """Daily opinions and interactions (votes on them) of items (by, date, n_opinions, n_votes); items without date are left out.
    Days are those of the item, not of its opinions."""
    dated = items.filter(F.col(date).isNotNull())
    return dated.groupBy(by, F.date_trunc("DAY", date).alias("day")).agg(
        F.sum("n_opinions").cast("long").alias("opinion_count"), F.sum("n_votes").cast("long").alias("interaction_count")
    )


def tag_counts(items: DataFrame, tags: str = "tags", n: int = 100, plain: bool = False) -> DataFrame:
    """The n most frequent tags by their normal form, ties by name: tag, score."""
    each = items.select(F.explode(tags).alias("tag"))
    each = each if plain else each.select(normalized(F.col("tag")).alias("tag"))
    return each.groupBy("tag").agg(F.count("*").alias("score")).orderBy(F.desc("score"), "tag").limit(n)
