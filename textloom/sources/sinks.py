"""Sinks: compressed JSON and text, single values, models' vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How dates are written.
DATES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss'Z'", "timeZone": "UTC"}


def to_json_line(*columns: str) -> Column:
    """One compact JSON line; nulls are left out."""
    return F.to_json(F.struct(*columns), DATES)


def write_json(df: DataFrame, path: str, compression: str = "bzip2") -> None:
    """Replaces path by the rows as compressed JSON lines."""
    df.select(to_json_line(*df.columns).alias("value")).write.mode("overwrite").option("compression", compression).text(path)


def write_text(df: DataFrame, path: str, compression: str = "bzip2") -> None:
    """Replaces path by a one-column frame's strings as compressed text."""
    df.write.mode("overwrite").option("compression", compression).text(path)


def write_rows(df: DataFrame, path: str, compression: str = "bzip2") -> None:
    df.write.mode("overwrite").option("compression", compression).csv(path)


def write_value(df: DataFrame, path: str) -> None:
    """Replaces path by a single value as one text file."""
    df.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in df.columns]).alias("value")).coalesce(1).write.mode("overwrite").text(path)
