"""Daily activity over a stream: an extension, with the batch operator's rules and a watermark for late events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_activity(events: DataFrame, by: str, time: str = "ts", late: str = "2 days") -> DataFrame:
    """Events by day and key: by, day, n. In append mode a day comes out once no event of it can still be on time."""
    counted = events.withWatermark(time, late).groupBy(by, F.window(time, "1 day").alias("w")).agg(F.count("*").alias("n"))
    return counted.select(by, F.col("w.start").alias("day"), "n")
