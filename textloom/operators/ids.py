"""Dense numbers and places in an order, by ranges: no task sorts more than one range of rows.

Rows are dealt in sampled ranges of the order and written, so that every later step sees the same
ranges; a small table with one row for each range says how many rows are before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import materialize, shuffle_partitions


def _before(value: str, order: str, *by: str) -> Column:
    """Sum of a column over the rows of a group that come earlier."""
    return F.coalesce(F.sum(value).over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _ranges(rows: DataFrame, keys: list[Column], tag: str) -> DataFrame:
    """The rows in ranges of the keys, and the number of each row's range (_part)."""
    dealt = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *keys)
    return materialize(dealt.withColumn("_part", F.spark_partition_id()), tag)


def dense_ids(df: DataFrame, order: list[str], name: str = "id") -> DataFrame:
    """The rows with a column name: their places from 0 in the order of some columns, nulls first, without gaps. Rows that are
    equal in all of them are numbered in any order."""
    keys = [f"_k{i}" for i in range(len(order))]
    rows = df.select(F.struct("*").alias("_row"), *[F.col(c).alias(k) for c, k in zip(order, keys)])
    parts = _ranges(rows, [F.col(k) for k in keys], "dense-ids")
    # one row for each range, of which there are as many as shuffle partitions
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", _before("_n", "_part").alias("_ahead"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*keys)) - 1
    placed = parts.withColumn("_own", own).join(F.broadcast(sizes), "_part")
    return placed.select("_row.*", (F.col("_ahead") + F.col("_own")).alias(name))


def score_places(df: DataFrame, by: list[str], score: str) -> DataFrame:
    """by, score, n, before: for each score of a group its rows and the rows of higher scores. Equal scores are one row, and a
    group's scores lie over several ranges where they are many."""
    groups = [f"_g{i}" for i in range(len(by))]
    counts = df.groupBy(*[F.col(b).alias(g) for b, g in zip(by, groups)], F.col(score).alias("_s")).agg(F.count("*").alias("_n"))
    parts = _ranges(counts, [*map(F.col, groups), F.desc("_s")], "score-places")
    inside = F.coalesce(F.sum("_n").over(Window.partitionBy("_part", *groups).orderBy(F.desc("_s")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # a group has a row in each range that it reaches into
    reach = parts.groupBy(*groups, "_part").agg(F.sum("_n").alias("_m")).withColumn("_ahead", _before("_m", "_part", *groups))
    same = [F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}")) for g in groups]
    both = parts.withColumn("_inside", inside).alias("a").join(reach.alias("b"), [F.col("a._part") == F.col("b._part"), *same])
    return both.select(*[F.col(f"a.{g}").alias(b) for g, b in zip(groups, by)], F.col("_s").alias(score), F.col("_n").alias("n"), (F.col("_ahead") + F.col("_inside")).alias("before"))


def numbered_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Lines of text files with dense ids in the order of files' paths and of lines in them: line_id, value. The ids depend
    on the files alone, not on how they are split; nothing is sorted, as a task reads a block's lines in order."""
    lines = spark.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("_m"))
    blocks = lines.groupBy("file", "block").agg(F.min("_m").alias("_first"), F.count("*").alias("n"))
    files = blocks.groupBy("file").agg(F.sum("n").alias("n")).select("file", _before("n", "file").alias("_ahead"))
    starts = blocks.withColumn("_inside", _before("n", "block", "file")).join(files, "file")
    placed = lines.join(starts.select("file", "block", (F.col("_ahead") + F.col("_inside") - F.col("_first")).alias("_shift")), ["file", "block"])
    return placed.select((F.col("_m") + F.col("_shift")).alias("line_id"), "value")
