"""Intermediate tables: Parquet in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows of a file, about, where their number is known before they are written.
FILE_ROWS = 200_000


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where it is unset and everything runs in one process, as in
    tests, a new folder; elsewhere RuntimeError, as executors would not see each other's files."""
    got = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not got:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        got = "file://" + tempfile.mkdtemp(prefix="textloom-")
        spark.sparkContext.setCheckpointDir(got)
        got = spark.sparkContext.getCheckpointDir()
    return got.rstrip("/")


#: Whether Spark deletes a query's shuffle files when it ends; else they stay until the driver's memory is cleared.
CLEARED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, tag: str, rows: int | None = None, clear: bool = False) -> DataFrame:
    """Cuts the lineage: writes df as Parquet in the shared folder and reads it back. Of so many small rows at most, few files.
    clear: what was shuffled for it is deleted when it is written."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/textloom/{tag}-{uuid.uuid4().hex}"
    if rows is not None:
        df = df.coalesce(max(spark.sparkContext.defaultParallelism, -(-rows // FILE_ROWS)))
    before = spark.conf.get(CLEARED, None)
    if clear:
        spark.conf.set(CLEARED, "true")
    try:
        df.write.parquet(path)
    finally:
        if clear:
            spark.conf.set(CLEARED, before) if before else spark.conf.unset(CLEARED)
    out = spark.read.schema(df.schema).parquet(path)
    out._kept_in = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes materialized tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._kept_in)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
