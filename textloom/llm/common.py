"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import spread

#: ASCII white space as the contracts define it: blank and U+0009 to U+000D.
WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table, or some of its columns, over all cores."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df.select(*columns) if columns else df)


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


#: Rows of a file, about, where their number is known before they are written.
FILE_ROWS = 200_000


def materialize(df: DataFrame, tag: str, rows: int | None = None) -> DataFrame:
    """Cuts the lineage: writes df as Parquet in the shared folder and reads it back. Of so many small rows at most, few files."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/textloom/{tag}-{uuid.uuid4().hex}"
    if rows is not None:
        df = df.coalesce(max(spark.sparkContext.defaultParallelism, -(-rows // FILE_ROWS)))
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._kept_in = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes materialized tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._kept_in)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release() -> None:
    """Gives what this process has freed back to the system; without it a worker that goes on to the next stage, as all
    do, keeps the most that any stage before took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function on batches whose worker releases memory before and behind it."""

    def one(batches: Iterator) -> Iterator:
        release()
        yield from run(batches)
        release()

    return one


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def let(value: Column, body) -> Column:
    """body(value) with value computed once for each row, however often body (or a lambda in it) reads it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """All [^\\x20\\x09-\\x0D]+ of the text, in order; null text: none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    none = F.array().cast("array<string>")
    return F.when(bare == "", none).otherwise(F.split(bare, WHITE_RUN))


def n_of(text: Column, chars: str) -> Column:
    """How many characters of the text are among chars (code points)."""
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")
