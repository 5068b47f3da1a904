"""Sparse term vectors: terms meet their ids in a join, by broadcast where the vocabulary is small."""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..sources.tables import materialize

#: Words of a vocabulary up to this many are broadcast (some tens of bytes each); more meet the documents' terms by shuffle.
BROADCAST_WORDS = 500_000

#: A dense or sparse vector's size is a 32-bit number.
MOST_SIZE = (1 << 31) - 1


def sparse_rows(terms: DataFrame, vocabulary: DataFrame, keys: list[str], binary: bool = False, term: str = "term", count: str = "n") -> DataFrame:
    """keys, ids (ascending), counts of each document's terms in the vocabulary (term, term_id). terms: keys, term and count,
    one row for each; documents without a known term have no row. A term of very many documents is split as a skewed join is."""
    value = F.lit(1.0) if binary else F.col(count).cast("double")
    words = vocabulary.select(F.col("term").alias("_term"), F.col("term_id").cast("long").alias("_id"))
    words = F.broadcast(words) if vocabulary.count() <= BROADCAST_WORDS else words
    found = terms.select(*keys, F.col(term).alias("_term"), value.alias("_n")).join(words, "_term")
    rows = found.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_id", "_n"))).alias("_v"))
    return rows.select(*keys, F.transform("_v", lambda x: x["_id"]).alias("ids"), F.transform("_v", lambda x: x["_n"]).alias("counts"))


def ml_vectors(rows: DataFrame, size: int, out: str = "features") -> DataFrame:
    """Rows of sparse_rows with an ML vector instead of ids and counts. The table is written with the vectors' parts and read
    back as vectors, so no row passes through Python. Raises ValueError where ids need more than 31 bits."""
    if size > MOST_SIZE:
        raise ValueError(f"a vector has at most {MOST_SIZE} entries, not {size}")
    others = [f for f in rows.schema.fields if f.name not in ("ids", "counts")]
    parts = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), F.col("ids").cast("array<int>").alias("indices"), F.col("counts").alias("values"))
    stored = materialize(rows.select(*[f.name for f in others], parts.alias(out)), "vectors")
    vectors = rows.sparkSession.read.schema(StructType([*others, StructField(out, VectorUDT())])).parquet(stored._kept_in)
    vectors._parts = stored.select(*[f.name for f in others], F.col(out)["indices"].alias("ids"), F.col(out)["values"].alias("counts"))
    vectors._size = size
    return vectors


def vector_parts(vectors: DataFrame) -> DataFrame:
    """The ids and counts of what ml_vectors made, as written: a vector has a row of them, not one for each of its places."""
    return vectors._parts
