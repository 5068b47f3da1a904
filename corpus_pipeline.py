"""The document pipeline: quality rules, near duplicates, secrets, mixing, packing.

Every stage takes (spark, docs, sf_dir), works on all documents its predecessor kept and gives
a DataFrame; all but the last give the columns of documents.

Defined results: null and empty texts fail the rules and go; texts of any length are read whole;
of equal or linked documents the one with the smallest id stays, one with a null id only where no
linked one has an id, of equal ids the one whose text has the smallest hash; documents that share
an id, or have none, are told apart by their texts; rows of the same id and text count as copies,
of which the first by its columns' JSON stays;
rows of one id, text and source that reach the mix are taken as often as the most taken of them;
an empty table gives no rows; further columns, whatever their names, are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import mixing, ngram_join, packing, quality_rules, secret_scans
from textloom.llm.common import discard, materialize, table

#: Rows of an id, a hash of the text and the like up to this many are broadcast (some tens of bytes each), more are joined by shuffle.
BROADCAST_ROWS = 200_000


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _own(docs: DataFrame, *names: str) -> list[str]:
    """The names, or longer ones where the documents have columns of those names."""
    taken = {c.lower() for c in docs.columns}
    while taken & {n.lower() for n in names}:
        names = tuple(f"_{n}" for n in names)
    return list(names)


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules' policy keeps."""
    return quality_rules.filter_documents(docs, "v1")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents."""
    id_, hash_ = _own(docs, "_id", "_hash")
    classes = materialize(ngram_join.linked_rows(docs), "pipeline-classes")
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(hash_))
    named = [F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_)]
    others = _small(classes.filter(~F.col("stays")).select(*named).distinct())
    left = docs.join(others, same, "left_anti")
    again = _small(classes.filter("stays").groupBy(*named).count().filter("count > 1").select(id_, hash_))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    # of rows of one id and text the first by all their columns, so that reruns agree
    first = F.min_by(whole, F.to_json(whole, {"ignoreNullFields": "false"})).alias(id_)
    marked = left.join(again, same, "left_semi").groupBy("doc_id", "text").agg(first).select(f"{id_}.*")
    return left.join(again, same, "left_anti").unionByName(marked)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked."""
    return secret_scans.redact_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    id_, source_, hash_, times_ = _own(docs, "_id", "_source", "_hash", "_times")
    named = docs.select("doc_id", "text", "source", F.xxhash64("text").alias(hash_))
    taken = mixing.mix(named, also=(hash_,)).filter("taken > 0")
    rows = taken.groupBy(F.col("doc_id").alias(id_), F.col("source").alias(source_), hash_)
    times = materialize(rows.agg(F.max(F.col("taken") / F.col("size")).cast("int").alias(times_)), "pipeline-times")
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & F.col("source").eqNullSafe(F.col(source_)) & (F.xxhash64("text") == F.col(hash_))
    both = docs.join(_small(times), same)
    # explode puts a row out for each element, whatever it is
    return both.withColumn(times_, F.explode(F.sequence(F.lit(1), F.col(times_)))).select([F.col(f"`{c}`") for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in sequences."""
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [
    ("quality rules", keep_by_rules),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]
#: Tokenization can't be said in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    read = None
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{k}")
            if read is not None:
                discard(read)
            read = docs
    return docs
