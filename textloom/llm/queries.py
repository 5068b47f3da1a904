"""One query for each training-data operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_formatting, collocations, media_columns, mixing, ngram_join, packing, quality_rules, secret_scans, suffix_dedup, token_files, toxicity, warc_derivatives, whitening
from .common import table
from .oracles import ORACLES as ORACLES

PROBE = r"\### Assistant: </turn> ok"


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_components(table(spark, sf_dir, "documents", "doc_id", "text"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.score_documents(docs, model)


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents", "doc_id", "text", "source")).drop("source")


def op5_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_derivatives.record_index(table(spark, sf_dir, "pages"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text")
    )
    return chat_formatting.read_back(chat_formatting.format_chats(chats.unionByName(probe)))


def op7_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns.media_digests(table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text")).drop("spans")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = quality_rules.ledger(table(spark, sf_dir, "documents", "doc_id", "text"))
    return led.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        quality_rules.rejects("base").alias("base_failed"), (~quality_rules.rejects("v1")).alias("kept"), "bits", "n_lines", "n_upper", "n_exclaim",
    )


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scans.secret_scan(table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents", "text", "lang"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.write_ids(table(spark, sf_dir, "documents", "doc_id", "text"))
    return token_files.read_ids(spark, folder)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return rows.withColumn("deviation", F.col("deviation").cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_join, op2_best_fit_packing, op3_toxicity, op4_source_mixing, op5_warc_derivatives, op6_chat_formatting, op7_media_columns, op8_suffix_dedup, op9_quality_rules,
        op10_secret_scans, op11_phrase_collocations, op12_token_files, op13_embedding_whitening,
    )
}
