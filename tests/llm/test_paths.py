"""The ways beyond every bound: shuffles instead of broadcasts, many flushes, many groups."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from textloom.llm import mixing, ngram_join, packing, suffix_dedup

from .helpers import docs_of, prose
from .test_joins import brute_components, brute_removal, corpus, repeats


def test_ngram_join(spark, monkeypatch):
    for name, value in (("BROADCAST_IDS", -1), ("SHARD_ROWS", 6), ("FLUSH", 40), ("BUCKET_SIGNATURES", 50)):
        monkeypatch.setattr(ngram_join, name, value)
    texts = corpus()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.link_components(docs_of(spark, texts)).collect()}
    assert got == brute_components(texts)


def test_ngram_join_without_first_round(spark):
    """Without any centre the second round has to find all links."""
    texts = corpus()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.link_components(docs_of(spark, texts), centres=0).collect()}
    assert got == brute_components(texts)


@pytest.mark.parametrize("allocation", [0, 1, 2])
def test_every_allocation(spark, monkeypatch, allocation):
    """Any allocation gives the same links: with neighbourhoods, and with sets that are short in it."""
    texts = corpus()
    real = ngram_join.allocate
    monkeypatch.setattr(ngram_join, "allocate", lambda sets: (dict.fromkeys(real(sets)[0], allocation), 10**6))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.link_components(docs_of(spark, texts), centres=1).collect()}
    assert got == brute_components(texts)


def test_suffix_dedup(spark, monkeypatch):
    for name, value in (("BROADCAST_IDS", -1), ("FLUSH", 10), ("FLUSH_BYTES", 2_000), ("BUCKET_BYTES", 1_000), ("HOT", 3), ("MANY_COPIES", 1), ("ANCHOR_BYTES", 1_000)):
        monkeypatch.setattr(suffix_dedup, name, value)
    for keep in ("none", "first"):
        got = suffix_dedup.remove_repeats(docs_of(spark, repeats()), keep=keep).collect()
        assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == brute_removal(repeats(), keep)


@pytest.mark.parametrize("bound", [10**6, -1])
def test_suffix_dedup_of_texts_that_share_a_node(spark, monkeypatch, bound):
    """Nodes of four bits, and of five in the second part: most texts clash, some twice, and none is lost or mistaken."""
    real = suffix_dedup.node_of_sha
    monkeypatch.setattr(suffix_dedup, "node_of_sha", lambda part=0: F.pmod(real(part), F.lit(16 if not part else 32)) if part < 2 else real(part))
    monkeypatch.setattr(suffix_dedup, "BROADCAST_IDS", bound)
    for keep in ("none", "first"):
        got = suffix_dedup.remove_repeats(docs_of(spark, repeats()), keep=keep).collect()
        assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == brute_removal(repeats(), keep)


def test_mixing(spark, monkeypatch):
    docs = docs_of(spark, [prose(5 + k % 40, k) for k in range(200)], ["a", "b", None])
    expected = sorted(map(tuple, mixing.mix(docs).collect()), key=str)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", -1)
    monkeypatch.setattr(mixing, "RANGE_ROWS", 3)
    assert sorted(map(tuple, mixing.mix(docs).collect()), key=str) == expected


def test_packing(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ROWS", 2)
    rows = packing.pack(docs_of(spark, ["same"] * 50 + [prose(k, k) for k in range(40)])).collect()
    bins = Counter()
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == bins[r["sequence_id"]]
        bins[r["sequence_id"]] += r["length"]
    assert len(rows) == 90 and max(bins.values()) <= 4096


def test_pipeline_stages(spark, monkeypatch):
    docs = docs_of(spark, [prose(80, k // 2) for k in range(12)], ["a", "b", None])
    several = [corpus_pipeline.drop_near_duplicates, corpus_pipeline.mix_sources]
    expected = [sorted(r["doc_id"] for r in f(spark, docs, "").collect()) for f in several]
    monkeypatch.setattr(corpus_pipeline, "BROADCAST_ROWS", -1)
    assert [sorted(r["doc_id"] for r in f(spark, docs, "").collect()) for f in several] == expected
    assert expected[0] == list(range(0, 12, 2))
