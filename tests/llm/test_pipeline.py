import random
import zlib
from collections import Counter, defaultdict

import numpy as np

import corpus_pipeline
from textloom.llm import quality_rules, secret_scans

from .helpers import ODD, SCHEMA, WORD, docs_of, edited, prose, rows_of
from .test_joins import brute_components


def corpus():
    r = random.Random(8)
    texts = list(ODD)
    for k in range(60):
        base = prose(r.randint(40, 400), k)
        texts.append(base)
        if k % 4 == 0:
            texts += [base, edited(base, 0.01, k)]
        if k % 7 == 0:
            texts.append(f"{prose(90, 500 + k)} token=abcdef{k:04d}")
    return texts


def test_stages(spark, tmp_path):
    sources = ["a", "b", None]
    texts = corpus()
    docs = docs_of(spark, texts, sources)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    names = docs.columns
    out, left = {}, docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        done = stage(spark, left, str(tmp_path))
        if k < 4:
            assert done.columns == names
        done.write.parquet(str(tmp_path / f"{k}"))
        left = spark.read.parquet(str(tmp_path / f"{k}"))
        out[k] = left.collect()

    led = {r["doc_id"]: r["bits"] for r in quality_rules.ledger(docs).collect()}
    assert sorted(r["doc_id"] for r in out[0]) == [i for i in range(len(texts)) if not led[i] & quality_rules.POLICIES["v1"]]
    ids = sorted(r["doc_id"] for r in out[0])
    roots = brute_components([texts[i] for i in ids])
    assert sorted(r["doc_id"] for r in out[1]) == [i for k, i in enumerate(ids) if roots[k][1] == k]
    assert {r["doc_id"]: r["text"] for r in out[2]} == {r["doc_id"]: secret_scans.redact(texts[r["doc_id"]]) for r in out[1]}
    sizes, taken, times = Counter(), Counter(), Counter()
    for r in out[2]:
        sizes[r["source"]] += len(WORD.findall(r["text"]))
    for r in out[3]:
        taken[r["source"]] += len(WORD.findall(r["text"]))
        times[r["doc_id"]] += 1
    assert set(times) <= {r["doc_id"] for r in out[2]} and max(times.values()) <= 2 and taken.keys() <= sizes.keys()
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= 3 * 400
    from tokenizers import Tokenizer

    from textloom.llm.packing import tokenizer_path

    whole = Tokenizer.from_file(tokenizer_path())
    text = {r["doc_id"]: r["text"] for r in out[3]}
    bins = defaultdict(int)
    for r in out[4]:
        ids = whole.encode(text[r["doc_id"]], add_special_tokens=False).ids + [1]
        assert zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"]
        bins[r["sequence_id"]] += r["length"]
    assert Counter(r["doc_id"] for r in out[4] if r["piece"] == 0) == times and max(bins.values()) <= 4096
    row = lambda r: (r["doc_id"], r["piece"], r["ids_crc32"])
    assert sorted(map(row, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(map(row, out[4]))


def test_repeated_ids_and_nothing(spark):
    text = prose(80, 1)
    rows = docs_of(spark, [text, text, prose(90, 2)]).replace(1, 0, ["doc_id"])
    kept = corpus_pipeline.drop_near_duplicates(spark, rows, "").collect()
    assert sorted(r["doc_id"] for r in kept) == [0, 2]
    left = docs_of(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        left = stage(spark, left, "")
    assert left.collect() == []


def test_rows_without_ids_of_their_own(spark):
    apart = [prose(80, k) for k in range(8)]
    copy = edited(apart[0], 0.01, 1)
    texts = [apart[0], copy, *apart[1:], apart[2], apart[1]]
    ids = [5, None, None, None, None, 7, 7, 5, None, None, 9]
    docs = spark.createDataFrame([(i, *r[1:]) for i, r in zip(ids, docs_of(spark, texts, ["a", None]).collect())], docs_of(spark, []).schema)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    # the copy goes for the text it is linked to, the repeated row as a copy, the text without an id for the same with one
    expected = [(5, apart[0]), (9, apart[1]), (None, apart[2]), (None, apart[3]), (7, apart[4]), (7, apart[5]), (5, apart[6]), (None, apart[7])]
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted(expected, key=str)
    left = spark.createDataFrame(kept, docs.schema)
    taken = corpus_pipeline.mix_sources(spark, left, "").collect()
    times = Counter((r["doc_id"], r["text"], r["source"]) for r in taken)
    assert set(times) <= {(r["doc_id"], r["text"], r["source"]) for r in kept}
    # sources of equal size as the mix takes them: 1.5 times all words within half a document a source
    assert abs(sum(80 * n for n in times.values()) - 1.5 * 80 * len(kept)) <= 80


def test_copies_that_differ_in_other_columns(spark):
    """Of rows of one id and text the same one stays in every run, whatever the order of rows."""
    text = prose(80, 5)
    rows = [(1, text, "en", s, 3, "n", "s", k, "b", "i") for s, k in (("b", "x"), ("a", "y"), (None, "z"), ("a", "x"))] + rows_of([prose(70, 9)] * 2)[1:]
    kept = []
    for order in (rows, rows[::-1]):
        out = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(order, SCHEMA).repartition(3), "")
        assert out.columns == docs_of(spark, []).columns
        kept.append(sorted(map(tuple, out.collect()), key=str))
    assert kept[0] == kept[1] and len(kept[0]) == 2 and {r[0] for r in kept[0]} == {1}
