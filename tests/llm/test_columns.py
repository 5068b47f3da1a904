"""Phrase collocations, token files and whitening, against brute force and exact round trips."""

import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from textloom.llm import collocations, token_files, whitening
from textloom.llm.elias_fano import STEP, EliasFano, encoded
from textloom.llm.oracles import ORACLES
from textloom.llm.packing import tokenizer_path

from .helpers import ODD, docs_of

# ---------------------------------------------------------------- phrase collocations


def brute_phrases(rows, least, top):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f.setdefault(lang, Counter()).update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        candidates = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside = {p[i : i + k] for p, a in candidates.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * a >= 80 * c[p[i : i + k]]}
        rows = []
        for p, a in candidates.items():
            if p not in inside:
                score, k = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -score) for i, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def phrase_rows():
    r = np.random.default_rng(5)
    words = ["alpha", "Beta", "gamma", "delta", "New", "York", "x\x1fy", "ä", "Über", "zu", "z"]
    rows = []
    for i in range(300):
        lang = (None, "de", "en", "und")[i % 4]
        text = "".join(str(w) + str(r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\r\n", "\x0b"])) for w in r.choice(words, r.integers(1, 40), p=np.array([9, 8, 7, 6, 6, 5, 3, 3, 2, 1, 1]) / 51))
        rows.append((lang, text))
    rows += [("en", "New York is New York"), ("en", "a b a b a b a")] * 40 + [("de", t) for t in ODD] + [(None, None)]
    return rows


@pytest.fixture(scope="module")
def phrases(spark):
    rows = phrase_rows()
    return rows, spark.createDataFrame([(i, lang, text, "n", "w", 1) for i, (lang, text) in enumerate(rows)], "id long, lang string, text string, n string, word string, pivot int")


@pytest.mark.parametrize("least, top", [(30, 2000), (3, 15), (1, 40)])
def test_collocations_against_brute_force(phrases, least, top):
    rows, docs = phrases
    assert sorted(map(tuple, collocations.collocations(docs, least=least, top=top).collect())) == brute_phrases(rows, least, top)


@pytest.mark.parametrize("bounds", [{"MOST_WORDS": 0}, {"PIVOT_ROWS": 3, "BUFFER": 50}, {"MOST_WORDS": 0, "PIVOT_ROWS": 2, "BUFFER": 7, "SALTS": 2, "RANK_SHARDS": 1}])
def test_collocations_beyond_the_bounds(phrases, monkeypatch, bounds):
    """Words joined by shuffle, pivots in many shards, many flushes."""
    for name, value in bounds.items():
        monkeypatch.setattr(collocations, name, value)
    rows, docs = phrases
    assert sorted(map(tuple, collocations.collocations(docs, least=5).collect())) == brute_phrases(rows, 5, 2000)


def test_mining_tasks_grow_with_the_input(phrases, monkeypatch):
    """a task mines MINED occurrences, about, however many there are, so its counts stay in memory."""
    asked, mine = [], collocations.mine
    monkeypatch.setattr(collocations, "MINED", 500)
    monkeypatch.setattr(collocations, "mine", lambda *args: asked.append((args, mine(*args))) or asked[-1][1])
    rows, docs = phrases
    assert sorted(map(tuple, collocations.collocations(docs, least=5).collect())) == brute_phrases(rows, 5, 2000)
    (_, least, tasks), mined = asked[0]
    assert tasks > 8 and mined._jdf.queryExecution().executedPlan().toString().count(f", {tasks})") >= 2


def test_collocations_in_sql(phrases, spark):
    rows, docs = phrases
    import pyarrow as pa

    con = duckdb.connect()
    con.register("documents", pa.table({"lang": [r[0] for r in rows], "text": [r[1] for r in rows]}))
    assert sorted(con.sql(ORACLES["op11_phrase_collocations"]).fetchall()) == brute_phrases(rows, 30, 2000)


def test_collocations_of_nothing(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(empty).collect() == []
    assert collocations.collocations(spark.createDataFrame([(None, None), ("en", "  "), ("en", "once only")], "lang string, text string")).collect() == []


@given(st.lists(st.integers(0, 6), max_size=40), st.integers(1, 4))
@settings(deadline=None, max_examples=60)
def test_every_phrase_has_one_owner(said, shards):
    """Each occurrence of a phrase of frequent words is in one fragment, that of its first rarest word."""
    count = np.array([0, 9, 9, 7, 5, 5, 1])
    ids = np.array(said, np.int64)
    got = Counter()
    for pivot, _, *around in collocations.fragments_of(ids, count[ids], shards, 2).T.tolist():
        left, right = [x for x in around[:3] if x], [x for x in around[3:] if x]
        for i in range(len(left) + 1):
            for j in range(len(right) + 1):
                if 1 <= i + j <= 3:
                    got[(*left[:i][::-1], pivot, *right[:j])] += 1
    want = Counter(tuple(said[i : i + k]) for k in (2, 3, 4) for i in range(len(said) - k + 1) if all(said[i : i + k]))
    assert got == want


# ---------------------------------------------------------------- token files


@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 50), max_size=3 * STEP), st.data())
@settings(deadline=None, max_examples=60)
def test_elias_fano(values, data):
    values = np.sort(np.array(values, np.uint64))
    code = encoded(values)
    got = EliasFano(b"before" + code + b"behind", 6)
    assert got.n == len(values) and got.end == 6 + len(code)
    assert (got[np.arange(len(values))] == values).all()
    some = np.array(sorted(data.draw(st.sets(st.integers(0, max(0, len(values) - 1)), max_size=5)))[: len(values)], np.int64)
    assert (got[some] == values[some]).all()


def test_boundaries_take_few_bits():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 3000, 60_000))
    # 2 bits and the logarithm of the mean length, and a sample of 32 bits in STEP
    assert 8 * len(encoded(ends)) / len(ends) < 2 + np.log2(1500) + 32 / STEP + 1


def id_rows(docs):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    start, out = 0, []
    for doc_id, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), ids.tolist()))
        start += len(ids)
    return out


@pytest.mark.parametrize("sizes", [{}, {"file_ids": 50}, {"file_docs": 1}, {"file_ids": 10**9, "file_docs": 3}])
def test_token_files(spark, tmp_path, sizes):
    docs = [(7 * i - 40, t) for i, t in enumerate(ODD)] + [(2**62, "far away"), (-(2**63), "first")]
    frame = spark.createDataFrame([(d, t, "f", 1, "i") for d, t in docs], "doc_id long, text string, file string, start int, id string")
    folder = token_files.write_ids(frame, f"file://{tmp_path}/ids", **sizes)
    got = sorted(map(tuple, token_files.read_ids(spark, folder, with_ids=True).collect()))
    assert got == id_rows(sorted(docs, key=lambda d: d[0]))
    assert [r[:4] for r in got] == sorted(map(tuple, token_files.read_ids(spark, folder).collect()))


def test_token_files_of_nulls_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(token_files, "BROADCAST_FILES", -1)
    docs = [(None, "no id"), (None, None), (3, "same"), (3, "same"), (3, "other"), (None, "no id")]
    frame = spark.createDataFrame(docs, "doc_id int, text string")
    rows = sorted(map(tuple, token_files.read_ids(spark, token_files.write_ids(frame)).collect()), key=lambda r: r[1])
    assert [r[0] for r in rows] == [None, None, None, 3, 3, 3]
    assert [r[1] for r in rows] == np.cumsum([0, *[r[2] for r in rows[:-1]]]).tolist()
    assert Counter(r[2:] for r in rows) == Counter(r[2:4] for r in id_rows(docs))


def test_token_files_of_nothing_and_of_other_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.read_ids(spark, token_files.write_ids(empty)).collect() == []
    with pytest.raises(TypeError):
        token_files.write_ids(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_wide_ids_and_broken_files():
    ids = np.array([70_000, 1, 5, 1], "<u4").tobytes()
    file = token_files.IdFile(token_files.packed(ids, [2, 4], [None, 9]))
    assert file.ids.dtype.itemsize == 4 and file.ids.tolist() == [70_000, 1, 5, 1] and file.doc_ids(np.arange(2)) == [None, 9]
    with pytest.raises(ValueError, match="not a file"):
        token_files.IdFile(b"x" * 100)


# ---------------------------------------------------------------- whitening


def brute_white(vectors, k):
    """Components of integer vectors in numpy, and exact deviations."""
    x = np.array([[int(np.floor(1024 * float(c))) + 100_000 for c in v] for v in vectors], object)
    n, total = len(x), x.sum(axis=0)
    far = ((n * x - total) ** 2).sum(axis=1).tolist()
    centred = ((n * x - total) / n).astype(float)
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1], basis[:, ::-1]
    return far, centred @ basis[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def vectors_of(spark, vectors):
    return spark.createDataFrame([(i, v, "id", 0.5) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, id string, w double")


def test_whitening_against_brute_force(spark):
    r = np.random.default_rng(3)
    good = (r.normal(size=(200, 12)) @ r.normal(size=(12, 12)) + r.normal(size=12)).astype(np.float32).tolist()
    good += [good[0]] * 5
    bad = [None, [], [1.0] * 11 + [None], [float("nan")] * 12, [float("inf")] + [0.0] * 11, [1.0, 2.0]]
    rows = whitening.whiten(vectors_of(spark, [*good, *bad])).collect()
    far, white, explained = brute_white(good, 8)
    assert {(x["vec_id"], x["component"]) for x in rows} == {(i, k) for i in range(205) for k in range(1, 9)} and len(rows) == 205 * 8
    got = np.zeros((205, 8))
    for x in rows:
        got[x["vec_id"], x["component"] - 1] = x["whitened"]
        assert x["n"] == 205 and int(x["deviation"]) == far[x["vec_id"]] and x["identity_error"] < 1e-9
        assert abs(x["explained"] / explained[x["component"] - 1] - 1) < 1e-9
    signs = np.sign((got * white).sum(axis=0))
    assert np.abs(got * signs - white).max() < 1e-6


def test_whitening_in_several_aggregations(spark, monkeypatch):
    monkeypatch.setattr(whitening, "MOST_PAIRS", 4)
    vectors = np.random.default_rng(4).normal(size=(60, 5)).tolist()
    rows = whitening.whiten(vectors_of(spark, vectors)).collect()
    assert len(rows) == 60 * 5 and rows[0]["identity_error"] < 1e-9


def test_whitening_without_variance(spark):
    assert whitening.whiten(vectors_of(spark, [])).collect() == []
    assert whitening.whiten(vectors_of(spark, [None, [], [float("nan")]])).collect() == []
    assert whitening.whiten(vectors_of(spark, [[1.0, 2.0]] * 3)).collect() == []
    flat = whitening.whiten(vectors_of(spark, [[1.0, 2.0], [1.0, 3.0], [1.0, 5.0]])).collect()
    assert {x["component"] for x in flat} == {1} and abs(flat[0]["explained"] - 1) < 1e-12
    assert abs(sum(x["whitened"] ** 2 for x in flat) / 3 - 1) < 1e-9


def test_deviations_are_exact():
    x = np.array([[2**40, -(2**40)], [0, 1]], np.int64)
    far, centred = whitening.deviations(x, 2, [2**40, 1 - 2**40])
    assert far == [2**80 + (2**40 + 1) ** 2, 2**80 + (2**40 + 1) ** 2]
    huge, _ = whitening.deviations(np.array([[2**62, 0], [-(2**62), 0]], np.int64), 2, [0, 0])
    assert huge == [2**126, 2**126] and np.isfinite(centred).all()


def test_huge_entries(spark):
    rows = whitening.whiten(vectors_of(spark, [[1e38, 0.0], [-1e38, 1.0], [0.0, 2.0]])).collect()
    assert rows and all(x["deviation"] is None or x["deviation"] > 0 for x in rows)


def test_docs_with_clashing_columns(spark):
    assert collocations.collocations(docs_of(spark, ["one two"] * 31)).collect()[0]["phrase"] == "one two"
