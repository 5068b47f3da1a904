import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.llm import graph, ngram_join, suffix_dedup

from .helpers import ODD, docs_of, edited, prose


def shingles(t):
    w = (t or "").encode().lower().split()
    return set() if not w else {tuple(w)} if len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute_components(texts):
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in range(len(texts))}


def corpus():
    r = random.Random(5)
    passage = prose(60, 99)
    texts = list(ODD)
    for seed in range(12):
        base = prose(r.choice([3, 6, 12, 30, 80, 300, 900]), seed)
        texts.append(base)
        for k in range(r.choice([1, 2, 6])):
            texts.append(edited(base, r.choice([0, 0.01, 0.025, 0.04, 0.06]), 100 * seed + k))
    hot = prose(150, 77)
    texts += [edited(hot, r.choice([0.01, 0.02, 0.03, 0.05]), 5000 + k) for k in range(60)]
    texts += [f"{passage} {prose(r.choice([20, 40, 200]), 300 + k)}" for k in range(40)]
    # sizes at the edge of the threshold: 7 of 9 shingles, 6 of 8, 3 of 4
    for n in (4, 8, 9, 16, 25):
        base = prose(n + 4, 900 + n).split(" ")
        texts += [" ".join(base), " ".join(base[:-1]), " ".join(base[:-2]), " ".join([*base, "z"]), " ".join(["y", *base[1:]])]
    return texts


def test_ngram_join_against_brute_force(spark):
    texts = corpus()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.link_components(docs_of(spark, texts)).collect()}
    assert got == brute_components(texts)


def test_all_links(spark):
    """Every link between different sets, also those inside a component."""
    texts = corpus()
    sets = {}
    for i, t in enumerate(texts):
        if shingles(t):
            sets.setdefault(frozenset(shingles(t)), []).append(i)
    every = list(sets)
    expected = {frozenset((sets[a][0], sets[b][0])) for k, a in enumerate(every) for b in every[:k] if 100 * len(a & b) >= 75 * len(a | b)}
    links, members = ngram_join.link_pairs(docs_of(spark, texts))
    least = {}
    for r in members.collect():
        if r["node"] is not None:
            least[r["node"]] = min(r["doc_id"], least.get(r["node"], r["doc_id"]))
    got = [frozenset((least[r["a"]], least[r["b"]])) for r in links.collect()]
    assert len(got) == len(set(got)) and set(got) == expected and len(expected) > 300


def test_null_ids(spark):
    """Documents without an id still link others and repeat their bytes; a component of such alone has no id."""
    base, other = prose(120, 1), prose(120, 2)
    docs = docs_of(spark, [base, edited(base, 0.02, 1), edited(base, 0.02, 2), other, edited(other, 0.01, 3)]).replace({3: 99, 4: 99}, subset=["doc_id"])
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id").isin(0, 99), None).otherwise(F.col("doc_id")))
    got = sorted(((r["doc_id"], r["component_id"]) for r in ngram_join.link_components(docs).collect()), key=str)
    assert got == [(1, 1), (2, 1), (None, 1), (None, None), (None, None)]
    rows = suffix_dedup.remove_repeats(docs).collect()
    assert len(rows) == 5 and sum(r["n_removed"] for r in rows) == sum(r[1] for r in brute_removal([r["text"] for r in docs.collect()]).values())


def test_ngram_join_of_nothing(spark):
    assert ngram_join.link_components(docs_of(spark, [])).collect() == []
    assert [r["component_id"] for r in ngram_join.link_components(docs_of(spark, [None, "", None])).orderBy("doc_id").collect()] == [0, 1, 2]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 60), st.integers(0, 14), st.integers(0, 14), st.integers(0, 2**32))
def test_linked_sets_share_a_signature(n, only_a, only_b, seed):
    r = np.random.default_rng(seed)
    pool = np.unique(r.integers(1, 2**63, n + only_a + only_b, dtype=np.uint64))
    a, b = pool[: n + only_a], np.concatenate([pool[:n], pool[n + only_a :]])
    a, b = np.unique(a), np.unique(b)
    if not ngram_join.linked(a, b):
        return
    common = set(ngram_join.schemes_of(len(a))) & set(ngram_join.schemes_of(len(b)))
    assert common
    for k in range(len(ngram_join.ALLOCATIONS)):
        shared = 0
        for scheme in common:
            two = dict(ngram_join.emitted(b, scheme, k))
            shared += sum(len(np.intersect1d(x, two[tag])) for tag, x in ngram_join.emitted(a, scheme, k) if tag in two)
        assert shared
    for scheme in ngram_join.schemes_of(len(a)):
        for k in range(len(ngram_join.ALLOCATIONS)):
            spare, cost = ngram_join.accounts(a, scheme)[2 * k : 2 * k + 2]
            made = ngram_join.emitted(a, scheme, k)
            assert cost == sum(len(x) for _, x in made) and (len(made) > 1) == (spare < 0)
    assert ngram_join.least_difference(ngram_join.sketch(a), ngram_join.sketch(b)) <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("total", range(2, 200))
def test_most_difference(total):
    best = max(t - 2 * i for t in range(max(2, total - 7), total + 1) for i in range(t // 2 + 1) if 7 * i >= 3 * t)
    assert ngram_join.most_difference(total) == best


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(250)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(1, 40)] + [(7, 7)]
    near = defaultdict(set)
    for a, b in edges:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    expected, seen = {}, set()
    for a in sorted(near):
        if a not in seen:
            todo, part = [a], set()
            while todo:
                x = todo.pop()
                if x not in part:
                    part.add(x)
                    todo += near[x]
            seen |= part
            expected |= dict.fromkeys(part, min(part))
    assert {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()} == expected
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_removal(texts, keep="none", length=200):
    data = [(t or "").encode() for t in texts]
    where = defaultdict(list)
    for i, b in enumerate(data):
        for p in range(len(b) - length + 1):
            where[b[p : p + length]].append((i, p))
    out = {}
    for i, b in enumerate(data):
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            at = where[b[p : p + length]]
            if len(at) > 1 and (keep == "none" or at[0] != (i, p)):
                gone[p : p + length] = b"\1" * length
        left = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and (not k or not gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(left).hexdigest())
    return out


def repeats():
    passage, line = prose(60, 1), "Licensed under the plain licence, version two, without any warranty. " * 4
    texts = [None, "", "short", "short", "é" * 150, "é" * 149 + "x", "x" * 199, "x" * 400, "ab" * 300]
    texts += [f"{prose(30, 10 + k)} {passage} {prose(20, 50 + k)}" for k in range(6)]
    texts += [prose(100, 70), prose(100, 70), edited(prose(100, 70), 0.03, 4), f"{line}{prose(10, 80)}{line}", line[:200], line[1:201], prose(80, 90)]
    texts += [passage[:200], passage[:199], "ä" + passage[:260], passage[40:300] + " " + passage[:230]]
    frequent = prose(45, 123)
    texts += [f"{prose(15, 600 + k)} {frequent} {prose(15, 700 + k // 2)}" for k in range(12)]
    return texts


@pytest.mark.parametrize("keep", ["none", "first"])
def test_suffix_dedup_against_brute_force(spark, keep):
    texts = repeats()
    got = suffix_dedup.remove_repeats(docs_of(spark, texts), keep=keep).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == brute_removal(texts, keep)
    for r in got:
        assert len(r["spans"]) == r["n_spans"] and sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]


def test_suffix_dedup_of_nothing(spark):
    assert suffix_dedup.remove_repeats(docs_of(spark, [])).collect() == []
    assert all(r["n_removed"] == 0 for r in suffix_dedup.remove_repeats(docs_of(spark, [None, "", "a", prose(100, 3)])).collect())
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(docs_of(spark, []), keep="last")


def test_suffix_order_and_factors():
    r = random.Random(2)
    for data in (bytes(r.choice(b"ab") for _ in range(400)) * 2 + bytes(100), b"x" * 700, bytes(r.randrange(256) for _ in range(600)), b"abc" * 250):
        data = np.frombuffer(data, np.uint8)
        starts = np.arange(0, len(data) - 200 + 1, 1 + len(data) % 2)
        order, common = suffix_dedup.suffix_order(data, starts)
        windows = [data[s : s + 200].tobytes() for s in starts[order]]
        assert [(w, s) for w, s in zip(windows, starts[order])] == sorted((data[s : s + 200].tobytes(), s) for s in starts)
        prefix = lambda a, b: next((k for k in range(200) if a[k] != b[k]), 200)
        assert common.tolist() == [0] + [prefix(a, b) for a, b in zip(windows, windows[1:])]
        for least in (1, 40, 200):
            factor, source = suffix_dedup.previous_factors(starts[order], common, least)
            by_place = sorted(zip(starts[order].tolist(), range(len(order))))
            for n, (_, k) in enumerate(by_place[:: 1 + len(by_place) // 150]):
                earlier = [j for s, j in by_place if s < starts[order][k]]
                best = max([prefix(windows[k], windows[j]) for j in earlier], default=0)
                assert factor[k] == (best if best >= least else 0)
                assert not factor[k] or (starts[order][source[k]] < starts[order][k] and prefix(windows[k], windows[source[k]]) == best)


def test_suffix_dedup_of_repeated_ids(spark):
    """Texts that share an id are told apart; of equal texts those with the least id stay, others go."""
    passage = prose(60, 1)
    docs = docs_of(spark, [f"{passage} {prose(30, 5)}", f"{prose(30, 6)} {passage}", f"{passage} {prose(30, 5)}", f"{passage} {prose(30, 5)}"])
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") < 3, F.lit(7)).otherwise(F.lit(9)).cast("long"))
    rows = suffix_dedup.remove_repeats(docs, keep="first").collect()
    long_one, other = len(f"{passage} {prose(30, 5)}"), len(f"{prose(30, 6)} {passage}")
    removed = sorted((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in rows)
    assert (9, long_one, long_one) in removed and sum(x[2] == 0 for x in removed) in (1, 2)
    # the passage stays once: in the copies of id 7 or in the other text
    assert {x[2] >= len(passage) for x in removed if x[:2] == (7, long_one)} != {x[2] >= len(passage) for x in removed if x[:2] == (7, other)}
