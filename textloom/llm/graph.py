"""Connected components of an edge list, distributed (alternating large and small stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, root for every node of edges (a, b); root is the smallest node of its component.

    Nulls and loops are ignored; repeated edges count once; no edges give no rows. Raises
    RuntimeError where the stars have not settled after so many rounds.
    """
    edges = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).filter(F.col("u") != F.col("v"))
    edges = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "stars")
    mark = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = mark(edges)
    for _ in range(rounds):
        if not before[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter(F.col("u") != F.col("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        small = small.select("e.u", "e.v").filter(F.col("u") != F.col("v")).distinct()
        old, edges = edges, materialize(small, "stars", 2 * before[0])
        discard(old)
        after = mark(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components have not settled after {rounds} rounds")
    pairs = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    out = materialize(pairs.unionByName(roots), "roots", 2 * before[0])
    discard(edges)
    return out
