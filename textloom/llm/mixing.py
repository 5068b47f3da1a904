"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws the key -ln(u) / w from a hash of its id (u) and its quality weight (w).
Sorted by key within its source and summed up to what the complete epochs leave of the
source's target, the documents so reached are taken once more. Targets share 150 % of all
sizes by weight; none exceeds twice its source's size, the excess goes to the others by weight.

Prefix sums run in two levels (key ranges of a source, rows of a range), so that a source
that holds a third of all rows is not sorted in one task. The plan has a row for each source;
its few sums run in one task, which some millions of sources are no burden for.

Defined results: null text has size 0; texts of any length are counted whole; a null source is
one source, last in order; documents of size 0 take 0 words; ties of the key go by doc_id, then
by size; repeated rows have equal keys and are taken in any order among themselves; an empty
table gives no rows; other columns, whatever their names, are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, n_of, words

#: Weights by the rank of the source, repeating; the share of all sizes; the most epochs.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2.0
#: Above this many sources the plan is joined by shuffle, not broadcast (about 1 MB).
BROADCAST_SOURCES = 10_000
#: Rows of a key range, about, some four times as many at most; a range is what one task sorts.
RANGE_ROWS = 4096
#: Quality weights by which key ranges are laid out; the lowest and the highest are among them.
RANGE_WEIGHTS = (1.0, 0.5, 0.25)


def quality_weight(text: Column, size: Column) -> Column:
    """1 for plain prose, down to 0.25 for texts full of symbols."""
    per_word = n_of(text, "#*$%&|<>").cast("double") / F.greatest(size, F.lit(1)).cast("double")
    return F.greatest(F.lit(0.25), F.lit(1.0) / (F.lit(1.0) + per_word))


def sampling_key(doc_id: Column, weight: Column, seed: int = 7) -> Column:
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 12), 16, 10).cast("double")
    return -F.log((h + 1.0) / F.lit(float(2**48))) / weight


def plan_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Per source: source_size, n_docs, target. Water-filling: sources in order of cap / weight fill up first."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = (F.row_number().over(order) - 1) % len(weights)
    ranked = by_source.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(most))
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    everything = Window.partitionBy()
    filled = (
        ranked.withColumn("capped", F.coalesce(F.sum("cap").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open_weight", F.sum("weight").over(before.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("level", (F.col("total") - F.col("capped")) / F.col("open_weight"))
    )
    # the first source in that order whose cap is not reached sets the level for all
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(everything)["level"]
    return filled.withColumn("target", F.least(F.col("cap"), F.coalesce(level * F.col("weight"), F.col("cap")))).select(
        "source", "source_size", "n_docs", "target"
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7, also: tuple[str, ...] = ()) -> DataFrame:
    """One row for each document: doc_id, size, source_size, target, taken, source and the columns also."""
    size = F.size(words(F.col(text_col))).cast("long")
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"), F.col(text_col).alias("_t"), *also)
    sized = sized.select("doc_id", "source", "size", sampling_key(F.col("doc_id"), quality_weight(F.col("_t"), F.col("size")), seed).alias("key"), *also)
    sized = materialize(sized, "mix-sizes")
    plan = materialize(plan_targets(sized), "mix-plan")
    few = plan.count() <= BROADCAST_SOURCES
    p = plan.withColumnRenamed("source", "_s")
    both = sized.join(F.broadcast(p) if few else p, F.col("source").eqNullSafe(F.col("_s")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    n_ranges = F.ceil(F.col("n_docs") / F.lit(float(RANGE_ROWS)))
    # the share of keys below this one, were the weights an even mix of those
    below = F.lit(1.0) - sum((F.exp(-F.col("key") * F.lit(w)) for w in RANGE_WEIGHTS), F.lit(0.0)) / F.lit(float(len(RANGE_WEIGHTS)))
    both = both.select(
        "doc_id", "source", "size", "source_size", "target", "key", epochs.alias("epochs"),
        (F.col("target") - epochs * F.col("source_size")).alias("rest"),
        F.greatest(F.lit(0), F.least(F.floor(below * n_ranges), n_ranges - 1)).cast("long").alias("range"),
        *also,
    )
    ranges = both.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    ahead = F.sum("range_size").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.select(F.col("source").alias("_s"), F.col("range").alias("_r"), F.coalesce(ahead, F.lit(0)).alias("ahead"))
    within = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    mine = both.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    reached = mine.join(ranges, F.col("source").eqNullSafe(F.col("_s")) & (F.col("range") == F.col("_r")))
    start = F.col("ahead") + F.col("before")
    # a document whose larger half lies inside the rest is taken whole
    again = (F.lit(2) * start + F.col("size")).cast("double") <= F.lit(2.0) * F.col("rest")
    taken = F.col("size") * (F.col("epochs") + F.when(again & (F.col("epochs") < 2), F.lit(1)).otherwise(F.lit(0)))
    return reached.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "source", *also)
