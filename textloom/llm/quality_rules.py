"""Quality rules: a ledger of failure bits that versioned policies read.

Every rule is evaluated once for each document. The ledger keeps the measurements and one
long whose bit i says that rule i failed. A policy is a mask of bits, so applying another
policy version or an ablation never touches the text again.

Defined results: null and empty texts count no words and fail ``few_words``; texts of any
length are measured whole; a rule fails beyond its limit, not at it; repeated rows are judged
one by one and alike; an empty table gives an empty ledger; other columns of the input, whatever
their names, are left alone (only ``id_col`` and ``text_col`` are read).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, let, n_of, words

SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_exclaim")

#: Rules by bit: name and SQL condition of failure over the measurements. Only append.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "100 * n_symbols > 40 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("upper_case", "100 * n_upper > 60 * word_chars"),
    ("exclamation", "100 * n_exclaim > 60 * n_words"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_words"]
#: Versioned policies: the bits that reject a document.
POLICIES = {"base": BASE, "v1": BASE | BIT["symbols"] | BIT["repeated_lines"] | BIT["short_words"] | BIT["long_words"] | BIT["upper_case"] | BIT["exclamation"]}


def _repeat_words(hashes: Column) -> Column:
    """Words in 3-word windows that occur twice or more, from the words' hashes."""

    def windows(h):
        return F.when(
            F.size(h) >= 3,
            F.transform(F.sequence(F.lit(0), F.size(h) - 3), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2))),
        ).otherwise(F.array().cast("array<bigint>"))

    def covered(places):
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(
            places, start, lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).cast("long").alias("n"), p.alias("last")), lambda a: a["n"]
        )

    def places(s):
        twice = F.filter(
            s, lambda x, j: (F.get(s, j - 1)["k"].eqNullSafe(x["k"])) | (F.get(s, j + 1)["k"].eqNullSafe(x["k"]))
        )
        return F.sort_array(F.transform(twice, lambda x: x["p"]))

    def of(k):
        marked = F.sort_array(F.transform(k, lambda x, p: F.struct(x.alias("k"), p.alias("p"))))
        return F.when(F.size(F.array_distinct(k)) == F.size(k), F.lit(0).cast("long")).otherwise(covered(let(marked, places)))

    return let(hashes, lambda h: let(windows(h), of))


def measure(text: Column) -> Column:
    """All measurements of a text as one struct of longs."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    by_word = let(
        words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            _repeat_words(F.transform(w, lambda x: F.xxhash64(x))).alias("n_repeat_words"),
        ),
    )
    by_line = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return F.struct(
        by_word.alias("w"),
        by_line.alias("l"),
        F.length(F.translate(text, WHITE, "")).cast("long").alias("word_chars"),
        n_of(text, SYMBOLS).alias("n_symbols"),
        n_of(text, UPPER).alias("n_upper"),
        n_of(text, "!").alias("n_exclaim"),
    )


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for each document: id, measurements and ``bits``; ``keep`` names further columns to carry."""
    m = docs.select(F.col(id_col), *[F.col(c) for c in keep], measure(F.col(text_col)).alias("_m"))
    flat = m.select(
        id_col, *keep,
        F.col("_m.w.n_words").alias("n_words"), F.col("_m.word_chars").alias("word_chars"), F.col("_m.n_symbols").alias("n_symbols"),
        F.col("_m.l.n_lines").alias("n_lines"), F.col("_m.l.n_dup_lines").alias("n_dup_lines"), F.col("_m.w.n_repeat_words").alias("n_repeat_words"),
        F.col("_m.n_upper").alias("n_upper"), F.col("_m.n_exclaim").alias("n_exclaim"),
    )
    bits = F.lit(0).cast("long")
    for i, (_, fails) in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return flat.withColumn("bits", bits)


def rejects(policy: str, bits: Column | None = None) -> Column:
    """Whether the policy of that version rejects a row of the ledger."""
    return (F.col("bits") if bits is None else bits).bitwiseAND(F.lit(POLICIES[policy]).cast("long")) != 0


def ablations(led: DataFrame, policy: str = "v1") -> DataFrame:
    """For each rule of a policy: documents it fails, and those that only it rejects (kept without it)."""
    mask = POLICIES[policy]
    seen = led.groupBy(F.col("bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits")).agg(F.count("*").alias("n"))
    inside = [(name, i) for i, (name, _) in enumerate(RULES) if mask >> i & 1]
    rules = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for n, i in inside]))
    return (
        seen.select("bits", "n", rules.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.coalesce(F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n"))), F.lit(0)).alias("failed"),
            F.coalesce(F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n"))), F.lit(0)).alias("failed_alone"),
        )
    )


def filter_documents(docs: DataFrame, policy: str = "v1", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that the policy keeps, with their own columns."""
    names = docs.columns
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    led = ledger(row, "_id", "_text", keep=("_row",))
    return led.filter(~rejects(policy)).select(*[F.col("_row").getField(c).alias(c) for c in names])
