r"""Chat formatting with a grammar round trip.

A turn is rendered as ``### role:\n`` + text + ``\n</turn>\n``. The control strings are
``### `` and ``</turn>``. A conversation is first rendered as it is and parsed again; where
the parser does not give back the same turns, the texts are escaped (each control string and
the backslashes before it get one backslash more, which the parser takes away; texts without any
stay as they are) and the result is parsed again and compared too: a conversation that did not come
back would be an error. The parser always unescapes, so that it is one grammar for both.

Defined results: null text and null role are empty; turns go by ``turn``, ties by role and
text; texts of any length and any number of turns are one conversation and one row, so one
task's; repeated rows are repeated turns; a null conv_id is one conversation; an empty table
gives no rows; other columns, whatever their names, are left alone. All of it is Spark SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

CONTROL = r"(### |</turn>)"
TURN_END = "</turn>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"(\\*)" + CONTROL, r"\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\*)" + CONTROL, r"$1$2")


#: Characters of a role that would end its header or start a control string, and their names.
ROLE_NAMES = (("\\", "\\b"), ("\n", "\\n"), ("#", "\\h"), ("<", "\\l"))


def _role_out(role: Column) -> Column:
    for char, name in ROLE_NAMES:
        role = F.replace(role, F.lit(char), F.lit(name))
    return role


def _role_in(role: Column) -> Column:
    for char, name in reversed(ROLE_NAMES):
        role = F.replace(role, F.lit(name), F.lit(char))
    return role


def render(turns: Column, escaped: bool) -> Column:
    """Turns (array of role, text) as one string."""
    body = (lambda t: escape(t)) if escaped else (lambda t: t)
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit("### "), _role_out(t["role"]), F.lit(":\n"), body(t["text"]), F.lit("\n" + TURN_END))), "")


HEADER = r"(?s)\A### ([^\n]*):\n(.*)\n\z"


def pieces(formatted: Column) -> Column:
    """Whole turns as rendered, without their end marks."""
    return F.filter(F.split(formatted, r"(?<!\\)</turn>\n"), lambda x: x != "")


def parse(formatted: Column) -> Column:
    """The turns read back from a rendered string: array of role, text, start and end of the raw text."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<role:string,text:string,start:bigint,end:bigint>>").alias("turns"))

    def step(a: Column, piece: Column) -> Column:
        raw = F.regexp_extract(piece, HEADER, 2)
        return let(
            F.struct(F.regexp_extract(piece, HEADER, 1).alias("role"), raw.alias("raw")),
            lambda p: let(
                (a["at"] + F.length(piece) - F.length(p["raw"]) - 1).cast("long"),
                lambda s: F.struct(
                    (a["at"] + F.length(piece) + len(TURN_END)).cast("long").alias("at"),
                    F.concat(
                        a["turns"],
                        F.array(F.struct(_role_in(p["role"]).alias("role"), unescape(p["raw"]).alias("text"), s.alias("start"), (s + F.length(p["raw"])).cast("long").alias("end"))),
                    ).alias("turns"),
                ),
            ),
        )

    return F.aggregate(pieces(formatted), start, step, lambda a: a["turns"])


def _same(parsed: Column, turns: Column) -> Column:
    return F.transform(parsed, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))) == turns


def format_chats(conversations: DataFrame, learn_role: str = "assistant") -> DataFrame:
    """conv_id, turns, formatted, rounds (0: as it is, 1: escaped) and loss_mask (spans of learn_role's texts in formatted)."""
    rows = conversations.select(
        "conv_id", F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t")
    )
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    chats = chats.select("conv_id", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    plain = render(F.col("turns"), escaped=False)
    chats = chats.select("conv_id", "turns", plain.alias("plain"))
    fits = let(F.struct(F.col("plain").alias("f"), F.col("turns").alias("t")), lambda x: _same(parse(x["f"]), x["t"]))
    chats = chats.select("conv_id", "turns", "plain", fits.alias("fits"))
    chats = chats.select(
        "conv_id", "turns", F.when(F.col("fits"), F.col("plain")).otherwise(render(F.col("turns"), escaped=True)).alias("formatted"),
        F.when(F.col("fits"), 0).otherwise(1).alias("rounds"),
    )
    # read once for the mask and, where it was escaped, for the comparison
    chats = chats.select("*", parse(F.col("formatted")).alias("back"))
    exact = F.when((F.col("rounds") == 0) | _same(F.col("back"), F.col("turns")), F.col("formatted"))
    checked = exact.otherwise(F.raise_error(F.concat(F.lit("a conversation does not come back from its escaped form: "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))))
    mask = F.transform(F.filter("back", lambda t: t["role"] == learn_role), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end")))
    return chats.select("conv_id", "turns", checked.alias("formatted"), "rounds", mask.alias("loss_mask"))


def read_back(chats: DataFrame) -> DataFrame:
    """Digests of the turns and of the text under the loss mask, from formatted and loss_mask alone."""
    back = chats.select("conv_id", "formatted", parse(F.col("formatted")).alias("back"), "loss_mask")
    lines = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join(F.transform("loss_mask", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
    back = back.select("conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"), learnt.alias("_loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    return back.select("conv_id", "n_turns", "turns_sha256", F.length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"), "formatted_chars")
