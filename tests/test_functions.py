import hashlib
import math

import pytest
from pyspark.sql import functions as F

from textloom.functions import text as tx
from textloom.functions.normalize import normalize, normalize_term, term_form
from textloom.functions.words import de_stem, entity_keys, mark_entities, replace_terms, stop_stems
from textloom.operators.opinions import buzz_value


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("value, expected", [("", [""]), (" ", []), (" a b ", ["", "a", "b"]), ("a  b", ["a", "", "b"])])
def test_space_split(spark, value, expected):
    assert one(spark, value, tx.space_split) == expected


def test_tokens(spark):
    assert one(spark, "Was, «ist»\r\nlos?!", tx.word_tokens) == ["Was", "«ist»", "los"]


# Amounts as written and as normalised.
AMOUNTS = {
    "Fr. 100000": "100000 Franken",
    "700'000.--.": "700000 Franken.",
    "20000CHF": "20000 Franken",
    "CHF 15'000.00 ": "15000%2C00 Franken ",
    "25 000 Fr ": "25000 Franken ",
    "EUR 100'000": "100000 Euro",
    "1,77": "1%2C77",
    "1`300 000`000.00$ Dollar": "1300000000%2C00 Dollar",
    "30-70'000": "30-70000",
    "12'000.-- Franken": "12000 Franken",
    "Fr. 250'000.-": "250000 Franken",
    "damit fast 200'000.- im Jahr": "damit fast 200000 Franken im Jahr",
    "8 Fr.": "8 Fr.",
}


def test_amounts(spark):
    rows = spark.createDataFrame(list(AMOUNTS.items()), "x string, y string")
    for r in rows.select("x", "y", tx.process_numbers(F.col("x")).alias("got")).collect():
        assert r["got"] == r["y"], r


def test_ngram_terms(spark):
    got = one(spark, "Hello Lorenz, how are you?", lambda c: tx.multi_terms(c, 2))
    assert len(set(got)) == 9 and "are you" in got
    assert len(set(one(spark, "holy moly this is fun", lambda c: tx.multi_terms(c, 4)))) == 14
    assert len(set(one(spark, "holy moly. this is fun!!!", lambda c: tx.multi_terms(c, 3)))) == 12
    assert one(spark, "word", lambda c: tx.multi_terms(c, 4)) == ["word"] * 4
    assert one(spark, " ", lambda c: tx.multi_terms(c, 3)) == []
    assert one(spark, "a b", lambda c: tx.multi_terms(c, 1)) == ["a", "b"]


def test_letter_words(spark):
    assert one(spark, "Der foo-bar ist don't GRÜN, 12 ab Haus.", tx.letter_words) == ["der", "ist", "grün", "haus"]


def test_wiki(spark):
    assert one(spark, "#REDIRECT [[x]]", tx.clean_wiki) == ""
    assert one(spark, "{{Infobox x", tx.clean_wiki) == ""
    assert one(spark, "[[Bern]] und [[a|b]]  <!-- c -->x", tx.clean_wiki) == "Bern und b x"


def test_normalize():
    assert normalize("ÀÁÂÃĀĂȦÄẢÅǍȀȂĄẠḀẦẤàáâä") == "a" * 22
    assert normalize("ÌÍÏïØøÒÖÔöÜüŇñÇçß") == "iiiioooooouunnccss"
    for value, expected in (("aa'sbba", "aabba"), ("aa&& & &&& bb", "aa-bb"), ("aa((((bb)))cc", "aa-bb-cc"), ("a----a--b-b-------a", "a-a-b-b-a"), ("a'sa((%%$ & b___--BB a", "aa-b-bb-a")):
        assert normalize(value) == expected


def test_stems(spark):
    stems = {"Lustigen": "lustig", "äffchen": "affch", "": "", "Matrizen": "matrix", "Lehrerinnen": "lehreri", "Strasse": "strass", "Häuser": "hau", "gegessen": "gess", "welt": "wel", "Menschen": "mensch", "«Pegida»": " pegida"}
    assert {w: normalize_term(w) for w in stems} == stems
    assert one(spark, "«Pegida»", term_form) == "pegida"
    assert one(spark, "«Pegida»", lambda c: term_form(c, strict=True)) == " pegida"
    assert "" not in stop_stems() and "und" in stop_stems()


def test_entities(spark):
    assert one(spark, "hello mr. sepp blatter", lambda c: mark_entities(term_form(c))) == "hello mr sepp_blatt"
    assert one(spark, "hello mr. Johann_Schneider-Ammann was", lambda c: mark_entities(term_form(c))) == "hello mr johann_schneid_ammann was"
    assert "sepp_blatt" in entity_keys()
    assert one(spark, "US", replace_terms) == "USA"
    assert one(spark, "a_b", lambda c: de_stem(c, F.create_map(F.lit("a"), F.lit("Aa")))) == "Aa b"


def test_entities_of_whole_texts(spark, tmp_path):
    from textloom.queries import QUERIES

    long = "und so weiter " * 6_000
    texts = [None, "", "nichts", "sepp blatter", "x" * 75 + " sepp blatter war da", long + "in St. Gallen und New York, New York", f"Roger Federer {long}Johann Schneider-Ammann {long}Los-Ängeles", "x" * 70_000 + " st moritz new st gallen"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))

    def brute(text):
        words, out, i = normalize_term(text).strip(" ").split(" "), [], 0
        while i < len(words):
            k = next((k for k in (3, 2) if "_".join(words[i : i + k]) in entity_keys() and i + k <= len(words)), 1)
            out.append("_".join(words[i : i + k]))
            i += k
        return sum("_" in w for w in out), hashlib.md5(" ".join(w for w in out if w).encode()).hexdigest()

    got = {r["doc_id"]: (r["n_marked"], r["digest"]) for r in QUERIES["entities_marked"](spark, str(tmp_path)).collect()}
    assert got == {i: brute(t) if t is not None else (None, None) for i, t in enumerate(texts)}
    assert [got[i][0] for i in range(3, 8)] == [1, 1, 3, 3, 2]


@pytest.mark.parametrize("hours, up, down, low, high", [(24, 1, None, 4, 5), (24, None, None, 3, 4), (24, 1_981_298_120, None, 3, 99), (31 * 24, 5, 5, 0, 0), (-5, 1, 1, 0, 0), (0, None, None, 6.5, 6.6)])
def test_buzz(spark, hours, up, down, low, high):
    rows = spark.createDataFrame([(up, down)], "up int, down int")
    now = F.lit("2015-06-15 12:00:00").cast("timestamp")
    value = buzz_value(now - F.make_dt_interval(F.lit(0), F.lit(hours)), F.col("up"), F.col("down"), now)
    assert low <= rows.select(value.alias("v")).first()["v"] <= high


def test_strict_buzz(spark):
    now = F.lit("2015-06-15 12:00:00").cast("timestamp")
    rows = spark.range(1).select(buzz_value(now, F.lit(1), F.lit(1), now, strict=True).alias("a"), buzz_value(now + F.make_dt_interval(F.lit(1)), F.lit(1), F.lit(1), now, strict=True).alias("b")).first()
    assert rows["a"] == math.inf and math.isnan(rows["b"])
