"""Text functions as Catalyst expressions. No Python runs on rows here."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _strings() -> Column:
    return F.array().cast("array<string>")


def once(value: Column, body) -> Column:  # noqa: ANN001
    """body(value), value computed once for a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def space_split(text: Column) -> Column:
    """Split at single blanks; empty strings stay at the front and inside, not at the end; '' gives ['']."""
    bare = F.rtrim(text)
    return F.when(text == "", F.array(F.lit(""))).when(bare == "", _strings()).otherwise(F.split(bare, " "))


def remove_linebreaks(text: Column) -> Column:
    """Line ends become blanks, runs of white space one blank."""
    return F.regexp_replace(F.regexp_replace(text, r"[\r\n\x{85}\x{2028}\x{2029}]+", " "), r"\s+", " ")


def strip_punctuation(text: Column) -> Column:
    """Runs of ASCII punctuation become one blank."""
    return F.regexp_replace(text, r"\p{Punct}+", " ")


#: What punctuation, line ends and white space leave as one blank.
SEPARATORS = r"[\p{Punct}\s\x{85}\x{2028}\x{2029}]+"


def word_tokens(text: Column) -> Column:
    """space_split(remove_linebreaks(strip_punctuation(text))) in one pass: an empty string stays at the front only."""

    def ends(p: Column) -> Column:
        n = F.size(p)
        inner = F.when((n == 2) & (F.get(p, F.lit(0)) == ""), _strings()).otherwise(F.slice(p, 1, n - 1))
        return F.when((n == 1) | (F.get(p, n - 1) != ""), p).otherwise(inner)

    return once(F.split(text, SEPARATORS), ends)


# The money patterns in the order in which they are tried. A number is
# [0-9]+,?[0-9]+ (so at least two digits); each pattern must cover the whole text.
NUMBER = r"([0-9]+\,?[0-9]+)"
MONEY = (
    (rf"(.*?){NUMBER}\s?Fr\s(.*)", "$1$2 Franken$3 "),
    (rf"(.*?){NUMBER}\s?CHF(.*)", "$1$2 Franken$3"),
    (rf"(.*?){NUMBER}\s?Chf(.*)", "$1$2 Franken$3"),
    (rf"(.*?){NUMBER}\s?chf(.*)", "$1$2 Franken$3"),
    (rf"(.*?)CHF {NUMBER}\s?\.-+(.*)", "$1$2 Franken$3"),
    (rf"(.*?)CHF {NUMBER}(.*)", "$1$2 Franken$3"),
    (rf"(.*?)EUR {NUMBER}(.*)", "$1$2 Euro$3"),
    (rf"(.*?)Fr\. {NUMBER}\s?\.-+(.*)", "$1$2 Franken$3"),
    (rf"(.*?)Fr\. {NUMBER}\s?(.*)", "$1$2 Franken$3"),
    (rf"(.*?){NUMBER}\s?\.-+ Franken(.*)", "$1$2 Franken$3"),
    (rf"(.*?){NUMBER}\s?\.-+(.*)", "$1$2 Franken$3"),
    (rf"(.*?){NUMBER}\s?Fr\.(.*)", "$1$2 Franken$3"),
)
# What a text must hold to match each of them: looking for it is cheaper than trying the pattern.
MONEY_MARKS = ("Fr", "CHF", "Chf", "chf", "CHF ", "CHF ", "EUR ", "Fr. ", "Fr. ", " Franken", ".-", "Fr.")
# What is replaced before and after.
BEFORE_MONEY = ((r"\$ Dollar", " Dollar"), (r"([0-9]+)\.([0-9][0-9])\s", "$1,$2 "), (r"([0-9])[`'\.]([0-9])", "$1$2"), (r"([0-9]+)\s([0-9]+)", "$1$2"))
AFTER_MONEY = ((r"([0-9])[\,]([0-9])", "$1%2C$2"),)


def process_numbers(text: Column) -> Column:
    """Numbers in one form and one amount of money per text with its currency behind it. Texts without a digit or a dollar stay as they are."""
    given = text
    for pattern, new in BEFORE_MONEY:
        text = F.regexp_replace(text, pattern, new)

    def amount(t: Column) -> Column:
        out = F.when(F.lit(False), t)
        for (pattern, new), mark in zip(MONEY, MONEY_MARKS):
            whole = rf"\A(?:{pattern})\z"
            out = out.when(t.contains(mark) & t.rlike(whole), F.regexp_replace(t, whole, new))
        return out.otherwise(t)

    text = once(text, amount)
    for pattern, new in AFTER_MONEY:
        text = F.regexp_replace(text, pattern, new)
    return F.when(given.rlike("[0-9$]"), text).otherwise(given)


def single_terms(text: Column) -> Column:
    """Terms of one word, amounts of money normalised first."""
    return word_tokens(process_numbers(text))


def ngrams(words: Column, n: int) -> Column:
    """Sliding runs of n words; a text of fewer words is one run, an empty one none."""
    return once(
        words,
        lambda w: F.when(F.size(w) == 0, _strings())
        .when(F.size(w) < n, F.array(F.array_join(w, " ")))
        .otherwise(F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.array_join(F.slice(w, i + 1, n), " "))),
    )


def multi_terms(text: Column, longest: int) -> Column:
    """Terms of one to longest words, by length and then in order."""
    words = word_tokens(text)
    return once(words, lambda w: F.concat(w, *[ngrams(w, n) for n in range(2, longest + 1)]))


def letter_words(text: Column, least: int = 3) -> Column:
    """Lower-cased words of letters only, by the JDK's word boundaries; stop words are anti-joined later."""
    found = F.transform(F.flatten(F.sentences(text)), lambda w: F.lower(w))
    return F.filter(found, lambda w: w.rlike(rf"^\p{{L}}{{{least},}}$"))


# What marks redirects and info boxes, and the mark-up that is rewritten, in order.
DROPPED_PAGES = ("#WEITERLEITUNG", "#REDIRECT", "{{Infobox", "{{Information")
WIKI_MARKUP = (
    (r"\[\[([^\|]*?)\]\]", "$1"),
    (r"\[\[[^\|]*\|(.*?)\]\]", "$1"),
    (r"\[[^\|]*\s(.*?)\]", "$1"),
    (r"<\!--.*?-->", ""),
    (r"[\s]+", " "),
)


def clean_wiki(text: Column) -> Column:
    """Plain text of a wiki page; redirects and info boxes become empty."""
    dropped = F.lit(False)
    for start in DROPPED_PAGES:
        dropped = dropped | text.startswith(start)
    clean = text
    for pattern, new in WIKI_MARKUP:
        clean = F.regexp_replace(clean, pattern, new)
    return F.when(dropped, F.lit("")).otherwise(clean)
