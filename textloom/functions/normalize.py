"""Normal forms of terms: accents, case and German endings.

Decomposition and stemming have no SQL form. They run as Arrow-batched functions that remember
the terms they have seen, so their cost follows a worker's different terms.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

_TRIMMED = "".join(map(chr, range(33)))


def _is_mark(c: str) -> bool:
    kind = unicodedata.category(c)
    return kind[0] == "M" or kind in ("Lm", "Sk")


class _Marks(dict):
    """For str.translate: no marks; characters are looked up once."""

    def __missing__(self, c: int) -> int | None:
        self[c] = None if _is_mark(chr(c)) else c
        return self[c]


_MARKS = _Marks()


def normalize(text: str | None) -> str | None:
    """Lower case, no accents, everything but letters and digits as single hyphens, none at the end."""
    if text is None:
        return None
    if text.isascii() and text.isalnum():
        return text.lower()
    plain = unicodedata.normalize("NFD", text.strip(_TRIMMED).lower())
    plain = plain.translate(_MARKS)
    plain = plain.replace("'s", "").replace("ß", "ss").replace("ø", "o")
    plain = re.sub(r"-+", "-", re.sub(r"[^a-zA-Z0-9-]+", "-", plain))
    return plain.removesuffix("-")


# One-letter codes of letter groups, longest first, and how often each counts as shortened.
CODES = (("sch", "$"), ("ch", "C"), ("ei", "%"), ("ie", "&"), ("ig", "#"), ("st", "!"))
UMLAUTS = str.maketrans("äöü", "aou")
#: Endings with the least coded length (shortenings included) they need beyond; None: always.
ENDINGS = (("nd", 5), ("em", 4), ("er", 4), ("e", None), ("s", None), ("n", None), ("t", None))
DOUBLED = "*"

_CODE_OF, _GROUP_OF = dict(CODES), {k: g for g, k in CODES}
_GROUPS = re.compile("|".join(_CODE_OF))
# What a word must hold to be read letter by letter: a letter that is doubled or changed.
_BY_LETTER = re.compile(r"(.)\1|[ßäöü]", re.DOTALL)
_LAST = frozenset(e[-1] for e, _ in ENDINGS)
_CODED = str.maketrans(_GROUP_OF)


def _encoded(word: str) -> tuple[str, int]:
    """Letter groups as one letter, doubled letters marked, and the count of shortenings."""
    out, saved, i = "", 0, 0
    if not _BY_LETTER.search(word):
        for group in _GROUPS.findall(word):
            saved = 2 if len(group) == 3 else saved + 1
        return _GROUPS.sub(lambda m: _CODE_OF[m[0]], word) if saved else word, saved
    while i < len(word):
        c, rest = word[i], word[i:]
        i += 1
        if out and c == out[-1]:
            out += DOUBLED
            continue
        if c == "ß" and len(rest) > 1:
            out, saved = out + "s" + DOUBLED, saved + 1
            continue
        group = next(((g, k) for g, k in CODES if rest.startswith(g)), None)
        if group:
            # three letters set the count instead of adding to it
            saved = 2 if len(group[0]) == 3 else saved + 1
            out, i = out + group[1], i + len(group[0]) - 1
        else:
            out += c.translate(UMLAUTS)
    return out, saved


def _stripped(word: str, saved: int, noun: bool) -> str:
    while len(word) > 3 and word[-1] in _LAST:
        for ending, beyond in ENDINGS:
            if word.endswith(ending) and (beyond is None or len(word) + saved > beyond) and not (ending == "t" and noun):
                word = word[: -len(ending)]
                break
        else:
            break
    return word


def _decoded(word: str) -> str:
    if DOUBLED not in word:
        return word.translate(_CODED)
    out = ""
    for c in word:
        out += out[-1] if c == DOUBLED and out else _GROUP_OF.get(c, c)
    return out


@lru_cache(200_000)
def stem(term: str | None) -> str | None:
    """Stem of a German word; terms with anything but letters are only lower-cased."""
    if not term:
        return term
    low = term.lower()
    if not low.isalpha():
        return low
    noun = term[0].isupper()
    word, saved = _encoded(low)
    word = _stripped(word, saved, noun)
    if len(word) > 5 and word.endswith("erin" + DOUBLED):
        word = _stripped(word[:-1], saved, noun)
    if word.endswith("z"):
        word = word[:-1] + "x"
    word = _decoded(word)
    return word.replace("gege", "ge", 1) if len(word) > 4 else word


#: Characters of the longest term whose form is remembered; whole texts are not kept in memory.
KEPT_CHARS = 200


def _term_of(term: str) -> str:
    parts = normalize(term).split("-")
    while len(parts) > 1 and not parts[-1]:
        parts.pop()
    return " ".join(stem(p) for p in parts)


_kept_term = lru_cache(200_000)(_term_of)


def normalize_term(term: str | None) -> str | None:
    """Stems of a term's normalised parts, joined by blanks. A part that was only marks at the front leaves a leading blank."""
    if term is None:
        return None
    return _kept_term(term) if len(term) <= KEPT_CHARS else _term_of(term)


@F.pandas_udf(StringType())
def _normalized(x: pd.Series) -> pd.Series:
    return x.map(normalize, na_action="ignore")


@F.pandas_udf(ArrayType(StringType()))
def _all_normalized(x: pd.Series) -> pd.Series:
    return x.map(lambda texts: None if texts is None else [normalize(t) for t in texts])


@F.pandas_udf(StringType())
def _normalized_term(x: pd.Series) -> pd.Series:
    return x.map(normalize_term, na_action="ignore")


@F.pandas_udf(StringType())
def _stemmed(x: pd.Series) -> pd.Series:
    return x.map(stem, na_action="ignore")


def normalized(text: Column) -> Column:
    return _normalized(text)


def all_normalized(texts: Column) -> Column:
    """Normal forms of an array's texts."""
    return _all_normalized(texts)


def stemmed(term: Column) -> Column:
    return _stemmed(term)


def term_form(term: Column, strict: bool = False) -> Column:
    """normalize_term as a column; unless strict, blanks at the ends go."""
    form = _normalized_term(term)
    return form if strict else F.trim(form)


def register(spark: SparkSession) -> None:
    """normalize, stem and normalize_term for SQL."""
    spark.udf.register("normalize", _normalized)
    spark.udf.register("stem", _stemmed)
    spark.udf.register("normalize_term", _normalized_term)
