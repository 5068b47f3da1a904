"""Word lists: stop words by rule, named entities, replacements. Each can be given instead."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .normalize import normalize_term

# German function words from stems and endings. A list of one's own is a parameter of whatever takes stop words.
ARTICLES = tuple(s + e for s in ("ein", "kein", "mein", "dein", "sein", "ihr", "unser", "euer") for e in ("", "e", "em", "en", "er", "es"))
POINTERS = tuple(s + e for s in ("dies", "jed", "jen", "welch", "solch", "manch", "all", "ander", "einig", "weiter", "folgend") for e in ("e", "em", "en", "er", "es"))
AMOUNTS = tuple(s + e for s in ("viel", "wenig", "meist", "beid", "mehrer", "sämtlich", "erst", "eigen") for e in ("e", "en", "er", "es"))
PREPOSITIONS = "an auf aus bei durch für gegen hinter in mit nach neben über um unter von vor zu zwischen".split()
#: There, where and here with a preposition, an r before a vowel: damit, woran, hiervon.
JOINED = tuple(f + ("r" if p[0] in "aeiouäöü" and f != "hier" else "") + p for f in ("da", "wo", "hier") for p in PREPOSITIONS)
#: Present and past of the verbs that others need.
PAST = tuple(s + e for s in ("hatt", "hätt", "konnt", "könnt", "musst", "müsst", "sollt", "wollt", "durft", "dürft", "mocht", "möcht", "wurd", "würd", "wär") for e in ("e", "en", "est", "et"))
PRESENT = tuple(s + e for s in ("hab", "könn", "müss", "soll", "woll", "dürf", "mög", "werd", "mach", "geb") for e in ("e", "en", "t", "et"))
PLAIN = (
    "aber als also am an auch auf aus außer außerdem bald bei beim bereits bevor bin bis bist bloß da dabei dadurch daher dahin damals dann darf darum das dass dazu dein dem den denen denn dennoch der deren "
    "des deshalb dessen dich die dir doch dort du durch ebenfalls ebenso eher entweder er es etwa etwas euch falls fast für ganz gar gegen gehabt genau gewesen geworden gibt hast hat her hin ich ihm ihn "
    "ihnen im immer in indem innerhalb ins inzwischen irgend ist ja jedoch jemand jetzt kann kaum man mag mehr mich mindestens mir mit muss nach nachdem neben nein nicht nichts nie niemand noch nun nur ob "
    "obwohl oder oft ohne pro schon sehr sei seid seit seitdem selber selbst sich sie sind so sobald sogar solange somit sondern sonst soweit sowie statt stets trotz trotzdem über um und uns unter vom von "
    "vor während wann war waren warum was wegen weil weiterhin wem wen wenn wer weshalb wessen wie wieder will wir wird wirst wohl zu zudem zum zur zusammen zwar zwischen"
).split()
STOP_WORDS = frozenset((*ARTICLES, *POINTERS, *AMOUNTS, *JOINED, *PAST, *PRESENT, *PLAIN))


def stop_stems(words=STOP_WORDS) -> list[str]:  # noqa: ANN001
    """Normal forms of the stop words."""
    return sorted({normalize_term(w).strip() for w in words} - {""})


# The known entities, a blank as an underscore.
ENTITIES = (
    "Sepp_Blatter",
    "St_Gallen",
    "St_Moritz",
    "Johann_Schneider-Ammann",
    "Roger_Federer",
    "Los_Angeles",
    "Wladimir_Putin",
    "Christoph_Blocher",
    "New_York",
    "Formel_1",
)
# Abbreviations and what they stand for.
REPLACEMENTS = {"US": "USA", "BR": "Bundesrat", "F1": "Formel_1"}


def entity_keys(entities=ENTITIES) -> dict[str, str]:  # noqa: ANN001
    """Normalised words of an entity, joined by underscores, to its written form."""
    out = {}
    for e in entities:
        parts = [normalize_term(p.strip()) for p in e.replace("-", "_").split("_") if p.strip()]
        out["_".join(parts)] = e.replace("_", " ")
    return out


def entity_order(entities=ENTITIES) -> list[str]:  # noqa: ANN001
    """Keys of entities of two or three words in the order in which they are looked for: longest first."""
    return sorted((k for k in entity_keys(entities) if 1 <= k.count("_") <= 2), key=lambda k: (-k.count("_"), -len(k), k))


def mark_entities(text: Column, entities=ENTITIES) -> Column:  # noqa: ANN001
    """Known entities of up to three words in a normalised text become one word; longest first, single blanks."""
    out = F.regexp_replace(text, " +", " ")
    for key in entity_order(entities):
        out = F.regexp_replace(out, rf"(?<!\S){re.escape(key.replace('_', ' '))}(?!\S)", key)
    return F.trim(out)


def replace_terms(term: Column, replacements=None) -> Column:  # noqa: ANN001
    """A term's replacement, or itself."""
    items = [F.lit(x) for pair in (replacements or REPLACEMENTS).items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*items), term), term)


def de_stem(stem: Column, originals: Column) -> Column:
    """Written form of a stem from a map column; parts of a compound one by one, unknown ones as they are."""
    return F.array_join(F.transform(F.split(stem, "_"), lambda p: F.coalesce(F.try_element_at(originals, p), p)), " ")


def written_forms(stems: DataFrame, forms: DataFrame) -> DataFrame:
    """stem, written: de_stem against a dictionary of any size (forms: stem, form), part by part."""
    parts = stems.select("stem", F.posexplode(F.split("stem", "_")).alias("place", "part"))
    found = parts.join(forms.select(F.col("stem").alias("part"), "form"), "part", "left")
    rows = found.groupBy("stem").agg(F.sort_array(F.collect_list(F.struct("place", F.coalesce("form", "part").alias("form")))).alias("_p"))
    return rows.select("stem", F.array_join(F.transform("_p", lambda p: p["form"]), " ").alias("written"))
