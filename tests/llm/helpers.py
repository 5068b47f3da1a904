import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, size string, key string, bits string, _id string"


def rows_of(texts, sources=None):
    """Rows of documents with further columns whose names the operators use inside."""
    return [(i, t, "en", (sources or ["s"])[i % len(sources or ["s"])], len(t) if t is not None else None, "n", "s", "k", "b", "i") for i, t in enumerate(texts)]


def docs_of(spark, texts, sources=None):
    return spark.createDataFrame(rows_of(texts, sources), SCHEMA)


def prose(n, seed, vocabulary=4000):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def edited(text, share, seed):
    """The text with a share of its words replaced."""
    r = random.Random(seed)
    words = text.split(" ")
    for i in r.sample(range(len(words)), int(share * len(words))):
        words[i] = f"e{r.randrange(10**6)}"
    return " ".join(words)


ODD = [None, "", " \t\n", "a", "a", "one two", "naïve Ünïcode     x\x1fy", "\x00\x0b nul", "same text twice over here now", "same text twice over here now", "Same Text twice over here NOW", "x" * 70_000, "word " * 30_000]
