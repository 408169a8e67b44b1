"""Small inputs with every awkward case, and plain-Python twins of what operators count."""

import random
import re

from pyspark.sql import functions as F

WORDS = {
    "en": "the of and to in that is for it with was on be by at from this are river stone garden winter".split(),
    "de": "der die und das nicht ein zu mit auf von für ist im den dem über straße gärten winter wasser".split(),
    "fr": "le la les des et une dans pour que sur pas été rivière jardin hiver très où avec mais être".split(),
}
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def low(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def prose(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


def documents(n=120, seed=1):
    """(doc_id, text, lang, source): prose and junk, a hot source, exact and near copies."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        text = prose(rng, lang, rng.randint(60, 160))
        if i % 7 == 3:
            text = " ".join(w.upper() + "!!" for w in text.split())
        elif i % 7 == 5:
            text = " ".join(w + rng.choice(["###", "%%%"]) for w in text.split())
        rows.append((i, text, lang, "hot" if i % 3 == 0 else f"s{i % 5}"))
    rows += [(n + 1, rows[0][1], "en", "s1"), (n + 2, rows[0][1] + " so", "en", "hot")]
    return rows


AWKWARD = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \t\n ", "en", "a"), (None, "the river is in the garden", "en", "a"),
    (4, "the of", None, "b"), (4, "the of", None, "b"), (5, "x" * 20_000, "en", None), (6, "the stone and the river " * 4000, "en", "b"),
    (7, "\u00a0\u2028 é É ß 漢字 \U0001F600", "de", ""), (None, None, None, None), (8, "12 34 # $ !! ?", "fr", "b"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
#: Columns that documents may carry as well and that operators use names like.
CLASHING = "size target sid w x n_words node root cell fp digest h k p len copies score _row _id _digest seen".split()


def frame(spark, rows, clashing=True):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in CLASHING}) if clashing else df
