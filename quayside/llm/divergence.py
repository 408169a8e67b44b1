"""Quality rules by distribution divergence.

A document's characters (by class) and its words (the common words of the corpus, and all others)
are two histograms. A language's reference is the mean histograms of the documents that declare it and pass
the base rules; only languages with enough different texts have one. The Jensen-Shannon distance
(base 2, so between 0 and 1) of a document to a reference, taken without the document itself, must
stay below a limit for either histogram; a histogram of too few characters or words is not judged.
Words are held against the reference of the document's own language, or the nearest if it declares
none; of a language without a reference no common words are known, and words are not judged.
Characters tell junk from prose, hardly one language from the next, and are held against the nearest.

Documents are read twice, once to count words and once to take their counts; what follows reads the
counts. No text is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.text import SPACE, cut, lower_ascii, without_space, words

#: Base rules.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SYMBOLS = "#*$%&|<>"
#: Common words taken from each language.
COMMON = 24
CLASSES = ("lower", "upper", "digit", "space", "symbol", "other")
#: Limits of the distances, and the least characters and words to judge by.
CLASS_LIMIT, CLASS_GUARD = 0.29, 200
WORD_LIMIT, WORD_GUARD = 0.46, 50
#: A language has a reference if it has this share of all documents (so there are at most 1/SHARE of
#: them), and at least so many different texts that pass the base rules.
SHARE, LEAST_TEXTS = 0.001, 20


def window_hashes(parts: Column) -> Column:
    """Hashes of all windows of three words."""
    n = F.size(parts)
    spots = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    return F.transform(spots, lambda i: F.xxhash64(F.get(parts, i), F.get(parts, i + 1), F.get(parts, i + 2)))


def base(docs: DataFrame) -> DataFrame:
    """`docs` with `w` (words), n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and
    base_failed.

    Words that repeat are found by sorting the window hashes of a document together with their
    positions: equal neighbours mark both windows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda s: F.btrim(s, F.lit(SPACE)) != "")
    marked = docs.withColumns({"w": words(F.col("text")), "_lines": lines})
    marked = marked.withColumn("_h", window_hashes(F.col("w")))
    twice = F.size(F.array_distinct("_h")) < F.size("_h")
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    placed = F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    marked = marked.withColumn("_s", F.when(twice, placed).otherwise(none))
    beside = lambda e, k: F.coalesce(e["h"] == F.get("_s", k)["h"], F.lit(False))
    found = F.filter("_s", lambda e, k: beside(e, k - 1) | beside(e, k + 1))
    covered = F.array_distinct(F.flatten(F.transform(found, lambda e: F.array(e["i"], e["i"] + 1, e["i"] + 2))))
    count = lambda c: c.cast("long")
    out = marked.withColumns({
        "n_words": count(F.size("w")), "word_chars": count(F.length(without_space(text))),
        "n_symbols": count(F.length(text) - F.length(F.translate(text, SYMBOLS, ""))),
        "n_dup_lines": count(F.size("_lines") - F.size(F.array_distinct("_lines"))),
        "n_repeat_words": count(F.size(covered)),
    })
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed).drop("_lines", "_h", "_s")


def classes(text: Column, n_symbols: Column) -> Column:
    """Characters of each class of `CLASSES`."""
    length = F.length(text)
    gone = lambda pattern: length - F.length(F.regexp_replace(text, pattern, ""))
    lower, upper, digit = gone(r"\p{Ll}+"), gone(r"\p{Lu}+"), gone("[0-9]+")
    space = length - F.length(without_space(text))
    rest = length - lower - upper - digit - space - n_symbols
    return F.array(*[c.cast("double") for c in (lower, upper, digit, space, n_symbols, rest)])


def languages(docs: DataFrame, share: float = SHARE) -> list[str]:
    """The declared languages that hold at least `share` of all documents; at most 1/share."""
    counts = docs.groupBy("lang").count()
    total = counts.agg(F.sum("count")).first()[0] or 0
    held = counts.where(F.col("lang").isNotNull() & (F.col("count") >= share * total))
    return sorted(r["lang"] for r in held.collect())


def common_words(docs: DataFrame, langs: list[str], per_language: int = COMMON) -> list[str]:
    """The most frequent words of each of `langs`, over all their documents; ties by the word."""
    parts = docs.where(F.col("lang").isin(langs)).select(
        "lang", F.explode(F.split(lower_ascii(F.col("text")), r"[\x20\x09-\x0D]+")).alias("word")).where("word <> ''")
    counts = parts.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    top = counts.withColumn("_place", place).where(F.col("_place") <= per_language)
    return sorted(r[0] for r in top.select("word").distinct().collect())  # per_language words a language


def with_seen(rows: DataFrame, common: list[str]) -> DataFrame:
    """Add `seen`, structs (i, n): the common words of a document by their place in the list, and how
    often. The words found are a column of their own, as they are visited once per distinct one."""
    if not common:
        return rows.withColumn("seen", F.array().cast("array<struct<i:int,n:int>>"))
    known, longest = F.array(*map(F.lit, common)), max(len(w.encode()) for w in common)
    short = F.filter("w", lambda w: F.octet_length(w) <= longest)  # lower-casing A-Z keeps the length
    hits = F.filter(F.transform(short, lower_ascii), lambda w: w.isin(common))
    return rows.withColumn("_hits", hits).withColumn("seen", F.transform(F.array_distinct("_hits"), lambda c: F.struct(
        (F.array_position(known, c) - 1).cast("int").alias("i"),
        F.size(F.filter("_hits", lambda w: w == c)).alias("n")))).drop("_hits")


def _half(p: Column, q: Column) -> Column:
    """p log2(2p / (p + q)), zero where p is."""
    return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)


def distance(pairs: list[tuple[Column, Column]]) -> Column:
    """Jensen-Shannon distance of two histograms given cell by cell."""
    total = sum((_half(p, q) + _half(q, p) for p, q in pairs), F.lit(0.0)) / 2
    return F.sqrt(F.greatest(total, F.lit(0.0)))


@dataclass(frozen=True)
class Reference:
    """Mean shares of one language: of character classes, of each common word, of other words; and
    the documents that they are the mean of."""

    lang: str
    docs: int
    classes: tuple[float, ...]
    words: tuple[float, ...]


def references(counts: DataFrame, langs: list[str], n_common: int, least: int = LEAST_TEXTS) -> list[Reference]:
    """Mean histograms of those of `langs` that have `least` different texts passing the base rules."""
    good = counts.where(~F.col("base_failed") & F.col("lang").isin(langs))
    texts = good.select("lang", "digest").distinct().groupBy("lang").count().where(F.col("count") >= least)
    shares = [F.avg(F.get("classes", F.lit(i)) / F.col("n_chars")) for i in range(len(CLASSES))]
    flat = good.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"), *[c.alias(f"c{i}") for i, c in enumerate(shares)])
    of_words = good.select("lang", "n_words", F.explode("seen").alias("s")).groupBy("lang", "s.i").agg(
        F.sum(F.col("s.n") / F.col("n_words")).alias("share"))
    known = {r["lang"] for r in texts.collect()}
    rows = {r["lang"]: r for r in flat.collect() if r["lang"] in known}
    table = {(r["lang"], r["i"]): r["share"] for r in of_words.collect()}
    return [
        Reference(lang, r["docs"], tuple(r[f"c{i}"] or 0.0 for i in range(len(CLASSES))),
                  tuple(table.get((lang, i), 0.0) / r["docs"] for i in range(n_common)))
        for lang, r in sorted(rows.items())
    ]


def without(ref: Reference, mean: Column, own: Column) -> Column:
    """A mean of the reference without the document at hand, if it is one of those averaged."""
    inside = (F.col("lang") == ref.lang) & ~F.col("base_failed")
    rest = F.greatest((ref.docs * mean - own) / max(ref.docs - 1, 1), F.lit(0.0))
    return F.when(inside, rest).otherwise(mean)


def class_distance(ref: Reference) -> Column:
    p = [F.get("classes", F.lit(i)) / F.greatest("n_chars", F.lit(1)) for i in range(len(CLASSES))]
    return distance([(c, without(ref, F.lit(q), c)) for c, q in zip(p, ref.classes)])


def word_distance(ref: Reference) -> Column:
    """Only words that a document has are visited: an absent one adds half its reference share."""
    q = F.array(*[F.lit(v) for v in ref.words]) if ref.words else F.array().cast("array<double>")
    n = F.greatest("n_words", F.lit(1))

    def part(s: Column) -> Column:
        p = s["n"] / n
        r = without(ref, F.get(q, s["i"]), p)
        return _half(p, r) + _half(r, p) - r

    inside = F.aggregate("seen", F.lit(0.0), lambda acc, s: acc + part(s))
    common = F.aggregate("seen", F.lit(0.0), lambda acc, s: acc + s["n"] / n)
    expected = without(ref, F.lit(sum(ref.words)), common)
    others, rest = 1 - common, 1 - expected
    total = (inside + expected + _half(others, rest) + _half(rest, others)) / 2
    return F.sqrt(F.greatest(total, F.lit(0.0)))


def measure(docs: DataFrame) -> tuple[DataFrame, list[Reference]]:
    """Counts of every document, written to the shared folder, and the references."""
    own = docs.select("doc_id", "text", "lang")
    langs = languages(own)
    common = common_words(own, langs)
    rows = with_seen(base(own), common)
    text = F.coalesce(F.col("text"), F.lit(""))
    counts = cut(rows.select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.length(text).alias("n_chars"), classes(text, F.col("n_symbols")).alias("classes"), "seen",
        F.xxhash64(text).alias("digest"),
    ), "divergence")
    return counts, references(counts, langs, len(common))


def nearest(each: list[Column]) -> Column:
    return each[0] if len(each) == 1 else F.least(*each)


def own_first(refs: list[Reference], each: list[Column]) -> Column:
    """The distance to the reference of the declared language, to the nearest where it has none."""
    chosen = nearest(each)
    for ref, far in zip(refs, each):
        chosen = F.when(F.col("lang") == ref.lang, far).otherwise(chosen)
    return chosen


def judge(docs: DataFrame) -> DataFrame:
    """Base counts, distances and verdict for every row of `docs`.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    class_distance (to the nearest reference) and word_distance (to that of the document's language, to
    the nearest if it has none).

    A null or empty text has no words and fails the base rules; without any reference (no language is
    declared often enough) the base rules alone decide and the distances are zero; a document of a
    declared language without a reference is judged by class_distance only; a null doc_id is kept as
    it is; repeated rows are judged alike, and count once towards the texts that a language needs; no
    rows give no rows; other columns are not looked at.
    """
    counts, refs = measure(docs)
    far = {"class_distance": F.lit(0.0), "word_distance": F.lit(0.0)}
    if refs:
        far = {"class_distance": nearest([class_distance(r) for r in refs]),
               "word_distance": own_first(refs, [word_distance(r) for r in refs])}
    judged = counts.withColumns(far)
    unknown = F.col("lang").isNotNull() & ~F.col("lang").isin([r.lang for r in refs])
    fine = (
        ((F.col("n_chars") < CLASS_GUARD) | (F.col("class_distance") <= CLASS_LIMIT))
        & ((F.col("n_words") < WORD_GUARD) | unknown | (F.col("word_distance") <= WORD_LIMIT))
    )
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & fine).alias("kept"), "class_distance", "word_distance")
