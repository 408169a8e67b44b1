"""Benchmark decontamination by a broadcast set of normalised test n-grams.

A benchmark item gives all its windows of ten consecutive words; an item with fewer words gives one
window of all of them. Every position of every document is hashed over the window length and looked
up in the broadcast set of window hashes; what the hash finds is compared word by word. Documents
are read once: each contributes one closing row that passes the look-up whatever it holds, so
counting hits per document needs no second pass and no join back.

The set is broadcast in blocks of a bounded number of windows, so a benchmark of any size is
handled; each block is one more pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.text import cut, lower_ascii

WINDOW = 10
#: Windows in one broadcast block; each holds at most ten words, so a block stays at some 50 MB.
BLOCK = 100_000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORDS_KEPT = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def normal_words(text: Column) -> Column:
    """Lower-cased words of ASCII letters, digits and anything beyond ASCII; null text has none."""
    low = lower_ascii(F.coalesce(text, F.lit("")))
    bare = F.regexp_replace(low, rf"^{SEPARATORS}|{SEPARATORS}$", "")
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SEPARATORS))


def hashed(parts: Column, at: Column, length: int) -> Column:
    """Hash of `length` words from position `at` (from 0) on."""
    return F.xxhash64(*[F.get(parts, at + F.lit(j)) for j in range(length)])


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows: len, hash, gram (the words) and the ids of the items that hold them.

    Items without words give none. An item without an id marks words but is not listed.
    """
    parts = benchmark.select(F.col("item_id").cast("string").alias("item"), normal_words(F.col("text")).alias("w"))
    n = F.size("w")
    starts = F.sequence(F.lit(0), F.greatest(n - window, F.lit(0)))
    grams = parts.where(n > 0).select("item", "w", F.explode(starts).alias("p")).select(
        "item", F.slice("w", F.col("p") + 1, F.least(n, F.lit(window))).alias("gram")
    )
    return grams.groupBy("gram").agg(F.collect_set("item").alias("items")).select(
        F.size("gram").alias("len"), "gram", "items"
    )


def hits(docs: DataFrame, grams: DataFrame, lengths: list[int], closing: bool) -> DataFrame:
    """A row per window found: the document's key, position, length and items; and, if `closing`,
    one row per document with a null length."""
    parts = docs.select(
        "doc_id", F.xxhash64("text").alias("digest"), normal_words(F.col("text")).alias("w")
    ).withColumn("n_words", F.size("w").cast("long"))
    spots = parts.select("*", F.explode(F.sequence(F.lit(0), F.size("w"))).alias("p"))
    tries = [
        F.struct(F.lit(k).alias("len"), F.when(F.col("p") + k <= F.size("w"), hashed(F.col("w"), F.col("p"), k)).alias("h"))
        for k in lengths
    ]
    if len(tries) == 1:
        spots = spots.withColumn("t", tries[0])
    else:
        spots = spots.withColumn("t", F.explode(F.array(*tries)))
    spots = spots.select("doc_id", "digest", "n_words", "w", "p", F.col("t.len").alias("k"), F.col("t.h").alias("h"))
    table = reduce(DataFrame.unionByName, [
        grams.where(F.col("len") == k).select(
            F.lit(k).alias("len"), hashed(F.col("gram"), F.lit(0), k).alias("hash"), "gram", "items")
        for k in lengths
    ])
    found = spots.join(F.broadcast(table), (F.col("h") == F.col("hash")) & (F.col("k") == F.col("len")), "left")
    same = F.slice("w", F.col("p") + 1, F.col("k")) == F.col("gram")
    last = (F.col("p") == F.col("n_words")) & (F.col("k") == lengths[0])
    keep = (F.col("len").isNotNull() & same) | (last if closing else F.lit(False))
    return found.where(keep).select(
        "doc_id", "digest", "n_words", "p", F.when(F.col("gram").isNotNull(), F.col("len")).alias("len"), "items"
    )


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """What of the benchmark each document holds.

    Returns per row of `docs`: doc_id, digest (of the text), n_words, n_hit (words inside an
    occurrence of a window), n_items, items (ids found, sorted as strings), spots (start and length
    of every hit) and contaminated.

    A null text has no words and is clean; a null doc_id is kept; repeated rows are returned as
    often as they occur; an empty benchmark leaves every document clean. Other columns are ignored.
    """
    grams = cut(windows(benchmark, window), "benchmark-windows")
    lengths = sorted((r[0] for r in grams.select("len").distinct().collect()), reverse=True)  # at most `window`
    blocks = max(1, -(-grams.count() // block))
    share = F.pmod(F.xxhash64("gram"), F.lit(blocks))
    found = reduce(DataFrame.unionByName, [
        hits(docs, grams if blocks == 1 else grams.where(share == b), lengths or [window], closing=b == 0)
        for b in range(blocks)
    ])
    spot = F.when(F.col("len").isNotNull(), F.struct("p", "len"))
    rows = found.groupBy("doc_id", "digest", "n_words").agg(
        F.sum(F.when(F.col("len").isNull(), 1).otherwise(0)).alias("copies"),
        F.array_sort(F.collect_set(spot)).alias("spots"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    covered = F.array_distinct(F.flatten(F.transform("spots", lambda s: F.sequence(s["p"], s["p"] + s["len"] - 1))))
    return rows.select(
        "doc_id", "digest", "n_words", F.size(covered).cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.array_sort("items").alias("items"), "spots",
        (F.size("spots") > 0).alias("contaminated"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"),
    ).drop("_copy")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest columns of `scan`."""
    return scan(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


def without_spans(text: Column, spots: Column) -> Column:
    """The text with every word inside a hit removed, and the separator before it."""
    text = F.coalesce(text, F.lit(""))
    shown = F.regexp_extract_all(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0))
    gaps = F.split(text, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    gone = F.array_distinct(F.flatten(F.transform(spots, lambda s: F.sequence(s["p"], s["p"] + s["len"] - 1))))
    kept = F.array_except(F.sequence(F.lit(0), F.size(shown) - 1), gone)
    left = F.transform(kept, lambda i: F.concat(F.get(gaps, i), F.get(shown, i)))
    return F.when(F.size(shown) == 0, text).otherwise(
        F.concat(F.array_join(left, ""), F.element_at(gaps, -1)))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents") -> DataFrame:
    """`docs` without what the benchmark holds, with all its columns.

    `remove` is "documents" (any hit removes the row) or "spans" (hit words are cut from the text).
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be 'documents' or 'spans', not {remove!r}")
    bad = cut(scan(docs, benchmark).where("contaminated").select("doc_id", "digest", "spots").dropDuplicates(
        ["doc_id", "digest"]), "benchmark-hits")
    here = docs["doc_id"].eqNullSafe(bad["doc_id"]) & (F.xxhash64(docs["text"]) == bad["digest"])
    if remove == "documents":
        return docs.join(bad, here, "left_anti")
    cut_text = F.when(bad["spots"].isNull(), docs["text"]).otherwise(without_spans(docs["text"], bad["spots"]))
    joined = docs.join(bad, here, "left")
    return joined.select(*[cut_text.alias("text") if c == "text" else docs[c] for c in docs.columns])
