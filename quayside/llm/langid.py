"""Language identification by Bayesian fusion of evidence.

The log posterior of a language is the sum of four terms: the likelihood of the text under a
character-trigram model, of the declared markup language, of the address suffix, and the host's prior.
Only the text model is trained on labelled rows. How far a declaration or a suffix can be trusted,
and what a host usually holds, is counted from the whole table: the text posteriors are summed by
declared language, by suffix, by host, by domain and overall. A host's prior is smoothed towards its
domain's, and that towards the overall shares, and leaves out the row itself.

One more class, `und`, stands for no language: it gives every trigram the same probability.

Rows are scored once and written; the counts are grouped sums joined back by key.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.text import cut
from quayside.llm.urls import host_of

UNDECIDED = "und"
#: Trigrams are counted in this many hash buckets.
BUCKETS = 1 << 15
#: Labelled documents that the text model is trained on, per language, in expectation; the only bound
#: in this module. Languages with fewer than `LEAST` labelled documents are not learnt.
SAMPLE, LEAST = 2000, 10
#: Neighbouring trigrams repeat each other's evidence; their log likelihood counts by this factor.
TEMPER = 0.5
#: Rows' worth of weight that the level above has in a prior, and pseudo-counts of a declaration.
STRENGTH, PSEUDO = 5.0, 0.5
CONFIDENT = 0.5
NUMBERED = re.compile(r"(?<!\S)[^\s\d]*+\d\S*")


def trigrams(text: str | None) -> Iterator[np.ndarray]:
    """Hash buckets of all character trigrams of the lower-cased text, a bounded part at a time.

    Words with a digit (numbers, addresses, keys) are of no language and left out.
    """
    code = np.frombuffer((" " + NUMBERED.sub("", (text or "").lower()) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    for at in range(0, len(code) - 2, 1 << 20):
        part = code[at:at + (1 << 20) + 2]
        with np.errstate(over="ignore"):
            h = (part[:-2] * np.uint32(0x9E3779B1)) ^ (part[1:-1] * np.uint32(0x85EBCA77)) ^ (part[2:] * np.uint32(0xC2B2AE3D))
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x27D4EB2F)
        yield (h >> np.uint32(17)).astype(np.int64)


@dataclass(frozen=True)
class TextModel:
    """Log probabilities of trigram buckets, one column per language and a last one for `und`."""

    languages: tuple[str, ...]
    table: np.ndarray

    def score(self, text: str | None) -> np.ndarray:
        total = np.zeros(self.table.shape[1])
        if text:
            for part in trigrams(text):
                total += self.table[part].sum(0, dtype=np.float64)
        return TEMPER * (total - total.max())


def train(labelled: DataFrame, sample: int = SAMPLE) -> TextModel:
    """Learn trigrams from a bounded sample of rows of (doc_id, text, lang), drawn by a hash of the id."""
    known = labelled.where("lang is not null and text is not null and trim(text) <> ''").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().where(F.col("count") >= LEAST).collect()}
    languages = tuple(sorted(sizes))
    if not languages:
        return TextModel((), np.zeros((BUCKETS, 1), np.float32))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1_000_000)) / 1e6
    share = F.lit(0.0)
    for lang in languages:
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample / sizes[lang]))).otherwise(share)
    place = {lang: i for i, lang in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(place), BUCKETS), np.int64)
        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang")):
                for part in trigrams(text.as_py()):
                    counts[place[lang.as_py()]] += np.bincount(part, minlength=BUCKETS)
        rows, cols = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(cols), pa.array(counts[rows, cols])], names=["l", "b", "n"])

    got = known.where(drawn < share).select("text", "lang").mapInArrow(run, "l long, b long, n long").groupBy("l", "b").agg(
        F.sum("n").alias("n")).toArrow()  # languages times buckets
    counts = np.zeros((BUCKETS, len(languages)))
    counts[got.column("b").to_numpy(), got.column("l").to_numpy()] = got.column("n").to_numpy()
    even = np.full((BUCKETS, 1), 1 / BUCKETS)
    share_of = (counts + 0.01) / (counts.sum(0) + 0.01 * BUCKETS)
    return TextModel(languages, np.log(np.hstack([share_of, even])).astype(np.float32))


def _scored(items: DataFrame, model: TextModel) -> DataFrame:
    """`items` without text, with `ll` (log likelihoods, best 0) and `post` (of the text alone)."""
    shared = items.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in items.columns if c != "text"]
    schema = ", ".join(f"`{c}` {dict(items.dtypes)[c]}" for c in kept) + ", ll array<double>, post array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ll = np.array([shared.value.score(t.as_py()) for t in batch.column("text")]).reshape(batch.num_rows, -1)
            post = np.exp(ll)
            post /= post.sum(1, keepdims=True)
            double = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(list(ll), double), pa.array(list(post), double)],
                names=[*kept, "ll", "post"])

    return items.mapInArrow(run, schema)


def _sums(rows: DataFrame, key: str, k: int, into: str) -> DataFrame:
    """Text posteriors summed by a key, as an array, under a key name of their own."""
    each = F.array(*[F.sum(F.get("post", F.lit(i))) for i in range(k)])
    return rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"_{into}")).agg(each.alias(into))


def _likelihood(sums: str, totals: Column, values: int) -> Column:
    """Log P(value | language) of a declaration or suffix; zero where the row has none."""
    each = F.zip_with(F.col(sums), totals, lambda s, t: F.log((s + PSEUDO) / (t + PSEUDO * values)))
    return F.coalesce(each, F.transform(totals, lambda _: F.lit(0.0)))


def fuse(items: DataFrame, model: TextModel) -> DataFrame:
    """The language of every item, from columns text, declared, suffix, domain and host.

    Returns the other columns of `items` and lang, confidence, text_lang (of the text alone) and
    evidence (log posterior per language, `und` last).

    A null text, declaration, suffix, domain or host adds no evidence of its kind; with none at all the
    overall shares decide. Rows are judged one by one, so repeated ones alike; without a trained
    language everything is `und`; no rows give no rows.
    """
    names = [*model.languages, UNDECIDED]
    k = len(names)
    rows = cut(_scored(items, model), "language-scores")
    first = rows.agg(F.count(F.lit(1)), *[F.sum(F.get("post", F.lit(i))) for i in range(k)],
                     F.approx_count_distinct("declared"), F.approx_count_distinct("suffix")).first()
    n, sums = first[0], [v or 0.0 for v in first[1:k + 1]]
    totals = F.array(*[F.lit(float(v)) for v in sums])
    overall = F.array(*[F.lit((v + 1.0 / k) / (n + 1)) for v in sums])
    joined = rows
    for key in ("declared", "suffix", "domain", "host"):
        joined = joined.join(_sums(rows, key, k, f"by_{key}"), F.col(key) == F.col(f"_by_{key}"), "left").drop(f"_by_{key}")
    less = lambda sums: F.coalesce(
        F.zip_with(F.col(sums), F.col("post"), lambda s, p: F.greatest(s - p, F.lit(0.0))), F.transform(overall, lambda _: F.lit(0.0)))
    mass = lambda a: F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v)

    def smooth(own: Column, above: Column) -> Column:
        return F.zip_with(own, above, lambda s, p: (s + STRENGTH * p) / (mass(own) + STRENGTH))

    joined = joined.withColumns({"_domain": less("by_domain"), "_host": less("by_host")})
    joined = joined.withColumn("_domain", smooth(F.col("_domain"), overall))
    joined = joined.withColumn("_host", smooth(F.col("_host"), F.col("_domain")))
    says = [_likelihood("by_declared", totals, max(1, first[k + 1])), _likelihood("by_suffix", totals, max(1, first[k + 2]))]
    total = F.zip_with("ll", F.transform("_host", lambda p: F.log(p)), lambda a, b: a + b)
    for term in says:
        total = F.zip_with(total, term, lambda a, b: a + b)
    joined = joined.withColumn("evidence", total).withColumn("_top", F.array_max("evidence"))
    names_column = F.array(*map(F.lit, names))
    best = lambda a: F.get(names_column, (F.array_position(a, F.array_max(a)) - 1).cast("int"))
    share = F.aggregate("evidence", F.lit(0.0), lambda acc, v: acc + F.exp(v - F.col("_top")))
    rest = [c for c in items.columns if c not in ("text", "declared", "suffix", "domain", "host")]
    return joined.select(
        *rest, best(F.col("evidence")).alias("lang"), (1 / share).alias("confidence"),
        best(F.col("post")).alias("text_lang"), "evidence")


def of_documents(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Language of every row of `docs`: doc_id, lang, confidence, text_lang, declared and kept.

    The source stands for the host and `lang` is the declaration; documents have no address. A row is
    kept if its language is one that was learnt and its posterior is at least one half.
    """
    model = train(docs if labelled is None else labelled)
    none = F.lit(None).cast("string")
    items = docs.select(
        "doc_id", F.col("lang").alias("said"), F.coalesce("text", F.lit("")).alias("text"), F.col("lang").alias("declared"),
        none.alias("suffix"), none.alias("domain"), F.col("source").alias("host"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest"))
    kept = (F.col("lang") != UNDECIDED) & (F.col("confidence") >= CONFIDENT)
    return fuse(items, model).select(
        "doc_id", "lang", "confidence", "text_lang", F.col("said").alias("declared"), kept.alias("kept"), "digest")


def of_pages(texts: DataFrame, labelled: DataFrame) -> DataFrame:
    """Language of every page: page_id, lang, confidence, text_lang, declared, suffix, host and kept.

    `texts` holds page_id, url, text (the page's main text) and lang (its declared markup language).
    The suffix is the last label of the host, the domain its last two.
    """
    host = F.nullif(host_of(F.col("url")), F.lit(""))
    labels = F.split(host, r"\.")
    domain = F.array_join(F.slice(labels, -F.least(F.size(labels), F.lit(2)), 2), ".")
    items = texts.select(
        "page_id", F.coalesce("text", F.lit("")).alias("text"), F.col("lang").alias("declared"),
        F.element_at(labels, -1).alias("suffix"), domain.alias("domain"), host.alias("host"))
    items = items.withColumns({"said": F.col("declared"), "ending": F.col("suffix"), "site": F.col("host")})
    kept = (F.col("lang") != UNDECIDED) & (F.col("confidence") >= CONFIDENT)
    return fuse(items, train(labelled)).select(
        "page_id", "lang", "confidence", "text_lang", F.col("said").alias("declared"), F.col("ending").alias("suffix"),
        F.col("site").alias("host"), kept.alias("kept"))


def keep(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, whose language is recognised."""
    gone = cut(of_documents(docs).where(~F.col("kept")).select("doc_id", "digest").distinct(), "language-gone")
    here = docs["doc_id"].eqNullSafe(gone["doc_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == gone["digest"])
    return docs.join(gone, here, "left_anti")
