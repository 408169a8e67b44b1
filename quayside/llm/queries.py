"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import (
    alignment, brown, decontaminate, divergence, html_extract, langid, licenses, line_dedup, mixing, ranking, simhash,
    urls, whitening,
)
from quayside.llm.text import read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of every document for a mix of sources weighing 1, 2, 3, 1, 2, 3, ..."""
    return mixing.mix(read(spark, sf_dir, "documents"))


@query
def op5_benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in a window of ten words of a benchmark item."""
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op10_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Allow or block for every page's url: the longest rule, else the purity of its template."""
    return urls.judge(read(spark, sf_dir, "pages"))


@query
def op7_quality_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learnt from pairs of labelled ones."""
    return ranking.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op9_simhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and class of every document, linked at four or fewer bits."""
    return simhash.classes(read(spark, sf_dir, "documents"))


@query
def op8_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict by distance to the language references, for every document."""
    return divergence.judge(read(spark, sf_dir, "documents"))


@query
def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page as plain text."""
    return html_extract.extract(read(spark, sf_dir, "pages"))


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices of every document."""
    found = licenses.scan(read(spark, sf_dir, "documents"))
    return found.withColumn("first_word", F.get("matches", F.lit(0))["start"]).drop("matches")


@query
def op2_brown_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every document under a class-based bigram model."""
    return brown.score(read(spark, sf_dir, "documents"))


@query
def op3_language_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document from its text, its declaration and its source."""
    return langid.of_documents(read(spark, sf_dir, "documents")).drop("digest")


@query
def page_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page from its main text, markup, address suffix and host."""
    return langid.of_pages(html_extract.extract(read(spark, sf_dir, "pages")), read(spark, sf_dir, "documents"))


@query
def op11_qdwh_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the 32 leading components of the grid covariance, whitened."""
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


@query
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document before, dropped, and the digest of what is left."""
    left = line_dedup.drop_repeated(read(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op13_token_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of every document's tokens under two tokenizers."""
    aligned = alignment.align(read(spark, sf_dir, "documents"), digest=True)
    return aligned.withColumnRenamed("groups", "groups_sha256")
