"""Connected components of a link table, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.text import cut


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Point every node's larger (or smaller) neighbours at its smallest neighbour or itself.

    The smallest neighbour is an aggregate that is combined before the shuffle, and joins put it
    back, so a node with very many links is no list in any task.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = both.join(least, "a")
    if large:
        moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        own = least.select("a", F.col("m").alias("b"))
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(own)
    return moved.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """`node` and `root`, the smallest node it is linked with, for every node of `links` (a, b).

    Repeated links and links of a node with itself change nothing; no links give no rows. Each round
    is written to the shared folder; rounds end when the set of links no longer changes.
    """
    current = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    seen = None
    while True:
        mark = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == seen:
            break
        seen = mark
        current = cut(_stars(cut(_stars(current, True), "links"), False), "links")
    roots = current.select(F.col("b").alias("node")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root")))
