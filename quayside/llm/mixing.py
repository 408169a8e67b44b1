"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the expected number of its copies in the mix. Among all rates under
which each source contributes its target of words, entropy balancing takes those closest to one in
relative entropy. They have the form ``min(cap, exp(lambda * size / mean size))`` with one number
lambda per source, the solution of the convex dual; Newton steps find it. A step is one grouped
sum over the table of (source, size, number of documents), so documents are read once.

Rates are rounded to whole copies: along the sizes of a source, the running sum of fractional parts
gives one copy more whenever it passes a half, and what is still missing from the target (or too
much) is then settled with the smallest documents. Documents of the same source and size are told
apart by a hash of their id, so a rerun gives the same copies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.scans import dense_sequence
from quayside.llm.text import count_words, cut

CAP = 3
WEIGHTS = (1, 2, 3)
SALTS = 64
TOLERANCE = 1e-7
ROUNDS = 60
#: Sizes that are summed as one step when running sums are carried along a source.
STRIDE = 64


def measure(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """doc_id, source, size in words (null text: 0), and a salt from the id."""
    return docs.select(
        "doc_id", "source", count_words(F.col("text")).alias("size"),
        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"),
    )


def number_sources(sizes: DataFrame, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """One row per source: its place `sid` in code-point order (null last), weight, total size."""
    totals = sizes.groupBy("source").agg(
        F.sum("n_docs").alias("n_docs"), F.sum(F.col("size") * F.col("n_docs")).alias("source_size"),
        F.sum(F.when(F.col("size") > 0, F.col("n_docs")).otherwise(0)).alias("n_filled"),
    )
    placed = dense_sequence(
        totals.withColumn("_last", F.col("source").isNull()), ["_last", "source"], "sid", start=-1
    )
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    return placed.withColumn(
        "weight", F.get(cycle, F.pmod("sid", F.lit(len(weights))).cast("int"))
    ).drop("_last")


def capped_targets(sources: DataFrame, cap: float = CAP) -> DataFrame:
    """Add `target` and `full`: shares of all words by weight, none above `cap` times its source.

    What is above a cap is shared again by weight among the rest, until none is above. Each round
    is one aggregate over the sources.
    """
    limit = F.col("source_size") * F.lit(float(cap))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        over = F.lit(level) * F.col("weight") > limit
        row = sources.agg(
            F.sum(F.when(over, limit).otherwise(0.0)), F.sum(F.when(over, 0.0).otherwise(F.col("weight")))
        ).first()
        free = row[1] or 0.0
        new = (total - (row[0] or 0.0)) / free if free else level
        if new <= level or not free:
            break
        level = new
    share = F.lit(level) * F.col("weight")
    return sources.withColumn("target", F.least(share, limit)).withColumn("full", share >= limit)


def rate(tilt: Column, size: Column, mean: Column, cap: float = CAP) -> Column:
    """Copies a document of this size is due. Empty documents keep a rate of one."""
    bound = F.lit(float(cap))
    return F.when(size == 0, F.lit(1.0)).when(tilt.isNull(), bound).otherwise(
        F.least(bound, F.exp(F.least(tilt * size / mean, F.lit(50.0))))
    )


def solve(cells: DataFrame, sources: DataFrame, cap: float = CAP) -> DataFrame:
    """Add `tilt` to each source by guarded Newton steps on the dual; null where the cap binds.

    The gradient of a source is the words its rates give minus its target, the second derivative
    the sum of size^2 * rate / mean over documents below the cap. Both come from one grouped sum.
    A step that leaves the interval known to hold the root is replaced by halving it.
    """
    state = sources.select(
        "sid", "target", "full", (F.col("source_size") / F.col("n_filled")).alias("mean"),
        F.lit(0.0).alias("tilt"), F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high"), F.lit(False).alias("done"),
    ).where("source_size > 0 and target > 0 and not full")
    state = cut(state, "mix-state")
    for _ in range(ROUNDS):
        r = rate(F.col("tilt"), F.col("size"), F.col("mean"), cap)
        words = F.col("size") * F.col("n_docs") * r
        sums = cells.join(state.where("not done").select("sid", "tilt", "mean"), "sid").groupBy("sid").agg(
            F.sum(words).alias("given"),
            F.sum(F.when(r < cap, words * F.col("size") / F.col("mean")).otherwise(0.0)).alias("slope"),
        )
        gap = F.col("given") - F.col("target")
        low = F.when(gap <= 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("tilt")).otherwise(F.col("high"))
        moved = state.join(sums, "sid", "left").withColumns({"low": low, "high": high})
        step = F.col("tilt") - gap / F.col("slope")
        inside = (
            F.col("slope").isNotNull() & (F.col("slope") > 0)
            & (F.col("low").isNull() | (step > F.col("low")))
            & (F.col("high").isNull() | (step < F.col("high")))
        )
        halfway = (
            F.when(F.col("high").isNull(), 2 * F.col("low") + 1)
            .when(F.col("low").isNull(), 2 * F.col("high") - 1)
            .otherwise((F.col("low") + F.col("high")) / 2)
        )
        near = F.abs(gap) <= F.lit(TOLERANCE) * F.col("target")
        state = cut(
            moved.select(
                "sid", "target", "full", "mean",
                F.when(F.col("done") | near, F.col("tilt")).when(inside, step).otherwise(halfway).alias("tilt"),
                "low", "high", (F.col("done") | F.coalesce(near, F.lit(True))).alias("done"),
            ),
            "mix-state",
        )
        if state.where("not done").isEmpty():
            break
    return sources.join(state.select("sid", "tilt"), "sid", "left").withColumn(
        "mean", F.col("source_size") / F.nullif(F.col("n_filled"), F.lit(0))
    )


def running(cells: DataFrame, value: Column, into: str) -> DataFrame:
    """Add the sum of `value` over the cells of the same source before this one, by size and salt.

    Sums within strides of sizes and sums of whole strides are kept apart, so that no task holds
    all cells of a source.
    """
    marked = cells.withColumn("_v", value).withColumn("_stride", F.floor(F.col("size") / F.lit(STRIDE)))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    heads = marked.groupBy("sid", "_stride").agg(F.sum("_v").alias("_sum"))
    along = before(Window.partitionBy("sid").orderBy("_stride"))
    starts = heads.select("sid", "_stride", F.coalesce(F.sum("_sum").over(along), F.lit(0.0)).alias("_start"))
    inside = before(Window.partitionBy("sid", "_stride").orderBy("size", "salt"))
    return (
        marked.withColumn("_in", F.coalesce(F.sum("_v").over(inside), F.lit(0.0)))
        .join(starts, ["sid", "_stride"])
        .withColumn(into, F.col("_start") + F.col("_in"))
        .drop("_v", "_stride", "_start", "_in")
    )


def round_cells(cells: DataFrame, sources: DataFrame, cap: int = CAP) -> DataFrame:
    """Per (source, size, salt): `base` copies for every document and one more for `extra` of them."""
    r = rate(F.col("tilt"), F.col("size"), F.col("mean"), cap)
    r = F.when(F.col("size") == 0, 1.0).when(F.col("target") <= 0, 0.0).otherwise(r)
    rated = cells.join(sources.select("sid", "tilt", "mean", "target"), "sid").withColumn("rate", r)
    rated = rated.withColumn("base", F.floor(F.col("rate")).cast("long"))
    due = F.col("n_docs") * (F.col("rate") - F.col("base"))
    ahead = running(rated, due, "_ahead").withColumn(
        "extra",
        F.floor(F.col("_ahead") + due + 0.5) - F.floor(F.col("_ahead") + 0.5),
    ).withColumn("extra", F.greatest(F.lit(0), F.least(F.col("extra"), F.col("n_docs"))).cast("long"))
    ahead = cut(ahead.drop("_ahead"), "mix-cells")
    given = ahead.groupBy("sid").agg(
        F.sum(F.col("size") * (F.col("n_docs") * F.col("base") + F.col("extra"))).alias("_given")
    )
    gap = F.col("target") - F.col("_given")
    open_ = F.when(F.col("size") == 0, 0).when(
        F.col("_gap") > 0, F.when(F.col("base") < cap, F.col("n_docs") - F.col("extra")).otherwise(0)
    ).otherwise(F.col("extra"))
    settled = running(
        ahead.join(given.withColumnRenamed("sid", "_sid"), F.col("sid") == F.col("_sid")).withColumn("_gap", gap)
        .drop("_sid").withColumn("_open", open_),
        (F.col("_open") * F.col("size")).cast("double"), "_used",
    )
    left = F.floor((F.abs("_gap") - F.col("_used")) / F.col("size") + 0.5)
    moved = F.when(F.col("_open") <= 0, 0).otherwise(F.greatest(F.lit(0), F.least(left, F.col("_open"))))
    return settled.select(
        "sid", "size", "salt", "rate", "base",
        (F.col("extra") + F.when(F.col("_gap") > 0, moved).otherwise(-moved)).cast("long").alias("extra"),
    )


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Copies of every document for a mix whose sources have the given share of all words.

    Returns per row of `docs`: doc_id, source, size, source_size, target (of its source), rate,
    copies and taken (copies times size, never above `cap` times size).

    A null source is a source of its own and comes last; a null or blank text has size 0, a rate of
    1 and takes no words; a null doc_id is hashed like any other value; repeated rows are documents
    of their own; no rows give no rows. Other columns of `docs` are not looked at.
    """
    sizes = cut(measure(docs), "mix-sizes")
    salted = sizes.groupBy("source", "size", "salt").agg(F.count(F.lit(1)).alias("n_docs"))
    sources = cut(capped_targets(number_sources(
        salted.groupBy("source", "size").agg(F.sum("n_docs").alias("n_docs")), weights), cap), "mix-sources")
    ids = sources.select("sid", F.col("source").alias("_source"))
    same = F.col("source").eqNullSafe(F.col("_source"))
    cells = cut(salted.join(ids, same).drop("source", "_source"), "mix-salted")
    flat = cut(cells.groupBy("sid", "size").agg(F.sum("n_docs").alias("n_docs")), "mix-flat")
    sources = cut(solve(flat, sources, cap), "mix-solved")
    plan = round_cells(cells, sources, cap)
    place = Window.partitionBy("source", "size", "salt").orderBy(F.xxhash64("doc_id"), "doc_id")
    ranked = sizes.withColumn("_place", F.row_number().over(place))
    facts = plan.join(
        sources.select("sid", F.col("source").alias("_source"), "source_size", "target"), "sid"
    ).select(
        "_source", F.col("size").alias("_size"), F.col("salt").alias("_salt"),
        "source_size", "target", "rate", "base", "extra",
    )
    on = same & (F.col("size") == F.col("_size")) & (F.col("salt") == F.col("_salt"))
    copies = F.col("base") + F.when(F.col("_place") <= F.col("extra"), 1).otherwise(0)
    return ranked.join(facts, on).select(
        "doc_id", "source", "size", "source_size", "target", "rate",
        copies.cast("long").alias("copies"), (copies * F.col("size")).cast("long").alias("taken"),
    )
