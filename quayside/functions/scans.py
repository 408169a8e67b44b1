"""Aggregates and ordered scans that stay spread out when one group holds most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.session import shared_folder

SKETCH_ACCURACY = 10_000
BRACKET = 4 / SKETCH_ACCURACY
CHUNK = 100_000
#: Parts into which a selection cuts a bracket, and passes after which it is taken as it is.
BINS, PASSES = 1000, 20


def exact_median(
    df: DataFrame, by: Sequence[str], value: str, *, few_groups: bool = False,
    accuracy: int = SKETCH_ACCURACY, bracket: float = BRACKET, keep: int = CHUNK,
) -> DataFrame:
    """The exact median and row count per group: columns `by`, `median`, `n`.

    Spark's own `median` keeps every distinct value of a group in one task. Here a sketch first
    brackets the middle of each group. One counted pass then keeps single values only inside the
    bracket (0.08 % of the rows) and one total below and one above it, combined before the
    shuffle. The middle ranks are read from those exact counts. Groups whose middle the sketch
    missed are bracketed anew by counting (`_selected`) until at most `keep` rows are inside, so the
    result is exact for any distribution. Groups of null keys are one group, null values are left out.

    `few_groups` says that the number of groups is bounded by design, so the brackets can be
    broadcast; otherwise Spark decides from their measured size.
    """
    shared_folder(df.sparkSession)  # names the checkpoint folder where nothing has yet
    rows = df.select(*by, F.col(value).alias("_v")).filter("_v is not null")
    low_high = F.percentile_approx("_v", [0.5 - bracket, 0.5 + bracket], F.lit(accuracy))
    brackets = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), low_high.alias("_q")).select(
        *by, "n", F.col("_q")[0].alias("_low"), F.col("_q")[1].alias("_high"))
    found = _middles(rows, by, brackets, few_groups).checkpoint()
    whole = F.col("_lower").isNotNull() & F.col("_upper").isNotNull()
    missed = found.filter(~whole).select(*by, "n")
    if not missed.isEmpty():
        again = _middles(rows, by, _selected(rows, by, missed, keep), few_groups)
        found = found.filter(whole).unionByName(again)
    return found.select(*by, ((F.col("_lower") + F.col("_upper")) / 2).alias("median"), "n")


def _with(rows: DataFrame, groups: DataFrame, by: Sequence[str], few_groups: bool = False) -> DataFrame:
    """Rows with the columns of their group; null keys meet each other."""
    named = groups.select(*[F.col(c).alias(f"_by_{c}") for c in by], *[c for c in groups.columns if c not in by])
    same = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
    joined = rows.join(F.broadcast(named) if few_groups else named, same or F.lit(True))
    return joined.drop(*[f"_by_{c}" for c in by])


def _ranks() -> tuple[Column, Column]:
    """A group of n rows has its middle at ranks (n+1) div 2 and n div 2 + 1, the same one if odd."""
    return F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1


def _middles(rows: DataFrame, by: Sequence[str], brackets: DataFrame, few_groups: bool) -> DataFrame:
    """`by`, n and the values at both middle ranks, null where a rank is outside the bracket."""
    v = F.col("_v")
    side = F.when(v < F.col("_low"), 0).when(v > F.col("_high"), 2).otherwise(1)
    counted = (
        _with(rows, brackets, by, few_groups)
        .withColumn("_side", side)
        .withColumn("_value", F.when(F.col("_side") == 1, v))
        .groupBy(*by, "_side", "_value")
        .agg(F.count(F.lit(1)).alias("_count"), F.first("n").alias("n"))
    )
    upto = Window.partitionBy(*by).orderBy("_side", "_value")
    ranked = counted.withColumn("_upto", F.sum("_count").over(upto))
    start = F.col("_upto") - F.col("_count")
    covers = lambda rank: (start < rank) & (F.col("_upto") >= rank)
    lower, upper = _ranks()
    return ranked.groupBy(*by).agg(
        F.max(F.when(covers(lower), F.col("_value"))).alias("_lower"),
        F.max(F.when(covers(upper), F.col("_value"))).alias("_upper"),
        F.first("n").alias("n"),
    )


def _selected(rows: DataFrame, by: Sequence[str], groups: DataFrame, keep: int) -> DataFrame:
    """Brackets (`by`, n, _low, _high) that hold both middle ranks of `groups` (`by`, n) for certain.

    Each pass cuts a group's bracket into `BINS` equal parts, counts them, and goes on with the parts that
    hold the ranks, until at most `keep` rows or a single value are inside. Whatever the values, a
    pass leaves a group one row per part.
    """
    edges = _with(rows, groups, by).groupBy(*by).agg(
        F.first("n").alias("n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"),
        F.lit(0).cast("bigint").alias("_below"), F.count(F.lit(1)).alias("_inside")).checkpoint()
    lower, upper = _ranks()
    for _ in range(PASSES):
        if edges.filter((F.col("_inside") > keep) & (F.col("_low") < F.col("_high"))).isEmpty():
            break
        inside = _with(rows, edges, by).filter((F.col("_v") >= F.col("_low")) & (F.col("_v") <= F.col("_high")))
        width = (F.col("_high").cast("double") - F.col("_low").cast("double")) / BINS
        place = F.when(width > 0, F.floor((F.col("_v").cast("double") - F.col("_low").cast("double")) / width)).otherwise(0)
        bins = inside.groupBy(*by, F.least(place, F.lit(BINS - 1)).alias("_bin")).agg(
            F.count(F.lit(1)).alias("_count"), F.min("_v").alias("_least"), F.max("_v").alias("_most"),
            F.first("n").alias("n"), F.first("_below").alias("_below"))
        upto = Window.partitionBy(*by).orderBy("_bin")
        ranked = bins.withColumn("_upto", F.col("_below") + F.sum("_count").over(upto))
        held = (F.col("_upto") >= lower) & (F.col("_upto") - F.col("_count") < upper)
        edges = ranked.filter(held).groupBy(*by).agg(
            F.first("n").alias("n"), F.min("_least").alias("_low"), F.max("_most").alias("_high"),
            F.min(F.col("_upto") - F.col("_count")).alias("_below"), F.sum("_count").alias("_inside")).checkpoint()
    return edges.select(*by, "n", "_low", "_high")


def carried_last(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    values: Sequence[str],
    valid: Column,
    into: str,
    chunk: int = CHUNK,
) -> DataFrame:
    """Add `into`: a struct of `order` and `values` from the latest earlier valid row of the key.

    It answers `last(..., ignorenulls) over (partition by keys order by order rows before)`, but
    a key is cut into chunks of `chunk` order values. Each chunk is scanned on its own and takes
    what the chunks before it carry, of which there is one row per chunk. `order` is a whole
    number, unique within the key.
    """
    packed = F.struct(order, *values)
    cut = df.withColumn("_chunk", F.floor(F.col(order) / F.lit(chunk)))
    tails = cut.groupBy(*keys, "_chunk").agg(F.max(F.when(valid, packed)).alias("_tail"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    across = before(Window.partitionBy(*keys).orderBy("_chunk"))
    carry = tails.select(
        *keys, "_chunk", F.last("_tail", ignorenulls=True).over(across).alias("_carry")
    )
    inside = before(Window.partitionBy(*keys, "_chunk").orderBy(order))
    scanned = cut.withColumn(
        "_inside", F.last(F.when(valid, packed), ignorenulls=True).over(inside)
    )
    return (
        scanned.join(carry, [*keys, "_chunk"])
        .withColumn(into, F.coalesce("_inside", "_carry"))
        .drop("_chunk", "_inside", "_carry")
    )


def dense_sequence(df: DataFrame, order: Sequence[str], into: str, start: int = 0) -> DataFrame:
    """Number all rows start+1, start+2, ... in `order` without bringing them to one task.

    The rows are sorted across the cluster and written to the checkpoint folder, because the
    numbering reads them twice and both reads must see the same partitions. One count per
    partition then turns positions within partitions into positions in the table.
    """
    shared_folder(df.sparkSession)  # names the checkpoint folder where nothing has yet
    placed = (
        df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()).checkpoint()
    )
    part = F.shiftrightunsigned("_place", 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per sorted partition, so this window and broadcast are bounded by the cluster.
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(into, F.lit(start) + F.col("_offset") + inside + 1)
        .drop("_part", "_offset", "_place")
    )
