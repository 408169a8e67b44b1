"""Points joined with the ranges that hold them, at a cost that grows with what is found."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.session import shared_folder

#: Places listed at once when a range holds very many points.
STRETCH = 10_000


def points_in_ranges(
    points: DataFrame, ranges: DataFrame, by: Sequence[str], at: str, low: str, high: str, ids: Sequence[str],
) -> DataFrame:
    """Columns of `ranges` and, for each point with low <= at < high and the same `by`, those of `points`
    other than `by`. Ranges without points and points without ranges are left out; `ids` name a range.

    Points and range ends are sorted together across the cluster and written to the checkpoint folder.
    The number of points before an end is its place in the order of all points, so a range is two
    places, and most ranges, which hold nothing, are gone before anything is joined. The others list
    the places between and take the points by equality. However many points and ranges share one
    `by`, no pair is looked at that does not belong together.
    """
    shared_folder(points.sparkSession)  # names the checkpoint folder where nothing has yet
    own = [c for c in points.columns if c not in by]
    flat = points.select(*by, F.col(at).alias("_value"), F.lit(1).alias("_point"), F.struct(*own).alias("_own"))
    value = dict(points.dtypes)[at]
    ends = ranges.where(F.col(low) < F.col(high)).select(
        *by, F.explode(F.array(F.col(low).cast(value), F.col(high).cast(value))).alias("_value"), F.lit(0).alias("_point"),
        F.struct(*[c for c in ranges.columns if c not in by]).alias("_range"))
    both = flat.unionByName(ends, allowMissingColumns=True)
    # Ends come before points of the same value. The hash only deals equal ones to several partitions.
    order = [*by, "_value", "_point", F.xxhash64("_own", "_range")]
    placed = both.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftrightunsigned("_at", 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.sum("_point").alias("_held"))
    # One row per sorted partition, so this window and broadcast are bounded by the cluster.
    offsets = counts.select("_part", F.coalesce(
        F.sum("_held").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))
    before = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.withColumn("_part", part).withColumn(
        "_place", F.coalesce(F.sum("_point").over(before), F.lit(0))
    ).join(F.broadcast(offsets), "_part").withColumn("_place", F.col("_place") + F.col("_offset"))
    held = ranked.where("_point = 0").groupBy(*by, *[F.col(f"_range.{c}").alias(f"_id_{c}") for c in ids]).agg(
        F.min("_place").alias("_from"), F.max("_place").alias("_to"), F.first("_range").alias("_range")
    ).where("_from < _to")
    stretches = held.select(*by, "_range", "_to", F.explode(F.sequence("_from", F.col("_to") - 1, F.lit(STRETCH))).alias("_from"))
    listed = stretches.select(*by, "_range.*", F.explode(
        F.sequence("_from", F.least(F.col("_from") + STRETCH - 1, F.col("_to") - 1))).alias("_place"))
    return listed.join(ranked.where("_point = 1").select("_place", "_own.*"), "_place").drop("_place")
