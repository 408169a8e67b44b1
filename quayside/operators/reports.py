"""Analytic and serving reads over curve points, observations, revisions and run records.

`by` names tenant columns (such as `source`) for tables that hold many stores; it is empty for a
single store.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.errors import QuaysideError
from quayside.functions.dates import age_days, month_key
from quayside.operators.curves import position_order
from quayside.schemas import CURVE_KEY, MONITORED, conform

def _ok() -> Column:
    return F.col("status") == "ok"


def latest_complete_curve(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per curve, the points with a price on its newest date that has any.

    Each position first keeps its newest priced point (combined before the shuffle). A curve then
    has at most five of them, and those on the curve's newest date are the answer.
    """
    newest = (
        points.filter(_ok())
        .groupBy(*by, "curve_id", "position")
        .agg(F.max("as_of_date").alias("as_of_date"), F.max_by("price", "as_of_date").alias("price"))
    )
    whole = Window.partitionBy(*by, "curve_id")
    return (
        newest.withColumn("_newest", F.max("as_of_date").over(whole))
        .filter("as_of_date = _newest")
        .select(*by, "curve_id", "as_of_date", "position", "price")
    )


def latest_points(
    points: DataFrame, today: Column | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Per curve and position, the point at its own latest date, gaps included, with its age."""
    rest = [c for c in points.columns if c not in (*by, *CURVE_KEY)]
    newest = points.groupBy(*by, "curve_id", "position").agg(
        F.max_by(F.struct("as_of_date", *rest), "as_of_date").alias("p")
    )
    flat = newest.select(*by, "curve_id", "position", "p.*")
    return flat if today is None else flat.withColumn(
        "data_age_days", age_days(F.col("as_of_date"), today)
    )


def grouped_latest(points: DataFrame, today: Column, by: Sequence[str] = ()) -> DataFrame:
    """`latest_points` as one row per curve, its points an array in display order.

    A curve has five positions, so the array is bounded. `as_of` is the newest date among them.
    """
    flat = latest_points(points, today, by)
    cell = F.struct(
        position_order().alias("_order"), "position", F.col("as_of_date").alias("as_of"),
        F.col("price").cast("string").alias("price"), "status", "gap_reason", "data_age_days",
    )
    curves = flat.groupBy(*by, "curve_id", "kind").agg(
        F.max("as_of_date").alias("as_of"), F.array_sort(F.collect_list(cell)).alias("points")
    )
    return curves.select(
        *by, "curve_id", "kind", "as_of", age_days(F.col("as_of"), today).alias("data_age_days"),
        F.transform("points", lambda p: p.dropFields("_order")).alias("points"),
    )


def spread_by_position(
    points: DataFrame, long: str = "BRENT", short: str = "WTI", by: Sequence[str] = ()
) -> DataFrame:
    """`long` minus `short` on every date and position where both have a price.

    The two legs meet in one grouped pass; a self-join would scan and shuffle the table twice.
    """
    leg = lambda c: F.max(F.when(F.col("curve_id") == c, F.col("price")))
    return (
        points.filter(_ok() & F.col("curve_id").isin(long, short))
        .groupBy(*by, "as_of_date", "position")
        .agg(leg(long).alias("_long"), leg(short).alias("_short"))
        .filter("_long is not null and _short is not null")
        .select(*by, "as_of_date", "position", (F.col("_long") - F.col("_short"))
                .cast("decimal(18,4)").alias("spread"))
    )


def contango_days(
    points: DataFrame, near: str = "Spot", far: str = "C4", by: Sequence[str] = (),
    report: Sequence[str] | None = None,
) -> DataFrame:
    """Per outright curve, the days `far` is above `near` (contango) and below (backwardation).

    Ties count in neither. `report` names the columns to report by, `by` and the curve if absent.
    """
    at = lambda p: F.max(F.when(F.col("position") == p, F.col("price")))
    days = (
        points.filter(_ok() & (F.col("kind") == "outright") & F.col("position").isin(near, far))
        .groupBy(*by, "curve_id", "as_of_date")
        .agg(at(near).alias("near"), at(far).alias("far"))
        .filter("near is not null and far is not null")
    )
    return days.groupBy(*(report if report is not None else [*by, "curve_id"])).agg(
        F.count_if(F.col("far") > F.col("near")).alias("contango_days"),
        F.count_if(F.col("far") < F.col("near")).alias("backwardation_days"),
    )


def revisions_per_month(revisions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return revisions.groupBy(
        *by, month_key(F.col("observation_date")).alias("month"), "series_id"
    ).agg(F.count(F.lit(1)).alias("revisions"))


def month_percent_rank(
    points: DataFrame, curve_id: str = "WTI", by: Sequence[str] = ()
) -> DataFrame:
    """Where each price stands among its position's prices of the same month, 0 lowest, 1 highest.

    A position has one point per day, so a window holds at most 31 rows.
    """
    month = Window.partitionBy(
        *by, "curve_id", "position", month_key(F.col("as_of_date"))
    ).orderBy("price")
    return points.filter(_ok() & (F.col("curve_id") == curve_id)).select(
        *by, "curve_id", "position", "as_of_date", "price",
        F.percent_rank().over(month).alias("month_percent_rank"),
    )


def _between(column: str, start: date | None, end: date | None) -> Column:
    if start and end and start > end:
        raise QuaysideError("start is after end")
    bounds = F.lit(True)
    if start:
        bounds = bounds & (F.col(column) >= F.lit(start))
    if end:
        bounds = bounds & (F.col(column) <= F.lit(end))
    return bounds


def curve_history(
    points: DataFrame, curve_id: str, position: str, start: date | None = None,
    end: date | None = None, by: Sequence[str] = (),
) -> DataFrame:
    """One curve position over time; a null bound is open."""
    chosen = (F.col("curve_id") == curve_id) & (F.col("position") == position)
    return points.filter(chosen & _between("as_of_date", start, end)).select(
        *by, F.col("as_of_date").alias("as_of"), "price", "status", "gap_reason", "estimate_type"
    )


def price_history(
    current: DataFrame, series_id: str, start: date | None = None, end: date | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """One observed series over time; a null bound is open."""
    chosen = F.col("series_id") == series_id
    return current.filter(chosen & _between("observation_date", start, end)).select(
        *by, F.col("observation_date").alias("date"), "price", "unit", "last_seen_at"
    )


def is_known(df: DataFrame, column: str, value: str) -> bool:
    return not df.filter(F.col(column) == value).limit(1).isEmpty()


def as_text(df: DataFrame) -> DataFrame:
    """Decimals as exact strings and dates in ISO form, as the read API shows them."""
    shown = ("decimal", "date", "timestamp")
    return df.select([
        F.col(n).cast("string").alias(n) if t.split("(")[0] in shown else F.col(n)
        for n, t in df.dtypes
    ])


def current_version(versions: DataFrame) -> DataFrame:
    return versions.orderBy(F.col("dataset_version").desc()).limit(1)


def status_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("status").agg(F.count(F.lit(1)).alias("records"))


def problem_attempts(attempts: DataFrame, limit: int = 100) -> DataFrame:
    """The newest `limit` failed or quarantined attempts."""
    return (
        attempts.filter(F.col("status").isin("failed", "quarantined"))
        .orderBy(F.col("finished_at").desc(), "attempt_id")
        .limit(limit)
    )


def dead_events(outbox: DataFrame, limit: int = 100) -> DataFrame:
    return (
        outbox.filter(F.col("status") == "dead")
        .orderBy("dataset_version", "event_id").limit(limit)
        .select("event_id", "event_type", "dataset_version", "attempts", "last_error",
                "processed_at")
    )


def health(versions: DataFrame, attempts: DataFrame, outbox: DataFrame) -> dict[str, DataFrame]:
    """The five tables of the health page."""
    return {
        "versions": versions.orderBy(F.col("dataset_version").desc()),
        "attempt_counts": status_counts(attempts),
        "problem_attempts": problem_attempts(attempts),
        "outbox_counts": status_counts(outbox),
        "dead_events": dead_events(outbox),
    }


def monitored_values(
    points: DataFrame, version: int, by: Sequence[str] = ()
) -> DataFrame:
    """What a version's alerts are judged by: its latest point per curve and position."""
    newest = latest_points(points, by=by).withColumn(
        "dataset_version", F.lit(version).cast("bigint")
    )
    if by:
        return newest.select(*by, *MONITORED.names)
    return conform(newest, MONITORED)
