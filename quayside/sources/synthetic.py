"""Invented prices as a pure function of (series, date), generated on the executors."""

from __future__ import annotations

import math
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.catalog import FUTURES, FUTURES_END, UNIT
from quayside.functions.dates import is_business_day
from quayside.functions.numeric import half_even_from_double, uniform_noise

# Fixed values of the generator: its epoch, the day with a negative price and the prices on it.
EPOCH = date(2000, 1, 1)
NEGATIVE_DAY = date(2020, 4, 20)
NEGATIVE_DAY_PRICES = {"RWTC": -8.88, "RBRTE": 22.22}
PAGE_SIZE = 5000


def _noise(series: str, day: Column) -> Column:
    return uniform_noise(F.concat(F.lit(f"{series}|"), day.cast("string")))


def _wti(day: Column) -> Column:
    t = F.date_diff(day, F.lit(EPOCH))
    return F.lit(70) + F.lit(15) * F.sin(t / 200) + F.lit(1.5) * _noise("RWTC", day)


def _price(series: str, day: Column) -> Column:
    """The unrounded price of one series, null where the series has no row."""
    if series in NEGATIVE_DAY_PRICES:
        usual = _wti(day)
        if series == "RBRTE":
            usual = usual + F.lit(4) + F.lit(0.8) * _noise(series, day)
        on_the_day = F.lit(NEGATIVE_DAY_PRICES[series])
        return F.when(day == F.lit(NEGATIVE_DAY), on_the_day).otherwise(usual)
    k = int(FUTURES[series][1:])
    angle = F.lit(2 * math.pi) * F.month(day) / 12
    log_spread = F.lit(0.004 * k) + F.lit(0.003 * k) * F.cos(angle)
    value = F.abs(_wti(day)) * F.exp(log_spread) * (F.lit(1) + F.lit(0.002) * _noise(series, day))
    return F.when(day <= F.lit(FUTURES_END), value)


def synthetic_prices(days: DataFrame, series_ids) -> DataFrame:
    """(series_id, observation_date, price) for every business day in `days`, a table of distinct
    `observation_date` values. Prices are a pure function of (series, date)."""
    day = F.col("observation_date")
    cells = F.array(*[
        F.struct(F.lit(s).alias("series_id"), _price(s, day).alias("value"))
        for s in sorted(series_ids)
    ])
    return (
        days.filter(is_business_day(day))
        .select(day, F.inline(cells))
        .filter("value is not null")
        .select(
            "series_id", day,
            half_even_from_double(F.col("value"), 2).cast("decimal(18,6)").alias("price"),
        )
    )


def synthetic_history(
    spark: SparkSession,
    series_ids,
    start: date,
    end: date,
    overrides: DataFrame | None = None,
    omit: DataFrame | None = None,
) -> DataFrame:
    """`synthetic_prices` over [start, end], with the source's misbehaviour for tests and demos.

    `overrides` (series_id, observation_date, price) replaces or adds rows; `omit` (series_id,
    observation_date) drops rows the source is to be missing.
    """
    days = spark.range(max((end - start).days + 1, 0)).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("observation_date")
    )
    history = synthetic_prices(days, series_ids)
    in_range = F.col("series_id").isin(list(series_ids)) & F.col("observation_date").between(
        F.lit(start), F.lit(end)
    )
    if overrides is not None:
        history = override_prices(history, overrides.filter(in_range))
    return history if omit is None else omit_prices(history, omit)


def override_prices(history: DataFrame, overrides: DataFrame) -> DataFrame:
    """Replace or add the overridden (series, date) prices."""
    key = ["series_id", "observation_date"]
    new = overrides.select(*key, F.col("price").cast("decimal(18,6)").alias("_price"))
    return history.join(new, key, "full_outer").select(
        *key, F.coalesce("_price", "price").alias("price")
    )


def omit_prices(history: DataFrame, omit: DataFrame) -> DataFrame:
    key = ["series_id", "observation_date"]
    return history.join(omit.select(*key), key, "left_anti")


def synthetic_pages(
    history: DataFrame, *, request_id: str, route: str, retrieved_at, source: str = "synthetic",
    value: Column | None = None, page_size: int = PAGE_SIZE,
) -> DataFrame:
    """Lay one request's history out as API pages of `page_size` rows sorted by (period, series).

    `value` is the raw value column, text by default; tests use it to inject malformed values.
    One request covers a handful of series over a date window, so its rows are bounded by the
    calendar.
    """
    from quayside.functions.scans import dense_sequence

    cents = F.col("price").cast("decimal(18,2)")
    exact = F.when(cents == F.col("price"), cents.cast("string")).otherwise(
        F.col("price").cast("string")
    )
    raw = exact if value is None else value
    row = F.struct(
        F.col("observation_date").cast("string").alias("period"),
        F.col("series_id").alias("series"),
        raw.alias("value"),
        F.lit(UNIT).alias("units"),
    )
    numbered = dense_sequence(
        history.select("observation_date", "series_id", row.alias("row")),
        ["observation_date", "series_id"], "n",
    )
    total = numbered.groupBy(F.lit(request_id).alias("request")).agg(F.max("n").alias("total"))
    counted = numbered.withColumn("request", F.lit(request_id)).join(F.broadcast(total), "request")
    cell = F.struct("n", "row")
    return (
        counted.groupBy(
            (F.floor((F.col("n") - 1) / page_size) + 1).cast("int").alias("page_no"), "total"
        )
        .agg(F.transform(F.array_sort(F.collect_list(cell)), lambda c: c["row"]).alias("data"))
        .select(
            F.lit(source).alias("source"), F.lit(request_id).alias("request_id"), "page_no",
            F.lit(route).alias("route"),
            F.create_map(
                F.lit("offset"), ((F.col("page_no") - 1) * page_size).cast("string"),
                F.lit("length"), F.lit(str(page_size)),
            ).alias("params"),
            F.lit(retrieved_at).cast("timestamp").alias("retrieved_at"),
            F.to_json(F.struct(F.struct(
                F.col("total").cast("string").alias("total"), F.lit("daily").alias("frequency"),
                F.col("data"),
            ).alias("response"))).alias("body"),
        )
        .withColumn("sha256", F.sha2("body", 256))
    )
