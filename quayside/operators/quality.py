"""The quality gate: completeness across the series of a request, staleness and rejections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.dates import business_days_after
from quayside.functions.joins import lookup, per_salt, salted

# When a series counts as incomplete, and when a warning is due.
INCOMPLETE_MIN_DAYS, INCOMPLETE_SHARE = 3, 0.10
STALE_BUSINESS_DAYS = 5
#: Tasks over which the requests of one series and month are dealt; a month of a series is one number.
MONTH_SALTS = 8


def _days(column: Column | str) -> Column:
    """The day of a date as one bit of its month."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.dayofmonth(column) - 1)


def _days_upto(day: Column, month: Column) -> Column:
    """All days of a month (numbered year * 12 + month) up to a date, as bits."""
    own = _month(day)
    upto = F.call_function("shiftleft", F.lit(1).cast("long"), F.dayofmonth(day)) - 1
    nothing = F.lit(0).cast("long")
    return F.when(month < own, F.lit((1 << 31) - 1).cast("long")).when(month == own, upto).otherwise(nothing)


def _month(day: Column | str) -> Column:
    # Never null, so no null check on it is pushed down into the parsing of dates.
    return F.coalesce(F.year(day) * 12 + F.month(day), F.lit(0))


def completeness(
    silver: DataFrame, requests: DataFrame, catalog: DataFrame, by: tuple[str, ...] = ()
) -> DataFrame:
    """Every requested series with its evidence, judged within its request.

    Evidence is the dates, inside the series' active period, on which another series of the
    request has data. The days of a month are the bits of one number: a series' month is the OR of
    its days, combined before the shuffle, and evidence is counted from the bits that two series or
    another series have. Requests meet months, not dates, so no date lists and no pairs of series
    are formed, and requests that ask for the same month are spread over many tasks.

    `by` names tenant columns (such as `source`) when many stores are judged at once.
    """
    key = [*by, "request_id"]
    until = F.least("end", F.coalesce("discontinued", "end"))
    wanted = requests.filter(F.size("series_ids") >= 2).withColumn("series_id", F.explode(F.array_distinct("series_ids")))
    ends = catalog.select("series_id", "discontinued")
    wanted = lookup(wanted, ends, ["series_id"], key).withColumn("until", until)
    held = silver.groupBy(*by, "series_id", _month("observation_date").alias("_month")).agg(
        F.bit_or(_days("observation_date")).alias("_held"))
    # A request's series and months; a month's window are its days from `start` to `end`.
    month = F.col("_month")
    months = wanted.filter("start <= end").select(
        *key, "series_id", "start", "end", "until", F.explode(F.sequence(_month("start"), _month("end"))).alias("_month"))
    window = _days_upto(F.col("end"), month).bitwiseAND(F.bitwise_not(_days_upto(F.date_sub("start", 1), month)))
    asked = salted(months, ["request_id"], MONTH_SALTS).join(
        per_salt(held, MONTH_SALTS), [*by, "series_id", "_month", "_salt"])
    found = asked.select(
        *key, "_month", F.struct(
            "series_id", F.col("_held").bitwiseAND(window).alias("own")).alias("_series"))
    # One number per series of the request, which the request itself names.
    together = found.groupBy(*key, "_month").agg(F.collect_list("_series").alias("_all"))
    masks = F.transform("_all", lambda s: s["own"])
    nothing = F.lit(0).cast("long")
    seen = F.aggregate(
        masks, F.struct(nothing.alias("once"), nothing.alias("twice")),
        lambda acc, own: F.struct(
            acc["once"].bitwiseOR(own).alias("once"),
            acc["twice"].bitwiseOR(acc["once"].bitwiseAND(own)).alias("twice")))
    shared = together.select(*key, "_month", seen.alias("_seen"), "_all")
    mine = F.get(F.filter("_all", lambda s: s["series_id"] == F.col("series_id")), F.lit(0))
    own = F.coalesce(mine["own"], nothing)
    days = months.join(shared, [*key, "_month"]).withColumn("own", own)
    others = F.col("_seen.twice").bitwiseOR(F.col("_seen.once").bitwiseAND(F.bitwise_not("own")))
    evidence = others.bitwiseAND(_days_upto(F.col("until"), month))
    counted = days.groupBy(*key, "series_id").agg(
        F.sum(F.bit_count("own")).alias("own_days"), F.sum(F.bit_count(evidence)).alias("evidence"),
        F.sum(F.bit_count(evidence.bitwiseAND(F.bitwise_not("own")))).alias("missing"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return wanted.select(*key, "series_id").join(counted, [*key, "series_id"], "left").select(
        *key, "series_id", zero("own_days"), zero("evidence"), zero("missing"))


def completeness_issues(judged: DataFrame) -> DataFrame:
    """The incomplete series among `completeness` rows, with the message shown to users."""
    allowed = F.greatest(
        F.lit(float(INCOMPLETE_MIN_DAYS)), F.lit(INCOMPLETE_SHARE) * F.col("evidence")
    )
    absent = (F.col("own_days") == 0) & (F.col("evidence") >= INCOMPLETE_MIN_DAYS)
    message = F.format_string(
        "%s: no rows on %d of %d dates with data from other requested series",
        "series_id", "missing", "evidence",
    )
    return judged.filter(
        (F.col("evidence") > 0) & ((F.col("missing") > allowed) | absent)
    ).withColumn("message", message)


def last_observations(
    known: DataFrame, requests: DataFrame, catalog: DataFrame, by: tuple[str, ...] = ()
) -> DataFrame:
    """Per requested series: its last date, how many business days it lags and a warning text.

    `known` is current observations together with the batch. The expected date is the end of the
    latest request of the run, or the series' last published date when that is earlier.
    """
    ends = requests.groupBy(*by).agg(F.max("end").alias("window_end"))
    asked = requests.select(*by, F.explode("series_ids").alias("series_id")).distinct()
    asked = (
        asked.join(ends, list(by)) if by
        else asked.withColumn("_run", F.lit(1)).join(  # one row, the end of this run
            F.broadcast(ends.withColumn("_run", F.lit(1))), "_run")
    )
    newest = known.groupBy(*by, "series_id").agg(F.max("observation_date").alias("last"))
    until = catalog.select("series_id", "discontinued")
    joined = lookup(asked, until, ["series_id"], ["window_end", *by]).join(
        newest, [*by, "series_id"], "left"
    )
    expected = F.least("window_end", F.coalesce("discontinued", "window_end"))
    lag = F.when(F.col("last").isNotNull(), business_days_after(F.col("last"), expected))
    warning = F.when(
        F.col("last").isNull(), F.concat("series_id", F.lit(": no observations yet"))
    ).when(
        lag > STALE_BUSINESS_DAYS,
        F.format_string("%s: last observation %s, %d business days old", "series_id",
                        F.col("last").cast("string"), lag),
    )
    return joined.select(*by, "series_id", "last", lag.alias("lag"), warning.alias("warning"))


def rejection_counts(rejected: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return rejected.groupBy(*by, "reason").agg(F.count(F.lit(1)).alias("rows"))


def quality_tables(
    silver: DataFrame, current: DataFrame, requests: DataFrame, catalog: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(series, issues): the last observation and warning of every requested series, and the
    incomplete series. `current` needs only (series_id, observation_date)."""
    key = ["series_id", "observation_date"]
    known = current.select(*key).unionByName(silver.select(*key))
    issues = completeness_issues(completeness(silver, requests, catalog))
    return last_observations(known, requests, catalog), issues


def quality_lines(
    rejected: DataFrame, series: DataFrame, issues: DataFrame, by: tuple[str, ...] = ()
) -> DataFrame:
    """The whole quality report as rows: kind, subject, text and rows.

    There is one line per distinct rejection reason with the rows it met, per series with its last
    observation, per warning and per incomplete series of a request.
    """
    line = lambda kind, subject, text, rows=F.lit(None).cast("long"): (
        *by, F.lit(kind).alias("kind"), subject.alias("subject"), text.alias("text"), rows.alias("rows")
    )
    nobody = F.lit(None).cast("string")
    parts = [
        rejection_counts(rejected, by).select(*line("reason", nobody, F.col("reason"), F.col("rows"))),
        series.filter("last is not null").select(
            *line("last observation", F.col("series_id"), F.col("last").cast("string"))),
        series.filter("warning is not null").select(
            *line("warning", F.col("series_id"), F.col("warning"))),
        issues.select(*line(
            "incomplete", F.concat_ws("/", "request_id", "series_id"), F.col("message"), F.col("missing"))),
    ]
    return reduce(DataFrame.unionByName, parts)


def quality_report(silver: DataFrame, rejected: DataFrame, lines: DataFrame) -> dict:
    """The verdict on one run with exact counts; `quality_lines` holds what they count."""
    kinds = {r["kind"]: r["count"] for r in lines.groupBy("kind").count().collect()}  # four kinds
    accepted, refused = silver.count(), rejected.count()
    held = refused or kinds.get("incomplete", 0)
    return {
        "status": "quarantined" if held else "passed",
        "accepted": accepted,
        "rejected": refused,
        "incomplete_series": kinds.get("incomplete", 0),
        "reasons": kinds.get("reason", 0),
        "warnings": kinds.get("warning", 0),
        "series": kinds.get("last observation", 0),
    }


def single_source(df: DataFrame, limit: int = 2) -> list[str]:
    """Up to `limit` distinct sources of a table; more than one is refused by the callers."""
    return sorted(r["source"] for r in df.select("source").distinct().limit(limit).collect())
