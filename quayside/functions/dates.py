"""Business-day arithmetic and strict date parsing, as column expressions."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_MONDAY = "1970-01-05"


def _weekdays_until(day: Column) -> Column:
    """Weekdays from a fixed Monday up to and including `day`; differences count weekdays."""
    n = F.date_diff(day, F.lit(_MONDAY).cast("date"))
    return F.floor(n / 7) * 5 + F.least(F.pmod(n, F.lit(7)) + 1, F.lit(5))


def business_days_after(start: Column, end: Column) -> Column:
    """Weekdays in (start, end], 0 when end is not after start. Holidays are not modelled."""
    return F.greatest(F.lit(0), _weekdays_until(end) - _weekdays_until(start)).cast("int")


def is_business_day(day: Column) -> Column:
    return F.weekday(day) < 5


def business_days(spark: SparkSession, start, end) -> DataFrame:
    """Every weekday in [start, end] as `day`, spread over the cluster."""
    days = max((end - start).days + 1, 0)
    return (
        spark.range(days)
        .select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("day"))
        .filter(is_business_day(F.col("day")))
    )


def age_days(as_of: Column, today: Column) -> Column:
    return F.date_diff(today, as_of)


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def iso_date(text: Column) -> Column:
    """The date that an ISO 8601 calendar date names, `2024-01-31` or `20240131`, else null.

    Spark's own cast also takes `2024-1-1` and timestamps, so the form is checked first.
    """
    plain = F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), text)
    basic = F.when(
        text.rlike(r"^[0-9]{8}\z"),
        F.concat_ws("-", text.substr(1, 4), text.substr(5, 2), text.substr(7, 2)),
    )
    found = F.coalesce(plain, basic)
    return F.when(~found.startswith("0000"), found.try_cast("date"))


def iso_week_date(text: Column) -> Column:
    """The date that an ISO 8601 week date names, such as `2024-W05-3`, else null."""
    year, week = text.substr(1, 4).try_cast("int"), text.substr(7, 2).try_cast("int")
    fourth = F.make_date(year, F.lit(1), F.lit(4))  # always in week 1
    days = (week - 1) * 7 + text.substr(10, 1).try_cast("int") - 1
    day = F.date_add(F.date_sub(fourth, F.weekday(fourth)), days)
    # A 53rd week that the year does not have would come out as week 1 of the next year.
    form = text.rlike(r"^[0-9]{4}-W[0-5][0-9]-[1-7]\z") & (year > 0)
    return F.when(form & (F.weekofyear(day) == week), day)
