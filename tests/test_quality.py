from datetime import date, datetime

from pyspark.sql import functions as F

from quayside.catalog import series_catalog
from quayside.operators import quality
from quayside.schemas import REQUEST
from quayside.sources.synthetic import synthetic_history
from tests.support import JANUARY, OMIT, SPOT, request, silver

AT = datetime(2026, 3, 1)


def messages(spark, window, omit, series=SPOT, requests=None):
    history = synthetic_history(
        spark, series, *window, omit=spark.createDataFrame(omit, OMIT) if omit else None)
    batch = silver(spark, [tuple(r) for r in history.collect()], AT)
    asked = requests if requests is not None else request(spark, window, series)
    judged = quality.completeness(batch, asked, series_catalog(spark))
    return [r["message"] for r in quality.completeness_issues(judged).orderBy("series_id").collect()]


def brent(*days, month=1):
    return [("RBRTE", date(2024, month, d)) for d in days]


def test_a_missing_or_cut_series_is_incomplete(spark):
    assert messages(spark, JANUARY, brent(*range(1, 32))) == [
        "RBRTE: no rows on 23 of 23 dates with data from other requested series"]
    assert messages(spark, JANUARY, brent(*range(16, 32))) == [
        "RBRTE: no rows on 12 of 23 dates with data from other requested series"]
    assert len(messages(spark, JANUARY, brent(2, 9, 16, 23))) == 1


def test_holidays_are_not_incomplete(spark):
    assert messages(spark, JANUARY, brent(1, 15, 26)) == []
    assert messages(spark, (date(2024, 12, 23), date(2024, 12, 27)), brent(25, 26, month=12)) == []


def test_short_windows_need_three_dates_of_evidence(spark):
    three = (date(2024, 1, 2), date(2024, 1, 4))
    assert len(messages(spark, three, brent(2, 3, 4))) == 1
    assert messages(spark, (date(2024, 1, 2), date(2024, 1, 3)), brent(2, 3)) == []
    assert messages(spark, (date(2024, 2, 3), date(2024, 2, 4)), []) == []


def test_discontinued_series_are_not_expected(spark):
    futures = ("RCLC1", "RCLC2", "RCLC3", "RCLC4")
    assert messages(spark, (date(2024, 3, 1), date(2024, 6, 30)), [], futures) == []


def test_only_rows_of_the_same_request_are_evidence(spark):
    two = spark.createDataFrame(
        [("a", ["RWTC"], *JANUARY), ("b", ["RBRTE"], *JANUARY)], REQUEST)
    assert messages(spark, JANUARY, brent(*range(1, 32)), requests=two) == []


def test_evidence_matches_pairwise_brute_force(spark):
    import random

    rng, names = random.Random(7), ["RWTC", "RBRTE", "RCLC1", "RCLC2"]
    days = [date(2024, 3, d) for d in range(1, 32)] + [date(2024, 4, d) for d in range(1, 20)]
    rows = [(s, d, "1") for s in names for d in days if rng.random() < 0.4]
    asks = [("all", names, days[0], days[-1]), ("pair", names[1:3], date(2024, 3, 20), date(2024, 4, 15))]
    got = {(r["request_id"], r["series_id"]): (r["own_days"], r["evidence"], r["missing"])
           for r in quality.completeness(silver(spark, rows, AT), spark.createDataFrame(asks, REQUEST),
                                         series_catalog(spark)).collect()}
    has = {s: {d for q, d, _ in rows if q == s} for s in names}
    for rid, series, start, end in asks:
        for s in series:
            until = min(end, date(2024, 4, 5)) if s.startswith("RCLC") else end
            own = {d for d in has[s] if start <= d <= end}
            others = {d for o in series if o != s for d in has[o] if start <= d <= until}
            assert got[rid, s] == (len(own), len(others), len(others - own)), (rid, s)


def test_windows_that_cut_months_and_series_named_twice(spark):
    batch = silver(spark, [("RWTC", date(2024, 1, d), "1") for d in (1, 15, 31)] + [("RBRTE", date(2024, 2, d), "1") for d in (1, 29)], AT)
    asks = [("cut", ["RWTC", "RBRTE", "RWTC"], date(2024, 1, 15), date(2024, 2, 28)),
            ("none", ["RWTC", "RBRTE"], date(2024, 3, 1), date(2024, 2, 1)), ("one", ["RWTC"], *JANUARY)]
    got = quality.completeness(batch, spark.createDataFrame(asks, REQUEST), series_catalog(spark))
    assert sorted(tuple(r) for r in got.collect()) == [
        ("cut", "RBRTE", 1, 2, 2), ("cut", "RWTC", 2, 1, 1), ("none", "RBRTE", 0, 0, 0), ("none", "RWTC", 0, 0, 0)]


def test_a_series_asked_for_by_very_many_requests_is_spread(spark):
    """20,000 requests for one month: no task gets more than a few times the median of the rows."""
    batch = silver(spark, [(s, date(2024, 1, d), "1") for s in SPOT for d in range(2, 12)], AT)
    asks = spark.range(20_000).select(
        F.concat(F.lit("r"), "id").alias("request_id"), F.array(*map(F.lit, SPOT)).alias("series_ids"),
        F.lit(JANUARY[0]).alias("start"), F.lit(JANUARY[1]).alias("end"))
    judged = quality.completeness(batch, asks, series_catalog(spark))
    assert judged.count() == 40_000 and judged.filter("own_days <> 10 or missing <> 0").count() == 0
    dealt = quality.salted(asks, ["request_id"], quality.MONTH_SALTS).groupBy("_salt").count().collect()
    assert len(dealt) == quality.MONTH_SALTS and max(r["count"] for r in dealt) < 2 * 20_000 / quality.MONTH_SALTS


def test_staleness_warnings_and_report(spark):
    batch = silver(spark, [("RWTC", date(2024, 1, 10), "70"), ("RCLC1", date(2024, 4, 5), "71")], AT)
    asked = spark.createDataFrame(
        [("r", ["RWTC", "RBRTE", "RCLC1"], date(2024, 1, 1), date(2024, 5, 31))], REQUEST)
    nothing = spark.createDataFrame([], "series_id string, observation_date date")
    tables = quality.quality_tables(batch, nothing, asked, series_catalog(spark))
    rejected = spark.createDataFrame(
        [("s", "k", "{}", f"malformed numeric string '{v}'") for v in ("NA", "--")],
        "source string, raw_artifact_key string, row_json string, reason string")
    lines = quality.quality_lines(rejected, *tables)
    of = lambda kind: sorted((r["subject"], r["text"], r["rows"]) for r in lines.filter(F.col("kind") == kind).collect())
    assert of("warning") == [
        ("RBRTE", "RBRTE: no observations yet", None),
        ("RWTC", "RWTC: last observation 2024-01-10, 102 business days old", None),
    ]
    assert of("last observation") == [("RCLC1", "2024-04-05", None), ("RWTC", "2024-01-10", None)]
    assert sorted((r["text"], r["rows"]) for r in lines.filter("kind = 'reason'").collect()) == [
        ("malformed numeric string '--'", 1), ("malformed numeric string 'NA'", 1)]
    report = quality.quality_report(batch, rejected, lines)
    assert (report["status"], report["rejected"], report["reasons"], report["warnings"]) == ("quarantined", 2, 2, 2)
