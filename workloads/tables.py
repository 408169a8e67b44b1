"""Price tables derived from the given tables, so that the work grows with them.

Line items become observations: the supplier is the source, the line number picks the series, the
ship date is the observation date. Events become raw API pages, monitored values and alert rules.
Orders become run records.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.catalog import CATALOG_ROWS, CATALOG_SCHEMA, POSITIONS
from quayside.schemas import (
    GOLD, MONITORED, OBSERVATION_KEY, PAGE, PARAMS, RULE, SILVER, conform,
)

SERIES_OF_LINE = {1: "RWTC", 2: "RBRTE", 3: "RCLC1", 4: "RCLC2", 5: "RCLC3", 6: "RCLC4", 7: "RWTC"}
SERIES_OF_EVENT = {
    "view": "RWTC", "click": "RBRTE", "purchase": "RCLC1", "signup": "RCLC2", "error": "RCLC3",
}
POSITION_OF_EVENT = dict(zip(("view", "click", "purchase", "signup", "error"), POSITIONS))
STATUS_OF_ORDER = {"F": "failed", "O": "published", "P": "quarantined"}
EVENTS_PER_PAGE = 500
#: Line items of one task where a supplier's days are dealt out.
LINES_PER_TASK = 100_000
API_KEY = "k-0000"
BY = ("source",)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def chosen(column: str, options: dict) -> Column:
    """The option a column's value picks, as one CASE."""
    picked = None
    for value, result in options.items():
        match = F.col(column) == F.lit(value)
        picked = F.when(match, result) if picked is None else picked.when(match, result)
    return picked


def cells(spark: SparkSession, sf: str) -> DataFrame:
    """One row per line item as a raw observation."""
    margin = F.lit(Decimal("0.095")) - F.col("l_discount").cast("decimal(4,2)")
    return table(spark, sf, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_suppkey")).alias("source"),
        chosen("l_linenumber", SERIES_OF_LINE).alias("series_id"),
        F.to_date("l_shipdate").alias("observation_date"),
        (F.col("l_extendedprice").cast("decimal(18,2)") * margin).cast("decimal(18,6)")
        .alias("price"),
        F.timestamp_add("HOUR", F.col("l_quantity").cast("int"),
                        F.col("l_shipdate").cast("timestamp")).alias("seen"),
        "l_linestatus",
    )


def day_cells(spark: SparkSession, sf: str) -> DataFrame:
    """`cells` with those of a supplier's day in one task. Nearly every line is a key of its own, so nothing
    would combine before a shuffle; one shuffle of the lines serves all later grouping by supplier and
    date, and the number of tasks grows with the lines, so that a task's share stays the same."""
    tasks = table(spark, sf, "lineitem").count() // LINES_PER_TASK + 1
    return cells(spark, sf).repartition(tasks, "source", "observation_date")


def gold(spark: SparkSession, sf: str, by_day: bool = False) -> DataFrame:
    """What an earlier fetch stored: the finished lines, one row per (supplier, series, date)."""
    lines = day_cells(spark, sf) if by_day else cells(spark, sf)
    per_key = lines.filter("l_linestatus = 'F'").groupBy(*OBSERVATION_KEY).agg(
        F.max("price").alias("price"), F.min("seen").alias("retrieved_at"),
        F.max("seen").alias("last_seen_at"),
    )
    return conform(_labelled(per_key, "first"), GOLD)


def batch(spark: SparkSession, sf: str, by_day: bool = False) -> DataFrame:
    """A later fetch over all lines: same, changed and new keys, some retrieved late."""
    lines = day_cells(spark, sf) if by_day else cells(spark, sf)
    per_key = lines.groupBy(*OBSERVATION_KEY).agg(
        F.max("price").alias("price"), F.max("seen").alias("retrieved_at")
    )
    return conform(_labelled(per_key, "second"), SILVER)


def observations(spark: SparkSession, sf: str) -> DataFrame:
    """The whole line item table as a current table seen once."""
    seen = batch(spark, sf, by_day=True)
    return conform(seen.withColumn("last_seen_at", F.col("retrieved_at")), GOLD)


def _labelled(df: DataFrame, input_id: str) -> DataFrame:
    return df.withColumns({
        "unit": F.lit("$/BBL"), "non_positive": F.col("price") <= 0,
        "logical_input_id": F.lit(input_id), "raw_artifact_key": F.lit(f"{input_id}/page-0001.json"),
    })


def params(spark: SparkSession) -> DataFrame:
    """A fixed parameter set, above spot until June and below it after: 0.002 k (13 - 2 m)."""
    s = lambda k, m: Decimal(2 * k * (13 - 2 * m)) / 1000
    return spark.createDataFrame(
        [(f"C{k}", m, s(k, m), 20) for k in range(1, 5) for m in range(1, 13)],
        PARAMS,
    )


def catalog(spark: SparkSession) -> DataFrame:
    """The series catalog, with one series ending inside the events' month."""
    from datetime import date

    rows = [(*r[:6], date(2024, 1, 15)) if r[0] == "RCLC3" else r for r in CATALOG_ROWS]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def _event_key(spark: SparkSession, sf: str) -> DataFrame:
    return _keyed(table(spark, sf, "events"))


def _keyed(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", "ts", "user_id", "event_type", "value", "props",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("text"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
    )


def raw_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events as raw API rows in JSON text. The event's own `k` decides which rows are malformed."""
    k = F.col("k")
    value = (
        F.when(k == 0, F.lit("null")).when(k == 1, F.lit("true"))
        .when(k == 2, F.concat("text", F.lit("5"))).when(k == 3, F.lit('"NA"'))
        .when(k == 4, F.lit('"1e3"')).when(k == 5, F.concat(F.lit('"'), "text", F.lit('00001"')))
        .when(k == 6, F.floor("value").cast("string")).when(k == 7, F.lit('"1234567890123.5"'))
        .when(k == 8, F.lit("[1]")).when(k == 9, F.lit('{"v":1}'))
        .when(k == 10, F.concat(F.lit('" '), "text", F.lit('"')))
        .otherwise(F.concat(F.lit('"'), "text", F.lit('"')))
    )
    unit = F.when(k == 11, "$/GAL").otherwise("$/BBL")
    series = F.when(k == 12, "XXXX").otherwise(chosen("event_type", SERIES_OF_EVENT))
    period = (
        F.when(k == 13, "2024-13-01").when(k == 14, F.replace("day", F.lit("-"), F.lit("")))
        .when(k == 15, F.substring("day", 1, 7)).otherwise(F.col("day"))
    )
    row = F.concat(
        F.lit('{"period":"'), period, F.lit('","series":"'), series, F.lit('","units":"'), unit,
        F.lit('","value":'), value, F.lit("}"),
    )
    return _event_key(spark, sf).select(
        "event_id", "ts", F.concat(F.lit("U"), F.col("user_id")).alias("source"), row.alias("row"),
        "k",
    )


def pages(spark: SparkSession, sf: str, redacted: bool = True) -> DataFrame:
    """Raw rows laid out as API pages: at most EVENTS_PER_PAGE events by construction, since the
    page number is the event number cut into ranges. Each user is one request."""
    cell = F.struct("event_id", "row")
    body = F.concat(
        F.lit(f'{{"request":{{"params":{{"api_key":"{API_KEY}"}}}},"response":{{"data":['),
        F.array_join(F.transform(F.array_sort(F.collect_list(cell)), lambda c: c["row"]), ","),
        F.lit('],"total":"'), F.count(F.lit(1)).cast("string"), F.lit('"}}'),
    )
    laid = raw_events(spark, sf).groupBy(
        "source", F.floor(F.col("event_id") / EVENTS_PER_PAGE).cast("int").alias("page_no")
    ).agg(body.alias("body"), F.max("ts").cast("timestamp").alias("retrieved_at"))
    landed = laid.select(
        "source", F.col("source").alias("request_id"), "page_no", F.lit("petroleum").alias("route"),
        F.lit(None).cast("map<string,string>").alias("params"), "retrieved_at",
        F.lit(None).cast("string").alias("sha256"), "body",
    )
    return conform(landed, PAGE)


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """One request per user: all five series over the days the user was active."""
    return _event_key(spark, sf).groupBy(
        F.concat(F.lit("U"), F.col("user_id")).alias("source")
    ).agg(F.min("day").cast("date").alias("start"), F.max("day").cast("date").alias("end")).select(
        "source", F.col("source").alias("request_id"),
        F.array(*map(F.lit, SERIES_OF_EVENT.values())).alias("series_ids"), "start", "end",
    )


def monitored(spark: SparkSession, sf: str) -> DataFrame:
    """Each event as a monitored value of its own version; a small `k` makes it a gap."""
    return monitored_of(table(spark, sf, "events"))


def monitored_of(events: DataFrame) -> DataFrame:
    """`monitored` of an events table or stream."""
    gap = F.col("k") < 10
    return conform(
        _keyed(events).select(
            F.col("event_id").alias("dataset_version"),
            F.concat(F.lit("U"), F.col("user_id")).alias("curve_id"),
            chosen("event_type", POSITION_OF_EVENT).alias("position"),
            F.to_date("ts").alias("as_of_date"),
            F.when(~gap, F.col("text")).cast("decimal(18,4)").alias("price"),
            F.when(gap, "gap").otherwise("ok").alias("status"),
        ),
        MONITORED,
    )


def rules(spark: SparkSession, sf: str) -> DataFrame:
    """Two rules per curve position: halfway between its extremes from its first version on, and
    a quarter of the way from the beginning of time."""
    per_key = _event_key(spark, sf).groupBy("user_id", "event_type").agg(
        F.min(F.col("text").cast("decimal(18,4)")).alias("low"),
        F.max(F.col("text").cast("decimal(18,4)")).alias("high"),
        F.min("event_id").alias("first"), F.min("ts").cast("timestamp").alias("created_at"),
    )
    rule = lambda name, limit, baseline: F.struct(
        F.concat_ws("-", "user_id", "event_type", F.lit(name)).alias("rule_id"),
        limit.cast("decimal(18,4)").alias("threshold"),
        baseline.cast("bigint").alias("baseline_version"),
    )
    low, high = F.col("low"), F.col("high")
    two = F.array(
        rule("half", (low + high) / 2, F.col("first")),
        rule("quarter", (low * 3 + high) / 4, F.lit(0)),
    )
    flat = per_key.select("*", F.explode(two).alias("r"))
    return conform(
        flat.select(
            "r.*", F.concat(F.lit("U"), F.col("user_id")).alias("curve_id"),
            chosen("event_type", POSITION_OF_EVENT).alias("position"), "created_at",
            F.lit(None).cast("timestamp").alias("deleted_at"),
            F.lit(None).cast("boolean").alias("armed"),
            F.lit(None).cast("decimal(18,4)").alias("last_value"),
            F.lit(None).cast("date").alias("last_as_of"),
            F.lit(None).cast("bigint").alias("last_version"),
        ),
        RULE,
    )


def attempts(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as run attempts: the order status is the run's outcome."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("attempt_id"),
        F.concat(F.lit("in-"), F.col("o_custkey")).alias("logical_input_id"),
        chosen("o_orderstatus", STATUS_OF_ORDER).alias("status"),
        F.col("o_orderkey").alias("dataset_version"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("error"),
        F.col("o_orderdate").cast("timestamp").alias("finished_at"),
    )


def versions(spark: SparkSession, sf: str) -> DataFrame:
    """Orders that published are the dataset versions."""
    return attempts(spark, sf).filter("status = 'published'").select(
        "dataset_version", "logical_input_id", F.sha2("attempt_id", 256).alias("manifest_sha256"),
        F.lit("orders").alias("source"), F.col("finished_at").alias("created_at"),
    )


def outbox(spark: SparkSession, sf: str) -> DataFrame:
    """Events of the versions: urgent orders are still pending, low ones died."""
    status = chosen("o_orderpriority", {"1-URGENT": "pending", "5-LOW": "dead"})
    return table(spark, sf, "orders").filter("o_orderstatus <> 'P'").select(
        F.concat(F.lit("ev-"), F.col("o_orderkey")).alias("event_id"),
        F.lit("dataset_imported").alias("event_type"),
        F.col("o_orderkey").alias("dataset_version"),
        F.coalesce(status, F.lit("done")).alias("status"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("attempts"),
        F.col("o_orderpriority").alias("last_error"),
        F.col("o_orderdate").cast("timestamp").alias("processed_at"),
    )


def run_records(spark: SparkSession, sf: str) -> DataFrame:
    """Each order as a run's completion record; the order's own values decide what is wrong."""
    key = F.col("o_orderkey").cast("string")
    priority = F.substring("o_orderpriority", 1, 1)
    named = F.when(priority == "1", F.concat(key, F.lit("x"))).otherwise(key)
    rows = F.when(priority == "2", F.lit('"48"')).otherwise(F.lit("48"))
    digest = F.when(priority == "3", F.lit("none")).otherwise(F.sha2(key, 256))
    body = F.concat(
        F.lit('{"schema":1,"run_id":"'), named, F.lit('","params_sha256":"'), digest,
        F.lit('","rows":'), rows,
        F.lit(',"outputs":{"shape_params.csv":1,"shape_params.sha256":1},"arguments":{},'
              '"completed_at":"'), F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.lit('T00:00:00+00:00"}'),
    )
    cut = F.when(F.col("o_orderstatus") == "P", F.substring(body, 1, 40)).otherwise(body)
    return table(spark, sf, "orders").select("o_custkey", key.alias("run_id"), cut.alias("body"))


def comparable(df: DataFrame) -> DataFrame:
    """The result in types both engines print alike: decimals as doubles, dates and times as text."""
    out = []
    for name, kind in df.dtypes:
        column = F.col(name)
        if kind.startswith("decimal"):
            column = column.cast("double")
        elif kind == "date":
            column = column.cast("string")
        elif kind.startswith("timestamp"):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind in ("tinyint", "smallint", "int"):
            column = column.cast("bigint")
        out.append(column.alias(name))
    return df.select(*out)


