"""One named query per operator, over the tables of `workloads.tables`."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import dates, numeric
from quayside.functions.digests import fingerprint, ordered_digest
from quayside.functions.scans import dense_sequence
from quayside.operators import alerts, checks, curves, merge, parse, quality, reports, shape
from quayside.plans import exports, named_queries, shape_runs
from quayside.plans import serving as serving_plan
from quayside.plans import warehouse as warehouse_plan
from quayside.plans.versions import read_table, read_version, version_index
from quayside.schemas import GOLD, OBSERVATION_KEY, RULE, conform
from quayside.session import scratch
from quayside.sources import pages as page_source
from quayside.sources import synthetic
from quayside.streaming import alerts as stream_alerts
from quayside.streaming import feeds
from workloads import stores
from workloads import tables as t

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TODAY = date(2002, 1, 1)
VERSION = 7
METHOD = {"params_sha256": "fixed", "shape_method_version": shape.METHOD_VERSION}


def query(fn: Query) -> Query:
    """Register a query under its function name, with its result in comparable types."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")  # as the SQL twins assume
        return t.comparable(fn(spark, sf_dir))

    QUERIES[fn.__name__] = run
    return fn


# --- seasonal shape ------------------------------------------------------------------------------


def _pairs(spark, sf):
    return shape.shape_pairs(t.observations(spark, sf), window=None, by=t.BY)


@query
def seasonal_shape(spark, sf):
    return shape.shape_stats(_pairs(spark, sf))


@query
def shape_exclusions(spark, sf):
    return shape.excluded_pairs(_pairs(spark, sf), t.BY)


@query
def shape_thin_groups(spark, sf):
    return shape.thin_groups(shape.shape_stats(_pairs(spark, sf)), 60).select(
        "position", "month", "n_obs"
    )


@query
def shape_missing_groups(spark, sf):
    """Keys of the grid that stay empty when only the fourth contract is observed."""
    pairs = shape.shape_pairs(t.observations(spark, sf), None, positions={"RCLC4": "C4"}, by=t.BY)
    return shape.missing_groups(shape.shape_stats(pairs)).select("position", "month")


@query
def compare_shapes(spark, sf):
    """The shape of the first fetch against the shape of all lines."""
    first = shape.shape_stats(shape.shape_pairs(t.gold(spark, sf, by_day=True), None, by=t.BY))
    everything = shape.shape_stats(_pairs(spark, sf))
    both = shape.compare_params(first, everything, "0.0500000000")
    return both.select("position", "month", F.split("problem", " ")[0].alias("problem"))


@query
def verified_shape(spark, sf):
    """Parameters of which one month was moved, against a new estimate from the observations."""
    held = shape.shape_stats(_pairs(spark, sf))
    moved = F.when(F.col("month") == 7, F.col("s") + F.lit("0.0000000100").cast("decimal(20,10)")).otherwise(F.col("s"))
    stored = held.withColumn("s", moved.cast("decimal(20,10)"))
    found = shape.verify_shape(stored, t.observations(spark, sf), window=None, by=t.BY)
    return found.select("position", "month", F.split("problem", " ")[0].alias("problem"))


@query
def shape_inputs_digest(spark, sf):
    """The ordered hash tree over the observations that the shape is estimated from."""
    return shape.inputs_digest(shape.used_observations(t.observations(spark, sf), None), t.BY)


# --- curves and their reports --------------------------------------------------------------------


def _curves(spark, sf, newest=False):
    return curves.build_curves(t.observations(spark, sf), t.params(spark), by=t.BY, newest=newest, **METHOD)


@query
def curve_points(spark, sf):
    return _curves(spark, sf).select(
        "source", "curve_id", "kind", "as_of_date", "position", "price", "status", "gap_reason",
        "shape_source",
    )


@query
def latest_complete_curve(spark, sf):
    return reports.latest_complete_curve(_curves(spark, sf), by=t.BY)


@query
def latest_points(spark, sf):
    return reports.latest_points(_curves(spark, sf, newest=True), F.lit(TODAY), by=t.BY).select(
        "source", "curve_id", "position", "as_of_date", "price", "status", "data_age_days"
    )


@query
def latest_curves_grouped(spark, sf):
    """The read API's grouping, flattened to one text per curve."""
    curves_now = reports.grouped_latest(_curves(spark, sf, newest=True), F.lit(TODAY), by=t.BY)
    shown = F.array_join(
        F.transform("points", lambda p: F.concat_ws(
            ":", p["position"], p["as_of"].cast("string"), F.coalesce(p["price"], F.lit("gap"))
        )), "|",
    )
    return curves_now.select("source", "curve_id", "kind", "as_of", "data_age_days",
                             shown.alias("points"))


@query
def spread_by_position(spark, sf):
    return reports.spread_by_position(_curves(spark, sf), by=t.BY)


@query
def contango_days(spark, sf):
    return reports.contango_days(_curves(spark, sf), by=t.BY)


@query
def contango_days_all_sources(spark, sf):
    return reports.contango_days(_curves(spark, sf), by=t.BY, report=["curve_id"])


@query
def month_percent_rank(spark, sf):
    ranked = reports.month_percent_rank(_curves(spark, sf), by=t.BY)
    return ranked.withColumn("month_percent_rank", F.round("month_percent_rank", 9))


@query
def curve_history(spark, sf):
    return reports.curve_history(
        _curves(spark, sf), "BRENT_WTI", "C2", date(1996, 1, 1), None, by=t.BY
    )


@query
def price_history(spark, sf):
    return reports.price_history(
        t.observations(spark, sf), "RBRTE", None, date(2000, 12, 31), by=t.BY
    )


@query
def curve_rule_violations(spark, sf):
    """Monitored values with their status blanked on cheap ones, so that the rule is broken."""
    values = t.monitored(spark, sf).withColumn(
        "status", F.when(F.col("price") < 1, "gap").otherwise(F.col("status"))
    )
    return curves.curve_rule_violations(values).select("dataset_version", "status", "price")


# --- merge and revisions -------------------------------------------------------------------------


def _changes(spark, sf):
    return merge.changes(t.gold(spark, sf), t.batch(spark, sf))


@query
def merge_current(spark, sf):
    return merge.current_of(_changes(spark, sf)).select(
        *OBSERVATION_KEY, "price", "logical_input_id", "retrieved_at", "last_seen_at"
    )


@query
def merge_superseded(spark, sf):
    return merge.superseded_of(_changes(spark, sf), VERSION, "second").select(
        *OBSERVATION_KEY, "price", "last_seen_at", "superseded_at_version",
        "superseded_by_logical_input_id",
    )


@query
def merge_stats(spark, sf):
    return _changes(spark, sf).groupBy("source").agg(*merge.stats_columns())


@query
def stale_notes(spark, sf):
    return merge.stale_notes(_changes(spark, sf))


@query
def revisions_per_month(spark, sf):
    gone = merge.superseded_of(_changes(spark, sf), VERSION, "second")
    return reports.revisions_per_month(gone)


@query
def legacy_gold_conformed(spark, sf):
    """Gold from before the watermark column existed takes its retrieval time as watermark."""
    legacy = t.gold(spark, sf).drop("last_seen_at")
    return conform(legacy, GOLD).select(*OBSERVATION_KEY, "retrieved_at", "last_seen_at")


# --- pages, parsing and quality ------------------------------------------------------------------


@query
def parsed_rows(spark, sf):
    """Every raw row with its typed columns or its reason."""
    rows = page_source.page_rows(t.pages(spark, sf))
    return parse.parse_rows(rows, t.catalog(spark), "run-1").select(
        "source", "page_no", "row_no", "series_id", "observation_date", "price", "reason",
    )


@query
def silver_observations(spark, sf):
    return parse.split_parsed(stores.parsed(spark, sf))[0]


@query
def silver_rejected(spark, sf):
    """Rejections with their reason; a conflict's row is shown by its key and price."""
    rejected = parse.split_parsed(stores.parsed(spark, sf))[1]
    cell = lambda name: F.get_json_object("row_json", f"$.{name}")
    conflict = F.col("reason") == parse.CONFLICT
    shown = F.when(
        conflict, F.concat_ws(" ", cell("series_id"), cell("observation_date"))
    ).otherwise(F.col("row_json"))
    return rejected.select("source", "raw_artifact_key", "reason", shown.alias("row"))


@query
def rejection_counts(spark, sf):
    return quality.rejection_counts(parse.split_parsed(stores.parsed(spark, sf))[1])


@query
def completeness(spark, sf):
    silver, _ = parse.split_parsed(stores.parsed(spark, sf))
    return quality.completeness(silver, t.requests(spark, sf), t.catalog(spark), t.BY)


@query
def completeness_issues(spark, sf):
    silver, _ = parse.split_parsed(stores.parsed(spark, sf))
    judged = quality.completeness(silver, t.requests(spark, sf), t.catalog(spark), t.BY)
    return quality.completeness_issues(judged).select("source", "request_id", "message")


@query
def last_observations(spark, sf):
    silver, _ = parse.split_parsed(stores.parsed(spark, sf))
    return quality.last_observations(silver, t.requests(spark, sf), t.catalog(spark), t.BY)


@query
def quality_report(spark, sf):
    """Every rejection reason, last observation, warning and incomplete series, as lines."""
    silver, rejected = parse.split_parsed(stores.parsed(spark, sf))
    wanted, known = t.requests(spark, sf), t.catalog(spark)
    issues = quality.completeness_issues(quality.completeness(silver, wanted, known, t.BY))
    lines = quality.quality_lines(
        rejected, quality.last_observations(silver, wanted, known, t.BY), issues, t.BY)
    request = F.when(F.col("kind") == "incomplete", F.substring_index("subject", "/", 1)).otherwise(F.col("subject"))
    counted = F.when(F.col("kind") == "reason", F.col("rows"))
    told = lines.select("kind", request.alias("subject"), "text", counted.alias("rows"))
    reasons = told.filter("kind = 'reason'").groupBy("kind", "subject", "text").agg(F.sum("rows").alias("rows"))
    return told.filter("kind <> 'reason'").unionByName(reasons)


@query
def page_reconciliation(spark, sf):
    """Users' pages disagree on the total, as each page states only its own rows."""
    found = page_source.reconcile_pages(t.pages(spark, sf))
    return found.select("request_id", "kind", "detail")


@query
def page_shape_errors(spark, sf):
    """Event properties and web pages offered as responses, next to real pages."""
    events = t.table(spark, sf, "events").select(
        F.concat(F.lit("E"), F.col("event_id")).alias("request_id"), F.lit(1).alias("page_no"),
        F.concat(F.lit('{"response":{"data":['), F.col("props"), F.lit('],"total":"'),
                 F.col("event_type"), F.lit('"}}')).alias("body"),
    )
    web = t.table(spark, sf, "pages").select(
        F.concat(F.lit("P"), F.col("page_id")).alias("request_id"), F.lit(1).alias("page_no"),
        F.col("html").alias("body"),
    )
    props = t.table(spark, sf, "events").select(
        F.concat(F.lit("Q"), F.col("event_id")).alias("request_id"), F.lit(1).alias("page_no"),
        F.col("props").alias("body"),
    )
    good = t.pages(spark, sf).select("request_id", "page_no", "body")
    return page_source.page_shape_errors(events.union(web).union(props).union(good))


@query
def redacted_page_hashes(spark, sf):
    hidden = page_source.redact_pages(t.pages(spark, sf), t.API_KEY)
    return hidden.select("request_id", "page_no", "sha256")


@query
def staged_page_differences(spark, sf):
    """Redacted pages against an index staged before redaction: every page differs."""
    staged = t.pages(spark, sf)
    index = staged.select("request_id", "page_no", F.sha2("body", 256).alias("staged_sha256"))
    hidden = page_source.redact_pages(staged, t.API_KEY)
    return page_source.staged_differences(hidden, index)


# --- alerts --------------------------------------------------------------------------------------


def _crossings(spark, sf):
    return alerts.crossings(t.monitored(spark, sf), t.rules(spark, sf))


@query
def alert_crossings(spark, sf):
    return _crossings(spark, sf).drop("created_at")


@query
def alert_log(spark, sf):
    """The crossings as a numbered log that continues after sequence 1000."""
    fired = _crossings(spark, sf)
    log = alerts.append_alerts(
        fired.select("alert_id").limit(0), fired, 1000, F.lit("2024-02-01").cast("timestamp")
    )
    return log.select("seq", "alert_id", "rule_id", "dataset_version", "price", "previous_price")


@query
def alerts_after_cursor(spark, sf):
    """One page of the log after a cursor, in sequence order."""
    fired = _crossings(spark, sf)
    log = alerts.append_alerts(
        fired.select("alert_id").limit(0), fired, 0, F.lit("2024-02-01").cast("timestamp")
    )
    return alerts.alerts_after(log, 25, 50).select("seq", "alert_id")


@query
def cursor_places(spark, sf):
    """Readers that come back with each event as a cursor, to a log that holds a part of them."""
    epoch = F.when(F.col("user_id") % 5 == 0, F.lit("f" * 32)).otherwise(F.lit("0" * 32))
    number = F.when(F.col("user_id") % 7 == 0, F.concat(F.lit("0"), F.col("event_id"))).otherwise(F.col("event_id").cast("string"))
    seen = t.table(spark, sf, "events").select(
        "event_id", alerts.reading_place(F.concat_ws("-", epoch, number), "0" * 32, 200, 700).alias("place"))
    return seen.select("event_id", "place.*")


@query
def latest_alerts(spark, sf):
    fired = _crossings(spark, sf)
    log = alerts.append_alerts(
        fired.select("alert_id").limit(0), fired, 0, F.lit("2024-02-01").cast("timestamp")
    )
    return alerts.latest_alerts(log, 50).select("seq", "alert_id")


@query
def rule_baseline(spark, sf):
    """New rules started at a version: each curve's newest value so far is that version's."""
    now = t.monitored(spark, sf).groupBy("curve_id", "position").agg(
        F.max_by(F.struct("as_of_date", "price", "status"), "dataset_version").alias("last")
    ).select("curve_id", "position", "last.*", F.lit(VERSION).alias("dataset_version"))
    asked = t.rules(spark, sf).select("rule_id", "curve_id", "position", "threshold", "created_at")
    return alerts.rule_baseline(asked, now, VERSION, config=None).select(
        "rule_id", "baseline_version", "armed", "last_value", "last_as_of", "last_version"
    )


@query
def monitored_values(spark, sf):
    return reports.monitored_values(_curves(spark, sf, newest=True), VERSION, by=t.BY)


@query
def parsed_thresholds(spark, sf):
    """Thresholds written as text in several forms, valid and not."""
    text = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    forms = F.array(
        text, F.concat(F.lit("-"), text), F.concat(text, F.lit("001")),
        F.concat(text, F.lit("00")), F.concat(F.lit(" +"), text), F.concat(text, F.lit("e2")),
        F.concat(F.lit("1"), F.lpad(F.col("l_orderkey").cast("string"), 14, "0")), F.lit("NaN"),
        F.concat(F.lit("."), F.col("l_linenumber").cast("string")),
    )
    written = t.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.posexplode(forms).alias("form", "text")
    )
    return written.withColumn("limit", alerts.threshold(F.col("text"))).groupBy("form").agg(
        F.count(F.lit(1)).alias("texts"), F.count("limit").alias("valid"),
        F.min("limit").alias("low"), F.max("limit").alias("high"),
    )


# --- run records, versions and checks ------------------------------------------------------------


@query
def attempt_status_counts(spark, sf):
    return reports.status_counts(t.attempts(spark, sf))


@query
def outbox_status_counts(spark, sf):
    return reports.status_counts(t.outbox(spark, sf))


@query
def problem_attempts(spark, sf):
    return reports.problem_attempts(t.attempts(spark, sf)).select(
        "attempt_id", "status", "error", "finished_at"
    )


@query
def dead_events(spark, sf):
    return reports.dead_events(t.outbox(spark, sf))


@query
def health_page(spark, sf):
    """The health read as rows: newest version, counts per status, newest problems and dead events."""
    tables = reports.health(t.versions(spark, sf), t.attempts(spark, sf), t.outbox(spark, sf))
    shown = {
        "versions": ("dataset_version", "source"), "attempt_counts": ("status", "records"),
        "problem_attempts": ("attempt_id", "status"), "outbox_counts": ("status", "records"),
        "dead_events": ("event_id", "last_error"),
    }
    parts = [tables[name].select(F.lit(name).alias("part"), *[F.col(c).cast("string").alias(k) for k, c in zip(("item", "value"), own)])
             for name, own in shown.items()]
    return reduce(DataFrame.unionByName, parts)


@query
def current_version(spark, sf):
    return reports.current_version(t.versions(spark, sf))


@query
def unmatched_versions(spark, sf):
    return checks.unmatched_versions(t.versions(spark, sf), t.outbox(spark, sf))


@query
def staging_key_counts(spark, sf):
    return checks.key_counts(t.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def staging_violations(spark, sf):
    lines = t.table(spark, sf, "lineitem")
    return checks.validate_staging(lines, "lineitem", ["l_orderkey", "l_linenumber"], 1)


@query
def repeated_keys(spark, sf):
    return checks.repeated_keys(t.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def unseen_attempts(spark, sf):
    """Attempts of later orders that an earlier sync has not stored yet."""
    every = t.attempts(spark, sf)
    stored = every.filter("status <> 'failed'").select("attempt_id")
    return serving_plan.unseen_attempts(every, stored).select("attempt_id", "status")


# --- expressions ---------------------------------------------------------------------------------


@query
def business_day_lags(spark, sf):
    """Business days from order to shipment, counted over all lines."""
    lines = t.table(spark, sf, "lineitem").select("l_orderkey", F.to_date("l_shipdate").alias("to"))
    orders = t.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("from")
    )
    lag = dates.business_days_after(F.col("from"), F.col("to"))
    return lines.join(orders, "l_orderkey").groupBy(lag.alias("lag")).agg(
        F.count(F.lit(1)).alias("lines")
    )


@query
def backoff_delays(spark, sf):
    """Retry delays of the outbox events by their failed attempts."""
    delay = numeric.backoff_seconds(F.col("attempts") * 3)
    return t.outbox(spark, sf).groupBy("attempts", delay.alias("delay_s")).agg(
        F.count(F.lit(1)).alias("events")
    )


@query
def half_even_prices(spark, sf):
    """Totals per supplier of prices rounded half-even to 4 and to 2 decimals."""
    price = F.col("price")
    return t.observations(spark, sf).groupBy("source").agg(
        F.sum(numeric.half_even(price, 4)).cast("decimal(18,4)").alias("four"),
        F.sum(numeric.half_even(price, 2)).cast("decimal(18,2)").alias("two"),
    )


@query
def synthetic_overrides(spark, sf):
    """Generated prices with those of high-total order dates replaced and of returns omitted."""
    orders = t.table(spark, sf, "orders").groupBy(
        F.to_date("o_orderdate").alias("observation_date")
    ).agg(F.max(F.col("o_totalprice").cast("decimal(18,2)")).alias("price"),
          F.min("o_orderstatus").alias("status"))
    wti = F.lit("RWTC").alias("series_id")
    history = synthetic.synthetic_prices(orders.select("observation_date"), ["RWTC", "RBRTE"])
    replaced = orders.filter("price > 450000").select(wti, "observation_date", "price")
    dropped = orders.filter("status = 'P'").select(wti, "observation_date")
    return synthetic.omit_prices(synthetic.override_prices(history, replaced), dropped)


@query
def table_fingerprint(spark, sf):
    """Order-independent content digest of the whole observation table, per series."""
    return fingerprint(t.observations(spark, sf).drop("raw_artifact_key"), by=["series_id"])


@query
def params_digest(spark, sf):
    """SHA-256 of the canonical text of a parameter-sized table: observations per series."""
    counted = t.observations(spark, sf).groupBy("series_id").agg(F.count(F.lit(1)).alias("n"))
    line = F.concat(F.concat_ws(",", "series_id", "n"), F.lit("\n"))
    return ordered_digest(counted, ["series_id"], line)


# --- published versions, serving, warehouse and streams ------------------------------------------


def _version_table(spark, sf, name, number=None):
    root = stores.store(spark, sf)
    return read_table(spark, root, read_version(spark, root, number), name)


@query
def published_observations(spark, sf):
    """Current observations of a store that ingested both fetches, read back and verified."""
    return _version_table(spark, sf, "gold_current").select(
        *OBSERVATION_KEY, "price", "unit", "non_positive", "retrieved_at", "last_seen_at"
    )


@query
def published_first_version(spark, sf):
    """The first version still reads as it was published."""
    return _version_table(spark, sf, "gold_current", 1).select(*OBSERVATION_KEY, "price")


@query
def published_revisions(spark, sf):
    return _version_table(spark, sf, "gold_revisions").select(
        *OBSERVATION_KEY, "price", "superseded_at_version"
    )


@query
def published_curves(spark, sf):
    return _version_table(spark, sf, "gold_curves").select(
        "curve_id", "kind", "as_of_date", "position", "price", "status", "gap_reason"
    )


@query
def published_versions(spark, sf):
    return version_index(spark, stores.store(spark, sf)).select("dataset_version")


@query
def imported_versions(spark, sf):
    return serving_plan.versions(stores.serving(spark, sf)).select(
        "dataset_version", "source", "observations", "revisions", "curve_points", "price_changes"
    )


@query
def monitored_of_version(spark, sf):
    served = stores.serving(spark, sf)
    return alerts.values_of_version(
        serving_plan.monitored(served, 2), serving_plan.versions(served), 2
    )


@query
def synced_attempts(spark, sf):
    return reports.status_counts(serving_plan.stored_attempts(stores.serving(spark, sf)))


@query
def warehouse_load_log(spark, sf):
    return warehouse_plan.verified_tables(spark, stores.warehouse(spark, sf))


@query
def warehouse_spread_by_position(spark, sf):
    points = warehouse_plan.read_loaded(spark, stores.warehouse(spark, sf), "curve_points")
    return reports.spread_by_position(points)


def _named(spark, sf, name, **values):
    """A named query with the place of each row in its output, which the twin numbers by itself."""
    rows = named_queries.run_named(spark, stores.warehouse(spark, sf), name, **values)
    return dense_sequence(rows, named_queries.NAMED[name].order, "place")


@query
def named_latest_curve(spark, sf):
    return _named(spark, sf, "latest_curve_per_series")


@query
def named_spread(spark, sf):
    return _named(spark, sf, "wti_brent_spread_by_tenor")


@query
def named_contango(spark, sf):
    return _named(spark, sf, "contango_backwardation_days", far="C2")


@query
def named_revisions(spark, sf):
    return _named(spark, sf, "revisions_per_month")


@query
def named_percentile(spark, sf):
    ranked = _named(spark, sf, "rolling_percentile", curve="BRENT")
    return ranked.withColumn("month_percent_rank", F.round("month_percent_rank", 9))


@query
def exported_history(spark, sf):
    """A labelled CSV export of one curve position, as numbered lines read back from disk."""
    points = _version_table(spark, sf, "gold_curves")
    history = reports.curve_history(points, "WTI", "C1").drop("estimate_type")
    path = scratch(spark, "export")
    exports.export_table(
        history, path, ["as_of"], version=2, source=stores.SOURCE, created_at="2003-01-02"
    )
    return spark.read.text(path).withColumnRenamed("value", "line")


@query
def streamed_observations(spark, sf):
    """Current observations after a stream ingested the landed pages file by file."""
    root = stores.streamed_store(spark, sf)
    table = read_table(spark, root, read_version(spark, root), "gold_current")
    return table.select(*OBSERVATION_KEY, "price", "retrieved_at", "last_seen_at")


@query
def streamed_crossings(spark, sf):
    """Crossings found by the stream over the events, landed as files that each hold versions from
    the whole range and are read one at a time."""
    values, landed = stream_alerts.with_follows(t.monitored(spark, sf)), scratch(spark, "landed")
    dealt = values.repartition(8, F.pmod(F.xxhash64("dataset_version"), F.lit(8)))
    dealt.write.parquet(landed)
    out, kept = scratch(spark, "crossings"), scratch(spark, "rules")
    t.rules(spark, sf).write.parquet(kept)  # once, not per micro-batch
    wanted = spark.read.schema(RULE).parquet(kept)
    run = stream_alerts.run_crossings(
        stream_alerts.stream_monitored(spark, landed, 1), lambda: wanted, out, scratch(spark, "checkpoint"))
    run.awaitTermination()
    return stream_alerts.read_crossings(spark, out).drop("created_at")


@query
def newest_update(spark, sf):
    """The update a feed announces after version 1: the newest of all."""
    newest = feeds.newest_update(t.versions(spark, sf), 1)
    return t.versions(spark, sf).filter(F.col("dataset_version") == newest).select("dataset_version")


@query
def complete_runs(spark, sf):
    """Completion records written from orders, judged: counts per problem."""
    return shape_runs.judged_records(t.run_records(spark, sf)).groupBy("problem").agg(
        F.count(F.lit(1)).alias("records")
    )


@query
def newest_complete_run(spark, sf):
    """Per customer, the newest order whose record is valid."""
    judged = shape_runs.judged_records(t.run_records(spark, sf))
    return shape_runs.newest_complete_run(judged, ("o_custkey",))
