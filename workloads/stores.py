"""Stores built from the given tables by the library's own plans, for the queries that need one.

A store is built once per session and data folder, below the cluster's shared folder.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.parse import parse_rows
from quayside.operators.shape import METHOD_VERSION, params_sha256
from quayside.plans.ingest import ShapeInput, run_ingest
from quayside.plans.serving import Serving, import_pending
from quayside.plans.shape_runs import export_shape
from quayside.plans.warehouse import load_warehouse
from quayside.schemas import OBSERVATION_KEY, PAGE, REQUEST, conform
from quayside.session import scratch
from quayside.sources.pages import announce_stage, page_rows, stage_pages, stream_stages, with_hash
from quayside.streaming.feeds import ingest_stream
from workloads import tables as t

SOURCE = "lineitem"
FETCHES = {"F": "2003-01-01 00:00:00", "O": "2003-01-02 00:00:00"}


def fetched_prices(spark: SparkSession, sf: str, status: str) -> DataFrame:
    """The best price per series and date among the lines of one status, over all suppliers."""
    lines = t.cells(spark, sf).filter(F.col("l_linestatus") == status)
    best = lines.groupBy("series_id", "observation_date").agg(F.max("price").alias("price"))
    return best.select(F.lit(SOURCE).alias("source"), *OBSERVATION_KEY[1:], "price")


def fetched_pages(spark: SparkSession, sf: str, status: str) -> DataFrame:
    """One fetch as pages, one per series and year, so at most 366 rows each."""
    row = F.to_json(F.struct(
        F.col("observation_date").cast("string").alias("period"),
        F.col("series_id").alias("series"), F.lit("$/BBL").alias("units"),
        F.col("price").cast("string").alias("value"),
    ))
    rows = F.array_join(F.array_sort(F.collect_list(row)), ",")
    body = F.concat(
        F.lit('{"response":{"data":['), rows, F.lit('],"total":"'),
        F.count(F.lit(1)).cast("string"), F.lit('"}}'),
    )
    year = F.year("observation_date")
    laid = fetched_prices(spark, sf, status).groupBy("source", "series_id", year.alias("page_no"))
    request = F.concat_ws("-", F.lit(status), "series_id", "page_no")
    pages = laid.agg(body.alias("body")).select(
        "source", request.alias("request_id"), "page_no", F.lit("line items").alias("route"),
        F.lit(None).cast("map<string,string>").alias("params"),
        F.lit(FETCHES[status]).cast("timestamp").alias("retrieved_at"), "body",
    )
    return conform(with_hash(pages), PAGE)


def asked(pages: DataFrame) -> DataFrame:
    """One single-series request per page."""
    parts = F.split("request_id", "-")
    return pages.select(
        "request_id", F.array(parts[1]).alias("series_ids"),
        F.make_date("page_no", F.lit(1), F.lit(1)).alias("start"),
        F.make_date("page_no", F.lit(12), F.lit(31)).alias("end"),
    ).select(*REQUEST.names)


@lru_cache(maxsize=None)
def _built(application: str, sf: str) -> str:
    spark = SparkSession.active()
    store, params = scratch(spark, "store"), t.params(spark)
    shape = ShapeInput(params, params_sha256(params), METHOD_VERSION, SOURCE)
    for status in FETCHES:
        pages = fetched_pages(spark, sf, status)
        run_ingest(spark, store, pages, asked(pages), source=SOURCE, shape=shape)
    return store


def store(spark: SparkSession, sf: str) -> str:
    """A published store of two versions: the finished lines, then the open ones fetched later."""
    return _built(spark.sparkContext.applicationId, sf)


@lru_cache(maxsize=None)
def _parsed(application: str, sf: str) -> str:
    spark = SparkSession.active()
    path = scratch(spark, "parsed")
    parse_rows(page_rows(t.pages(spark, sf)), t.catalog(spark), "run-1").write.parquet(path)
    return path


def parsed(spark: SparkSession, sf: str) -> DataFrame:
    """The events' pages, parsed once as a run does: both outputs and the conflict check read them."""
    return spark.read.parquet(_parsed(spark.sparkContext.applicationId, sf))


@lru_cache(maxsize=None)
def _streamed(application: str, sf: str) -> str:
    spark = SparkSession.active()
    landing, target = scratch(spark, "landing"), scratch(spark, "streamed")
    for status in FETCHES:
        pages, folder = fetched_pages(spark, sf, status), f"{landing}/stages/{status}"
        # The rows of one request land in several files.
        stage_pages(pages.repartition(4, "body"), folder, asked(pages))
        announce_stage(spark, landing, status)
    query = ingest_stream(
        stream_stages(spark, landing), landing, target, scratch(spark, "checkpoint"), source=SOURCE)
    query.awaitTermination()
    return target


def streamed_store(spark: SparkSession, sf: str) -> str:
    """The same fetches, staged in several files each and ingested by a stream, one micro-batch per stage."""
    return _streamed(spark.sparkContext.applicationId, sf)


@lru_cache(maxsize=None)
def _served(application: str, sf: str) -> str:
    spark = SparkSession.active()
    serving = Serving(spark, scratch(spark, "serving"))
    import_pending(serving, store(spark, sf))
    return serving.root


def serving(spark: SparkSession, sf: str) -> Serving:
    """Both versions imported."""
    return Serving(spark, _served(spark.sparkContext.applicationId, sf))


@lru_cache(maxsize=None)
def _loaded(application: str, sf: str) -> str:
    spark = SparkSession.active()
    warehouse, shapes = scratch(spark, "warehouse"), scratch(spark, "shapes")
    export_shape(spark, t.params(spark), shapes, "fixed", {})
    load_warehouse(spark, warehouse, store(spark, sf), shapes)
    return warehouse


def warehouse(spark: SparkSession, sf: str) -> str:
    """The newest version and the fixed parameters loaded into a warehouse folder."""
    return _loaded(spark.sparkContext.applicationId, sf)
