"""Streams over the store: ingesting sealed stages, importing versions, and update feeds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quayside.plans import files
from quayside.plans.ingest import RunResult, run_ingest
from quayside.plans.serving import Serving, import_pending, judge_pending
from quayside.sources.pages import read_staged

COMMIT = "dataset_version bigint, logical_input_id string, manifest_path string, " \
         "manifest_sha256 string"


def ingest_stream(
    stages: DataFrame, root: str, store: str, checkpoint: str, *, source: str,
    on_result: Callable[[RunResult], None] = lambda result: None, **options,
) -> StreamingQuery:
    """Each sealed stage is one ingestion run, in the order in which stages are announced.

    `stages` is `sources.pages.stream_stages` over `root`. What the stream reads are announcements, so
    the pages of a request may land in any number of files, before and between runs: they are read
    together once the stage's index names them. A stage replayed after a crash has the same identity
    and is a no-op. Late and out-of-order retrievals are ordered per observation by the merge, not
    by an event-time watermark.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        for row in batch.select("stage").distinct().orderBy("stage").collect():  # stages_per_batch rows
            pages, requests = read_staged(spark, f"{root}/stages/{row['stage']}")
            on_result(run_ingest(spark, store, pages, requests, source=source, **options))

    return (
        stages.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_versions(spark: SparkSession, store: str) -> DataFrame:
    """Commit records as they appear."""
    return spark.readStream.schema(COMMIT).option("multiLine", True).json(f"{store}/published")


def consume_versions(
    stream: DataFrame, serving: Serving, store: str, checkpoint: str,
    on_fired: Callable[[int], None] = lambda alerts: None,
) -> StreamingQuery:
    """Import newly published versions and judge them, in version order."""

    def run(batch: DataFrame, batch_id: int) -> None:
        import_pending(serving, store)
        on_fired(judge_pending(serving))

    return (
        stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def newest_update(versions_table: DataFrame, last_sent: int | None) -> int | None:
    """The version to announce: the newest, if it is not the last one sent. Versions that were
    missed in between are coalesced into it."""
    newest = versions_table.agg(F.max("dataset_version").alias("v")).collect()[0]["v"]
    return None if newest is None or newest == last_sent else newest


def update_stream(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Announce below `out` the newest version of each micro-batch, unless one as new was announced.

    What was announced is part of the sink: a batch owns its folder, looks at the folders of the batches
    before it, and rewrites its own on a retry. A restart from `checkpoint` therefore goes on after
    the last announcement, and no version is announced twice.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = announced(spark, out).filter(F.col("batch") < batch_id)
        last = earlier.agg(F.max("dataset_version")).first()[0]
        newest = batch.agg(F.max("dataset_version").alias("dataset_version"))
        newest.filter(F.col("dataset_version") > F.lit(-1 if last is None else last)).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def announced(spark: SparkSession, out: str) -> DataFrame:
    """The versions announced below `out`, each with the batch that announced it."""
    schema = "dataset_version bigint, batch bigint"
    if not files.names(spark, out):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(out)
