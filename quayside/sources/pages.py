"""Landed API pages: reading, staging, redaction, reconciliation and exploding into rows.

A page is one API response of at most a few thousand rows. Its body stays text until
`page_rows`, where every cell becomes a VARIANT, because the JSON kind of a value decides whether
it is accepted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.errors import PageError, StagingError
from quayside.functions.text import redact
from quayside.schemas import PAGE, conform

DATA, TOTAL = "$.response.data", "$.response.total"
INDEX = "request_id string, page_no int, staged_sha256 string"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages landed as JSON lines, one envelope (`schemas.PAGE`) per line."""
    return spark.read.schema(PAGE).json(path)


def stream_pages(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """The same landing folder as a stream."""
    reader = spark.readStream.schema(PAGE).option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def read_page_files(
    spark: SparkSession, path: str, *, source: str, request_id: str, route: str, retrieved_at,
    secret: str | None = None,
) -> DataFrame:
    """Raw response files, one page each, numbered by file name and redacted before hashing.

    The file name decides the page number (its last run of digits), so no ordering pass over the
    files is needed.
    """
    raw = spark.read.format("binaryFile").load(path)
    body = redact(F.decode("content", "utf-8"), secret)
    number = F.regexp_extract("path", r"([0-9]+)[^0-9/]*$", 1).try_cast("int")
    return with_hash(
        raw.select(
            F.lit(source).alias("source"), F.lit(request_id).alias("request_id"),
            number.alias("page_no"), F.lit(route).alias("route"),
            F.lit(None).cast("map<string,string>").alias("params"),
            F.lit(retrieved_at).cast("timestamp").alias("retrieved_at"), body.alias("body"),
        )
    )


def with_hash(pages: DataFrame) -> DataFrame:
    return conform(pages.withColumn("sha256", F.sha2("body", 256)), PAGE)


def land_pages(pages: DataFrame, path: str) -> None:
    """Write pages under a folder that must not exist yet."""
    conform(pages, PAGE).write.mode("errorifexists").json(path)


def add_pages(pages: DataFrame, folder: str) -> None:
    """Land some of a stage's pages; a request may arrive in any number of files and at any time."""
    conform(pages, PAGE).write.mode("append").json(f"{folder}/pages")


def seal_stage(index: DataFrame, folder: str, requests: DataFrame) -> None:
    """Name the pages a stage consists of (request_id, page_no, sha256). The index is written last: it is
    what makes the stage complete."""
    requests.write.mode("errorifexists").json(f"{folder}/requests")
    named = index.select("request_id", "page_no", F.col("sha256").alias("staged_sha256"))
    named.write.mode("errorifexists").json(f"{folder}/index")


def stage_pages(pages: DataFrame, folder: str, requests: DataFrame) -> None:
    """Stage a run at once: pages first, then the index that marks the stage complete."""
    land_pages(pages, f"{folder}/pages")
    seal_stage(pages, folder, requests)


def read_staged(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Replay exactly the pages a stage's index names: (pages, requests).

    Refuses a stage without its index, and one of whose named pages any is missing or has other
    bytes than were staged. Pages that the index does not name are not part of the stage.
    """
    from quayside.plans.files import exists
    from quayside.schemas import REQUEST

    if not exists(spark, f"{folder}/index/_SUCCESS"):
        raise StagingError(f"{folder} has no finished index, so its pages may not all be there")
    index = spark.read.schema(INDEX).json(f"{folder}/index")
    landed = read_pages(spark, f"{folder}/pages").withColumn("_sha256", F.sha2("body", 256))
    key = ["request_id", "page_no"]
    pages = landed.join(index, key).filter("_sha256 = staged_sha256")
    pages = conform(pages.dropDuplicates([*key, "_sha256"]), PAGE)
    lost = index.join(pages.select(*key), key, "left_anti").limit(1).collect()
    if lost:
        raise StagingError(f"page {lost[0]['page_no']} of {lost[0]['request_id']} is missing or was changed after staging")
    return pages, spark.read.schema(REQUEST).json(f"{folder}/requests")


def announce_stage(spark: SparkSession, root: str, name: str) -> bool:
    """Tell streams that the stage `root`/stages/`name` is sealed; False if they were told before."""
    from quayside.plans.files import create_json

    return create_json(spark, f"{root}/sealed/{name}.json", {"stage": name})


def stream_stages(spark: SparkSession, root: str, stages_per_batch: int = 1) -> DataFrame:
    """The sealed stages below `root` as they are announced. The folder `sealed` must exist."""
    reader = spark.readStream.schema("stage string").option("maxFilesPerTrigger", stages_per_batch)
    return reader.option("multiLine", True).json(f"{root}/sealed")


def staged_differences(pages: DataFrame, index: DataFrame) -> DataFrame:
    """Pages whose actual body hash differs from the index, or that only one side has."""
    actual = pages.select("request_id", "page_no", F.sha2("body", 256).alias("actual_sha256"))
    both = actual.join(index, ["request_id", "page_no"], "full_outer")
    return both.filter(~F.col("actual_sha256").eqNullSafe(F.col("staged_sha256")))


def redact_pages(pages: DataFrame, secret: str | None) -> DataFrame:
    return with_hash(pages.withColumn("body", redact(F.col("body"), secret)))


def _document() -> Column:
    return F.try_parse_json("body")


def page_shape_errors(pages: DataFrame) -> DataFrame:
    """Pages that are not API responses: request_id, page_no, detail."""
    doc = _document()
    data_kind = F.schema_of_variant(F.try_variant_get(doc, DATA, "variant"))
    detail = (
        F.when(doc.isNull(), "the body is not JSON")
        .when(data_kind.isNull() | ~data_kind.startswith("ARRAY"), "response.data is not a list")
        .when(_total(doc).isNull(), "response.total is not an integer")
        .when(F.col("page_no").isNull(), "the page has no number")
    )
    return pages.select("request_id", "page_no", detail.alias("detail")).filter("detail is not null")


def _total(doc: Column) -> Column:
    return F.try_variant_get(doc, TOTAL, "string").try_cast("bigint")


def page_rows(pages: DataFrame) -> DataFrame:
    """One row per observation cell group: the page's lineage, `row_no` and the row as VARIANT."""
    doc = _document()
    return pages.select(
        "source", "request_id", "page_no", "retrieved_at",
        F.format_string("%s/page-%04d.json", "request_id", "page_no").alias("raw_artifact_key"),
        F.posexplode(F.try_variant_get(doc, DATA, "array<variant>")).alias("row_no", "row"),
    )


def reconcile_pages(pages: DataFrame) -> DataFrame:
    """Violations per request: request_id, kind, detail.

    A row that occurs twice, on two pages or on one; a total that changes between pages; a row count
    that is not the total.
    """
    doc = _document()
    sized = pages.select(
        "request_id", _total(doc).alias("total"),
        F.size(F.try_variant_get(doc, DATA, "array<variant>")).alias("rows"),
    )
    per_request = sized.groupBy("request_id").agg(
        F.min("total").alias("low"), F.max("total").alias("high"), F.sum("rows").alias("rows")
    )
    changed = per_request.filter("low <> high").select(
        "request_id", F.lit("total changed").alias("kind"),
        F.format_string("%d -> %d", "low", "high").alias("detail"),
    )
    short = per_request.filter("low = high and rows <> low").select(
        "request_id", F.lit("row count").alias("kind"),
        F.format_string("received %d rows, API reported %d", "rows", "low").alias("detail"),
    )
    cell = lambda name: F.try_variant_get("row", f"$.{name}", "string").alias(name)
    repeated = (
        page_rows(pages)
        .select("request_id", "page_no", cell("series"), cell("period"))
        .groupBy("request_id", "series", "period")
        .agg(F.count(F.lit(1)).alias("times"), F.min("page_no").alias("first"), F.max("page_no").alias("last"))
        .filter("times > 1")
        .select(
            "request_id", F.lit("repeated row").alias("kind"),
            F.format_string("%s %s on pages %d and %d", "series", "period", "first", "last")
            .alias("detail"),
        )
    )
    return changed.unionByName(short).unionByName(repeated)


def require_clean_pages(pages: DataFrame) -> None:
    """Refuse the fetch if any page is malformed or the pages do not reconcile."""
    bad = page_shape_errors(pages).limit(1).collect()
    if bad:
        raise PageError(f"{bad[0]['request_id']}/page {bad[0]['page_no']}: {bad[0]['detail']}")
    bad = reconcile_pages(pages).limit(1).collect()
    if bad:
        raise PageError(f"{bad[0]['request_id']}: {bad[0]['kind']}: {bad[0]['detail']}")
