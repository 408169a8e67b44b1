"""Loading verified tables into a warehouse folder: all of them, verified twice, or none."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.errors import IntegrityError, LoadMismatch, LoadRefused
from quayside.functions.digests import fingerprint
from quayside.operators.shape import params_sha256
from quayside.plans import files
from quayside.plans.shape_runs import choose_run, verify_shape_run
from quayside.plans.versions import read_table, read_version
from quayside.schemas import CURVE, GOLD, LOAD_LOG, PARAMS, REVISION, empty

TABLES = {
    "shape_params": PARAMS, "observations": GOLD, "revisions": REVISION, "curve_points": CURVE,
}
GOLD_OF = {
    "observations": "gold_current", "revisions": "gold_revisions", "curve_points": "gold_curves",
}


def load_table(
    df: DataFrame, folder: str, name: str, source_id: str, expected_rows: int, sha256: str
) -> dict:
    """Write one table to a new folder and verify what can be read back. Returns its log row.

    The content is compared by its order-independent digest, so every value is checked in one
    distributed pass.
    """
    spark, schema = df.sparkSession, TABLES[name]
    if df.columns != schema.names:
        raise LoadRefused(f"{name}: the columns are not the table's columns, in order")
    before = fingerprint(df).collect()[0]
    if before["rows"] != expected_rows:
        raise LoadRefused(f"{name}: the row count is not the manifest's")
    df.write.mode("errorifexists").parquet(f"{folder}/{name}")
    after = fingerprint(spark.read.schema(schema).parquet(f"{folder}/{name}")).collect()[0]
    if after != before:
        raise LoadMismatch(f"{name} holds {after['rows']} rows, not the verified {expected_rows}")
    return {
        "table_name": name, "source_id": source_id, "row_count": expected_rows, "sha256": sha256,
        "loaded_at": datetime.now(UTC).isoformat(),
    }


def load_warehouse(
    spark: SparkSession, warehouse: str, store: str, shapes: str, run_id: str | None = None,
    dry_run: bool = False,
) -> list[dict]:
    """Load one shape run and the newest published version.

    Everything is verified before the first write. The load goes to a new folder and becomes
    current with its record, so a failed load leaves the previous one in place.
    """
    run = choose_run(spark, shapes, run_id)
    params, digest = verify_shape_run(spark, shapes, run)
    version = read_version(spark, store)
    if not version.number:
        raise LoadRefused("nothing is published")
    missing = [n for n in GOLD_OF.values() if n not in version.tables]
    if missing:
        raise LoadRefused(f"{missing[0]} is not in the manifest")
    try:
        tables = {t: read_table(spark, store, version, n) for t, n in GOLD_OF.items()}
    except IntegrityError as error:
        raise LoadRefused(str(error)) from error
    if dry_run:
        return []
    folder = f"{warehouse}/loads/{uuid.uuid4().hex}"
    try:
        log = [load_table(params, folder, "shape_params", run, 48, digest)]
        for table, df in tables.items():
            name = GOLD_OF[table]
            log.append(load_table(
                df, folder, table, f"{name}@v{version.number}", version.manifest["rows"][name],
                version.manifest_sha256,
            ))
        back = spark.read.schema(PARAMS).parquet(f"{folder}/shape_params")
        if params_sha256(back) != digest:
            raise LoadMismatch("the shape rows read back do not rebuild the recorded hash")
    except Exception:
        files.remove(spark, folder)
        raise
    number = len(files.names(spark, f"{warehouse}/current")) + 1
    record = {"folder": folder, "log": log}
    if not files.create_json(spark, f"{warehouse}/current/{number:08d}.json", record):
        raise LoadMismatch("another load was recorded meanwhile")
    return log


def current_load(spark: SparkSession, warehouse: str) -> dict | None:
    found = files.names(spark, f"{warehouse}/current")
    return files.read_json(spark, f"{warehouse}/current/{found[-1]}") if found else None


def read_loaded(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    load = current_load(spark, warehouse)
    if load is None:
        return empty(spark, TABLES[table])
    return spark.read.schema(TABLES[table]).parquet(f"{load['folder']}/{table}")


def load_log(spark: SparkSession, warehouse: str) -> DataFrame:
    """The log of the current load: table, source, rows, hash and time."""
    load = current_load(spark, warehouse)
    rows = [
        (r["table_name"], r["source_id"], r["row_count"], r["sha256"],
         datetime.fromisoformat(r["loaded_at"]))
        for r in (load or {"log": []})["log"]
    ]
    return spark.createDataFrame(rows, LOAD_LOG)


def create_views(spark: SparkSession, warehouse: str, prefix: str = "") -> None:
    """Name the current load's tables as temporary views for SQL."""
    for table in TABLES:
        read_loaded(spark, warehouse, table).createOrReplaceTempView(f"{prefix}{table}")


def verified_tables(spark: SparkSession, warehouse: str) -> DataFrame:
    """Rows per loaded table against its log row; equal when nothing moved since the load."""
    counts = None
    for table in TABLES:
        one = read_loaded(spark, warehouse, table).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(table).alias("table_name"), "rows"
        )
        counts = one if counts is None else counts.unionByName(one)
    log = load_log(spark, warehouse).select("table_name", "row_count")
    return counts.join(log, "table_name", "left")
