"""Validation of staged and loaded tables, and reconciliation of events with versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.errors import StagingValidationError


def key_counts(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: rows and distinct keys. Equal keys combine before the shuffle."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
    )


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def validate_staging(
    df: DataFrame, name: str, key: Sequence[str], expected_rows: int
) -> DataFrame:
    """Violations of a staged table: table, problem. Empty when it may be published."""
    counted = key_counts(df, key)
    problems = F.array_compact(F.array(
        F.when(
            F.col("rows") != expected_rows,
            F.format_string(f"{name}: staged %d rows, manifest says {expected_rows}", "rows"),
        ),
        F.when(
            F.col("distinct_keys") != F.col("rows"),
            F.format_string(f"{name}: %d duplicate keys", F.col("rows") - F.col("distinct_keys")),
        ),
    ))
    return counted.select(F.lit(name).alias("table"), F.explode(problems).alias("problem"))


def require_valid_staging(df: DataFrame, name: str, key: Sequence[str], expected: int) -> None:
    bad = validate_staging(df, name, key, expected).collect()
    if bad:
        raise StagingValidationError("; ".join(r["problem"] for r in bad))


def unmatched_versions(versions: DataFrame, outbox: DataFrame) -> DataFrame:
    """Versions without their import event, and events for versions never imported."""
    events = outbox.filter(F.col("event_type") == "dataset_imported").select("dataset_version")
    without = versions.select("dataset_version").join(events, "dataset_version", "left_anti")
    ahead = events.join(versions.select("dataset_version"), "dataset_version", "left_anti")
    return without.select("dataset_version", F.lit("version without event").alias("problem")).union(
        ahead.select("dataset_version", F.lit("event without version").alias("problem"))
    )
