"""Merging a batch of observations into the current table, with a revision history."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.schemas import GOLD, OBSERVATION_KEY, REVISION, SILVER, conform

KINDS = ("inserted", "revised", "unchanged", "stale", "seen")


class Merged(NamedTuple):
    current: DataFrame
    revisions: DataFrame
    stats: DataFrame
    stale: DataFrame


def changes(current: DataFrame, silver: DataFrame) -> DataFrame:
    """One row per key of either side: the key, struct `old`, struct `new` and `kind`.

    A retrieval is later when it is strictly after the observation's `last_seen_at`, whether or
    not the price moved then:

    new key -> inserted; later and different -> revised; later and same -> seen; not later and
    different -> stale; not later and same -> unchanged; no incoming row -> kept.

    Both sides hold a key once, so one full outer join on the key decides everything.
    """
    cells = lambda schema: F.struct(
        *[c for c in schema.names if c not in OBSERVATION_KEY]
    )
    old = conform(current, GOLD).select(*OBSERVATION_KEY, cells(GOLD).alias("old"))
    new = conform(silver, SILVER).select(*OBSERVATION_KEY, cells(SILVER).alias("new"))
    differs = F.col("new.price") != F.col("old.price")
    later = F.col("new.retrieved_at") > F.col("old.last_seen_at")
    kind = (
        F.when(F.col("new").isNull(), "kept")
        .when(F.col("old").isNull(), "inserted")
        .when(later & differs, "revised")
        .when(later, "seen")
        .when(differs, "stale")
        .otherwise("unchanged")
    )
    return old.join(new, OBSERVATION_KEY, "full_outer").withColumn("kind", kind)


def current_cells() -> dict[str, Column]:
    """The non-key columns of the current row a change leaves behind."""
    takes_new = F.col("kind").isin("inserted", "revised")
    cells = {
        c: F.when(takes_new, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}"))
        for c in SILVER.names if c not in OBSERVATION_KEY
    }
    cells["last_seen_at"] = F.when(
        takes_new | (F.col("kind") == "seen"), F.col("new.retrieved_at")
    ).otherwise(F.col("old.last_seen_at"))
    return cells


def superseded_cells(version: int | Column, input_id: str | Column) -> dict[str, Column]:
    """The non-key columns of the row a revision moves into the history."""
    cells = {c: F.col(f"old.{c}") for c in GOLD.names if c not in OBSERVATION_KEY}
    cells["superseded_at_version"] = F.lit(version)
    cells["superseded_by_logical_input_id"] = F.lit(input_id)
    return cells


def current_of(changed: DataFrame) -> DataFrame:
    """The current table after the merge."""
    cells = [c.alias(n) for n, c in current_cells().items()]
    return conform(changed.select(*OBSERVATION_KEY, *cells), GOLD)


def superseded_of(
    changed: DataFrame, version: int | Column, input_id: str | Column
) -> DataFrame:
    """The rows a merge moves into the revision history."""
    cells = [c.alias(n) for n, c in superseded_cells(version, input_id).items()]
    return conform(
        changed.filter("kind = 'revised'").select(*OBSERVATION_KEY, *cells), REVISION
    )


def stats_columns() -> list[Column]:
    """The merge counters as aggregates over `kind`."""
    counts = {k: F.count_if(F.col("kind") == k) for k in KINDS}
    moved = counts["inserted"] + counts["revised"]
    return [
        *[counts[k].alias(k) for k in KINDS],
        moved.alias("price_changes"),
        (moved + counts["seen"] > 0).alias("state_changed"),
    ]


def stale_notes(changed: DataFrame) -> DataFrame:
    """Stale rows with the note shown in warnings, ordered by key for a stable top of the list."""
    note = F.format_string(
        "%s %s: retrieval %s is not later than last seen %s; kept current value",
        "series_id", F.col("observation_date").cast("string"),
        F.col("new.retrieved_at").cast("string"), F.col("old.last_seen_at").cast("string"),
    )
    return changed.filter("kind = 'stale'").select(*OBSERVATION_KEY, note.alias("note"))


def merge_gold(
    current: DataFrame, revisions: DataFrame, silver: DataFrame, version: int, input_id: str
) -> Merged:
    """(current, revisions, stats, stale) after merging `silver`. All four read one join, so a
    caller that needs several of them writes or caches `changes` first (as `plans.ingest` does)."""
    changed = changes(current, silver)
    return Merged(
        current_of(changed),
        conform(revisions, REVISION).unionByName(superseded_of(changed, version, input_id)),
        changed.agg(*stats_columns()),
        stale_notes(changed),
    )
