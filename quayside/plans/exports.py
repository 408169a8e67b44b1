"""CSV exports whose first lines carry the labels that must travel with the numbers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.operators.curves import DISCLAIMER, position_order

SYNTHETIC = "SYNTHETIC DATA"


def labels(version: int | None = None, source: str | None = None, created_at: str | None = None,
           disclaimer: str = DISCLAIMER) -> list[str]:
    """The comment lines of an export: disclaimer, synthetic marker, version line."""
    lines = [f"# {disclaimer}"]
    if source == "synthetic":
        lines.append(f"# {SYNTHETIC}")
    if version is not None:
        lines.append(
            f"# dataset_version={version} source={source} dataset_created_at={created_at}"
        )
    return lines


def csv_lines(df: DataFrame, comments: Sequence[str], order: Sequence) -> DataFrame:
    """The export as sorted text lines: comments, the header, then the rows in `order`.

    The sort spreads over the cluster by ranges, so an export of any size works: its part files
    in name order are the file.
    """
    row = F.to_csv(F.struct(*[F.col(c).cast("string").alias(c) for c in df.columns]))
    keys = [f"k{i}" for i in range(len(order))]
    body = df.select(
        F.lit(1).alias("block"), F.lit(0).alias("line_no"), row.alias("value"),
        *[(F.col(c) if isinstance(c, str) else c).alias(k) for k, c in zip(keys, order)],
    )
    head = [*comments, ",".join(df.columns)]
    top = df.sparkSession.createDataFrame(
        [(0, i, text) for i, text in enumerate(head)], "block int, line_no int, value string"
    )
    lines = body.unionByName(top, allowMissingColumns=True)
    return lines.orderBy("block", "line_no", *keys).select("value")


def export_curves(points: DataFrame, path: str, as_of: date | None = None) -> None:
    """One as-of date (the latest by default) of all curves, with the disclaimer on top."""
    if as_of is None:
        as_of = points.agg(F.max("as_of_date").alias("d")).collect()[0]["d"]
    chosen = points.filter(F.col("as_of_date") == F.lit(as_of))
    write_lines(csv_lines(chosen, labels(), ["curve_id", "as_of_date", position_order()]), path)


def export_table(
    df: DataFrame, path: str, order: Sequence, *, version: int, source: str, created_at: str
) -> None:
    """A labelled export of a report such as `latest_points` or `curve_history`."""
    write_lines(csv_lines(df, labels(version, source, created_at, DISCLAIMER + "."), order), path)


def write_lines(lines: DataFrame, path: str) -> None:
    lines.write.mode("errorifexists").text(path)
