"""Content digests and name-based identifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fingerprint(
    df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """(rows, digest), for the table or per `by` group, whatever the row order or partitioning.

    A row is hashed with SHA-256 over its JSON text, which tells nulls from texts and columns from
    each other. The hashes are added up as pieces of 60 bits in wide decimals, so only partial sums
    are shuffled and any table size works; the digest is the SHA-256 of the row count and the sums.
    """
    names = list(columns or [c for c in df.columns if c not in by])
    text = F.to_json(F.struct(*names), {"ignoreNullFields": "false", "timeZone": "UTC"})
    hashed = df.select(*by, F.sha2(text, 256).alias("_h"))
    piece = lambda at, size: F.conv(F.substring("_h", at, size), 16, 10).cast("decimal(38,0)")
    sums = [
        F.coalesce(F.sum(piece(at, size)), F.lit(0)).cast("decimal(38,0)")
        for at, size in ((1, 15), (16, 15), (31, 15), (46, 15), (61, 4))
    ]
    rows = F.count(F.lit(1))
    total = F.concat_ws("|", *[c.cast("string") for c in (rows, *sums)])
    return hashed.groupBy(*by).agg(rows.alias("rows"), F.sha2(total, 256).alias("digest"))


def ordered_digest(df: DataFrame, order: Sequence[str], line: Column) -> DataFrame:
    """(rows, digest): SHA-256 over the lines in `order`, for tables of a fixed small size such as
    parameters. The lines meet in one row; `tree_digest` is the ordered digest of tables that grow."""
    return chunk_digests(df, (), order, line).select("rows", "digest")


def chunk_digests(df: DataFrame, chunk: Sequence[str], order: Sequence[str], line: Column) -> DataFrame:
    """`chunk` columns, rows and digest: SHA-256 over each chunk's lines in `order`. A chunk is one whose
    size its key bounds, as a month of a series; one changed chunk can be hashed again alone."""
    cell = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order)], line.alias("line"))
    lines = df.groupBy(*chunk).agg(
        F.count(F.lit(1)).alias("rows"), F.array_sort(F.collect_list(cell)).alias("_cells"))
    text = F.array_join(F.transform("_cells", lambda c: c["line"]), "")
    return lines.select(*chunk, "rows", F.sha2(text, 256).alias("digest"))


def fold_digests(chunks: DataFrame, levels: Sequence[Sequence[str]]) -> DataFrame:
    """(rows, digest) of a table from the digests of its chunks.

    `levels` names the key columns from fine to coarse, each a part of those before; the first are the
    chunks' own. A node of the next level hashes its children in key order, one line each of the
    child's key columns that it drops, rows and digest, comma-joined; nulls are written as `~`. So a
    node gathers only its own children.
    """
    held = chunks
    for fine, coarse in zip(levels, [*levels[1:], ()]):
        own = [c for c in fine if c not in coarse]
        shown = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in own]
        line = F.concat(F.concat_ws(",", *shown, F.col("rows").cast("string"), "digest"), F.lit("\n"))
        child = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(shown)], line.alias("line"))
        nodes = held.groupBy(*coarse).agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.array_sort(F.collect_list(child)).alias("_children"))
        text = F.array_join(F.transform("_children", lambda c: c["line"]), "")
        held = nodes.select(*coarse, "rows", F.sha2(text, 256).alias("digest"))
    return held


def tree_digest(
    df: DataFrame, levels: Sequence[Sequence[str]], order: Sequence[str], line: Column
) -> DataFrame:
    """(rows, digest) of a table of any size, sensitive to the order that its keys give: SHA-256 per chunk
    (the first of `levels`) over its lines in `order`, then over the digests, level by level."""
    return fold_digests(chunk_digests(df, levels[0], order, line), levels)


def uuid5(namespace: str, name: Column) -> Column:
    """The version-5 UUID of `name` in `namespace`, as its 36-character text."""
    raw = F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "utf-8"))
    digest = F.sha1(raw)
    # The two top bits of the variant digit are fixed to 10, the two low bits are kept.
    variant = F.translate(digest.substr(17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws(
        "-",
        digest.substr(1, 8),
        digest.substr(9, 4),
        F.concat(F.lit("5"), digest.substr(14, 3)),
        F.concat(variant, digest.substr(18, 3)),
        digest.substr(21, 12),
    )
