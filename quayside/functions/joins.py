"""Joins of large tables with lookup tables, whatever their size and skew."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
SALTS = 32
#: Bits of a screen: 512 KB.
SCREEN_BITS = 1 << 22


def is_small(table: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a table has at most `rows` rows.

    A plain count is summed on the cluster; a limit first would gather up to `rows` rows of every
    partition in one task.
    """
    return table.count() <= rows


def salted(rows: DataFrame, spread: Sequence[str], salts: int = SALTS) -> DataFrame:
    return rows.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))


def per_salt(table: DataFrame, salts: int = SALTS) -> DataFrame:
    return table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def lookup(
    rows: DataFrame, table: DataFrame, on: Sequence[str], spread: Sequence[str],
    how: str = "left", limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join rows with a smaller table.

    A table counted to be small is broadcast, and the rows are not moved at all. A larger one is
    repeated per salt, and the rows of one key are spread over as many tasks by `spread`, so a key
    that holds a third of the rows is no bottleneck.
    """
    if is_small(table, limit):
        return rows.join(F.broadcast(table), list(on), how)
    return salted(rows, spread).join(per_salt(table), [*on, "_salt"], how).drop("_salt")


def flag(
    rows: DataFrame, keys: DataFrame, on: Sequence[str], spread: Sequence[str], into: str
) -> DataFrame:
    """Add `into`: whether the row's key is in `keys`, which holds each key once. Always salted,
    because `keys` is a result whose size is not known before it is computed."""
    hit = per_salt(keys.select(*on, F.lit(True).alias("_hit")))
    joined = salted(rows, spread).join(hit, [*on, "_salt"], "left")
    return joined.withColumn(into, F.col("_hit").isNotNull()).drop("_salt", "_hit")


def screened(rows: DataFrame, keys: DataFrame, on: Sequence[str], bits: int = SCREEN_BITS) -> DataFrame:
    """The rows whose key may be in `keys`; those left out are certainly not.

    The keys set bits of a Bloom filter of fixed size, by bitmap aggregates that combine before the
    shuffle. The filter is one row, sent to every task, and looked up as an expression, so no row of
    `rows` is moved. With far more keys than `bits`, all rows pass.
    """
    place = F.pmod(F.xxhash64(*on), F.lit(bits).cast("long"))
    maps = keys.select(place.alias("_place")).groupBy(F.bitmap_bucket_number("_place").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bits"))
    # At most bits / 32,768 rows of 4 KB each, whatever the number of keys.
    whole = maps.agg(F.map_from_entries(F.collect_list(F.struct("_bucket", "_bits"))).alias("_maps"))
    asked = rows.withColumns({"_place": place, "_one": F.lit(1)}).join(F.broadcast(whole.withColumn("_one", F.lit(1))), "_one")
    held = F.try_element_at("_maps", F.bitmap_bucket_number("_place"))
    at = F.bitmap_bit_position("_place")
    byte = F.conv(F.hex(F.substring(held, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (at % 8).cast("int"))) != 0
    return asked.filter(F.coalesce(hit, F.lit(False))).select(*rows.columns)
