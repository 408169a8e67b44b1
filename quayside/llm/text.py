"""What the operators share: words, lower case, row keys, and tables written between steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import scratch, shared_folder

#: Words are whatever stands between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A to Z only. Texts that are all ASCII take the faster built-in."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def without_space(text: Column) -> Column:
    """The text without ASCII white space."""
    return F.translate(text, SPACE, "")


def words(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+")
    )


def count_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def is_fold(doc_id: Column, modulus: int, fold: int) -> Column:
    """Whether a row falls in the held-out fold; a null id never does."""
    return F.coalesce(remainder(doc_id, modulus) == fold, F.lit(False))


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    What follows depends on files that outlive any executor, and the planner knows their size.
    """
    shared_folder(df.sparkSession)
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def narrow(table: DataFrame, rows: int = 500_000) -> DataFrame:
    """A join side of a few numbers per row: broadcast if counted to have at most `rows` rows (some
    tens of MB), so that the other side's texts stay where they are; else left to the planner."""
    return F.broadcast(table) if table.count() <= rows else table
