"""Strict parsing of page rows into typed observations, and rows refused with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.dates import iso_date, iso_week_date
from quayside.functions.joins import flag, lookup, screened
from quayside.functions.text import quoted, shown
from quayside.schemas import OBSERVATION_KEY, REJECTED, SILVER, conform

# The price contract, its accepted text form and the conflict reason.
PRICE_SCALE, INTEGER_DIGITS = 6, 12
NUMERIC = r"^-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?\z"
CONFLICT = "conflicting duplicate in batch"


def price_check(text: Column, kind: Column) -> Column:
    """Which rule a JSON value breaks as a price, null if none. `kind` is its VARIANT schema."""
    whole = F.length(F.split_part(F.ltrim(text, F.lit("-")), F.lit("."), F.lit(1)))
    decimals = F.length(F.split_part(text, F.lit("."), F.lit(2)))
    # JSON integers beyond 64 bits arrive as DECIMAL(p,0); a JSON number with a point does not
    # have 19 digits and no decimals.
    large_int = kind.rlike(r"^DECIMAL\((19|[23][0-9]),0\)$")
    return (
        F.when(kind.isNull() | kind.isin("VOID", "BOOLEAN"), "missing")
        .when(kind.startswith("ARRAY"), "list")
        .when(kind.startswith("OBJECT"), "dict")
        .when(~kind.isin("STRING", "BIGINT") & ~large_int, "float")
        .when(~text.rlike(NUMERIC), "malformed")
        .when(decimals > PRICE_SCALE, "decimals")
        .when(whole > INTEGER_DIGITS, "digits")
    )


def price_reason(text: Column, check: Column) -> Column:
    """The reason shown for a broken price rule."""
    return (
        F.when(check == "missing", "missing or non-numeric value")
        .when(check.isin("list", "dict", "float"),
              F.concat(F.lit("unsupported value type "), check))
        .when(check == "malformed", F.concat(F.lit("malformed numeric string "), quoted(text)))
        .when(check == "decimals",
              F.concat(F.lit(f"more than {PRICE_SCALE} decimal places: "), quoted(text)))
        .when(check == "digits",
              F.concat(quoted(text), F.lit(f" exceeds Decimal(18, {PRICE_SCALE})")))
    )


def parse_rows(rows: DataFrame, catalog: DataFrame, input_id: str) -> DataFrame:
    """Every page row with its typed columns and `reason`, null when the row is accepted.

    The first failing check gives the reason, in the order series, unit, period, price. The steps
    are separate projections on purpose: each stays small enough to be compiled.
    """
    cells = ("series", "units", "period", "value")
    col = F.col
    raw = rows.select(
        "*", *[F.try_variant_get("row", f"$.{n}", "variant").alias(n) for n in cells]
    )
    texts = raw.select(
        "source", "request_id", "page_no", "row_no", "retrieved_at", "raw_artifact_key", "row",
        *[F.schema_of_variant(n).alias(f"{n}_kind") for n in cells],
        *[F.coalesce(col(n).try_cast("string"), F.to_json(n)).alias(n) for n in cells],
    ).withColumn("series_id", F.when(col("series_kind") == "STRING", col("series")))
    units = catalog.select("series_id", col("unit").alias("unit"))
    known = lookup(texts, units, ["series_id"], ["raw_artifact_key", "row_no"])
    dated = known.withColumn("day", F.coalesce(iso_date(col("period")), iso_week_date(col("period"))))
    check = (
        F.when(col("unit").isNull(), "series")
        .when(F.coalesce((col("units_kind") != "STRING") | (col("units") != col("unit")),
                         F.lit(True)), "units")
        .when(col("day").isNull(), "period")
        .when(F.length("period") != 10, "daily")
        .otherwise(price_check(col("value"), col("value_kind")))
    )
    checked = dated.withColumn("check", check).withColumn(
        "price", F.when(col("check").isNull(), col("value").try_cast("decimal(18,6)"))
    )
    show = lambda n: shown(col(n), col(f"{n}_kind"))
    reason = (
        F.when(col("check").isNull(), F.lit(None).cast("string"))
        .when(col("check") == "series", F.concat(F.lit("unknown series "), show("series")))
        .when(col("check") == "units", F.concat(
            F.lit("unit "), show("units"), F.lit(", expected "), quoted(col("unit"))))
        .when(col("check") == "period", F.concat(F.lit("unparseable period "), show("period")))
        .when(col("check") == "daily",
              F.concat(F.lit("period is not a daily date: "), show("period")))
        .otherwise(price_reason(col("value"), col("check")))
    )
    return checked.select(
        "source", "series_id", col("day").alias("observation_date"), "price", "unit",
        (col("price") <= 0).alias("non_positive"), "retrieved_at",
        F.lit(input_id).alias("logical_input_id"), "raw_artifact_key", "request_id", "page_no",
        "row_no", F.when(col("check").isNotNull(), F.to_json("row")).alias("row_json"),
        reason.alias("reason"),
    )


def split_parsed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(silver, rejected) from parsed rows.

    Equal duplicates of a key collapse to the first in page order. A key with different prices is
    a conflict, and all its rows are rejected. Duplicates combine before the shuffle, and the
    rejected copies of one key are spread over many tasks, so a key that fills a batch is fine. Rows
    refused for themselves are never moved.
    """
    accepted = parsed.filter("reason is null")
    place = F.struct("request_id", "page_no", "row_no")
    rest = F.struct(*[c for c in SILVER.names if c not in OBSERVATION_KEY])
    per_key = accepted.groupBy(*OBSERVATION_KEY).agg(
        F.min_by(rest, place).alias("_first"),
        F.min("price").alias("_low"), F.max("price").alias("_high"),
    )
    silver = per_key.filter("_low = _high").select(*OBSERVATION_KEY, "_first.*")
    conflicts = per_key.filter("_low <> _high").select(*OBSERVATION_KEY)
    refused = parsed.filter("reason is not null").select("source", "raw_artifact_key", "row_json", "reason")
    # Nearly all accepted rows are told apart from conflicting ones where they are; only suspects are moved.
    suspects = screened(accepted, conflicts, OBSERVATION_KEY)
    spread = ["raw_artifact_key", "row_no"]
    clashing = flag(suspects, conflicts, OBSERVATION_KEY, spread, "_conflict").filter("_conflict").select(
        "source", "raw_artifact_key", F.to_json(F.struct(*sorted(SILVER.names))).alias("row_json"),
        F.lit(CONFLICT).alias("reason"))
    return conform(silver, SILVER), conform(refused.unionByName(clashing), REJECTED)


def parse_observations(
    rows: DataFrame, catalog: DataFrame, input_id: str
) -> tuple[DataFrame, DataFrame]:
    """(silver, rejected) straight from page rows."""
    return split_parsed(parse_rows(rows, catalog, input_id))


def silver_integrity(silver: DataFrame) -> DataFrame:
    """How many prices are null; anything but 0 means values were lost while typing."""
    return silver.agg(F.count_if(F.col("price").isNull()).alias("null_prices"))
