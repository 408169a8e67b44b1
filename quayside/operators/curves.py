"""Modelled forward curves and spreads, with explicit gaps."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import ROUND_HALF_EVEN, Context, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.catalog import DEFAULT_CURVES, POSITIONS, CurveConfig
from quayside.errors import MixedSourceError, ShapeEstimationError
from quayside.functions.numeric import half_even
from quayside.schemas import CURVE

# Labels carried by every curve row.
ESTIMATE_TYPE = "modelled"
DISCLAIMER = "Modelled estimate, not market quotes"
FACTOR_SCALE = Decimal(1).scaleb(-18)
CONTEXT = Context(prec=34, rounding=ROUND_HALF_EVEN)


def position_order(position: Column | str = "position") -> Column:
    """Where a position stands in display order: Spot first, then C1 to C4."""
    column = F.col(position) if isinstance(position, str) else position
    return F.array_position(F.array(*map(F.lit, POSITIONS)), column).cast("int")


def factor_rows(params: DataFrame) -> list[tuple[int, list[tuple[str, Decimal]]]]:
    """Per month, each position with its factor exp(s). A parameter set has 48 rows by contract,
    so the 34-digit exponentials are taken on the driver, where decimal arithmetic has them. A set
    with a cell of the grid twice, or with more cells than the grid, is refused before."""
    cells, rows = params.select(
        F.count_distinct(F.struct("position", "month")), F.count(F.lit(1))
    ).first()
    if rows > cells or rows > 12 * len(POSITIONS):
        raise ShapeEstimationError(f"{rows} parameter rows for {cells} positions and months")
    months: dict[int, list[tuple[str, Decimal]]] = {}
    for r in params.orderBy("position", "month").collect():
        factor = CONTEXT.exp(r["s"]).quantize(FACTOR_SCALE, ROUND_HALF_EVEN, CONTEXT)
        months.setdefault(r["month"], [("Spot", Decimal(1))]).append((r["position"], factor))
    return sorted(months.items())


def shape_factors(params: DataFrame) -> DataFrame:
    """month, points: array of (position, factor). Twelve rows, so it is safe to broadcast."""
    return params.sparkSession.createDataFrame(
        factor_rows(params),
        "month int, points array<struct<position: string, factor: decimal(20,18)>>",
    )


def anchor_prices(
    current: DataFrame, anchors: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """One row per date on which at least one anchor has a spot, with a column per anchor."""
    of = lambda sid: F.max(F.when(F.col("series_id") == sid, F.col("price")))
    return (
        current.filter(F.col("series_id").isin(list(anchors)))
        .groupBy(*by, F.col("observation_date").alias("as_of_date"))
        .agg(*[of(a).alias(f"spot_{a}") for a in anchors])
    )


def newest_dates(spots: DataFrame, params: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Of `anchor_prices`, the rows that hold every position's latest point.

    A date offers the positions that its month's parameters name, so for each set of positions the newest
    date of the months with that set is enough: one row per `by` when all months name the same. The
    aggregate has columns of fixed width only, so it combines by hashing before the shuffle.
    """
    grids: dict[frozenset[str], list[int]] = {}
    for month, points in factor_rows(params):
        grids.setdefault(frozenset(position for position, _ in points), []).append(month)
    grid = F.lit(None).cast("int")
    for number, months in enumerate(grids.values()):
        grid = F.when(F.month("as_of_date").isin(months), number).otherwise(grid)
    rest = [c for c in spots.columns if c not in (*by, "as_of_date")]
    newest = spots.withColumn("_grid", grid).filter("_grid is not null").groupBy(*by, "_grid").agg(
        *[F.max_by(c, "as_of_date").alias(c) for c in rest], F.max("as_of_date").alias("as_of_date"))
    return newest.select(*spots.columns)


def _gap(anchor: str) -> Column:
    spot = F.col(f"spot_{anchor}")
    return F.when(
        spot.isNull(),
        F.concat(F.lit(f"no {anchor} spot on "), F.col("as_of_date").cast("string")),
    ).when(
        spot <= 0,
        F.concat(
            F.lit(f"non-positive {anchor} spot ("), spot.cast("string"),
            F.lit("); shape undefined"),
        ),
    )


def build_curves(
    current: DataFrame,
    params: DataFrame,
    *,
    params_sha256: str,
    shape_method_version: str,
    config: CurveConfig = DEFAULT_CURVES,
    by: Sequence[str] = (),
    newest: bool = False,
) -> DataFrame:
    """Curve points for every date with at least one anchor spot.

    Spot is the anchor rounded to 4 decimals, C_k is the anchor times exp(s[k, month]) rounded to
    4 decimals, and a spread is the exact difference of the two displayed prices. A missing or
    non-positive anchor is a gap with its reason; nothing is forward-filled.

    Anchors of a date meet in one grouped pass. Curves and positions are then unfolded row by row
    from the static configuration and twelve broadcast factor rows, so neither the dense grid nor
    the spread legs need a join of their own.

    `newest` builds only the dates that hold each position's latest point, for reads of the latest points.
    """
    if "source" in current.columns and not by:
        sources = [r[0] for r in current.select("source").distinct().limit(2).collect()]
        if len(sources) > 1:
            raise MixedSourceError(f"curve inputs come from several sources: {sorted(sources)}")
    anchor_of = {o.curve_id: o.anchor for o in config.outrights}
    anchors = sorted(set(anchor_of.values()))
    none = F.lit(None).cast("decimal(18,6)")

    def item(curve_id: str, kind: str, label: str, long: str, short: str | None) -> Column:
        gaps = [_gap(long)] + ([_gap(short)] if short else [])
        reason = F.concat_ws("; ", *gaps)
        return F.struct(
            F.lit(curve_id).alias("curve_id"), F.lit(kind).alias("kind"),
            F.lit(label).alias("shape_source"),
            F.col(f"spot_{long}").alias("long"),
            (F.col(f"spot_{short}") if short else none).alias("short"),
            F.when(reason != "", reason).alias("gap_reason"),
        )

    items = [
        item(o.curve_id, "outright", o.shape_source, o.anchor, None) for o in config.outrights
    ] + [
        item(s.curve_id, "spread", f"{s.long} minus {s.short}", anchor_of[s.long],
             anchor_of[s.short])
        for s in config.spreads
    ]
    factors = shape_factors(params)
    spots = anchor_prices(current, anchors, by)
    unfolded = (
        (newest_dates(spots, params, by) if newest else spots)
        .withColumn("month", F.month("as_of_date"))
        .join(F.broadcast(factors), "month", "left")
        .select(*by, "as_of_date", "points", F.inline(F.array(*items)))
        .select("*", F.inline("points"))
    )
    priced = lambda leg: half_even(F.col(leg) * F.col("factor"), 4)
    difference = priced("long") - F.when(F.col("short").isNotNull(), priced("short")).otherwise(
        F.lit(0).cast("decimal(18,4)")
    )
    price = F.when(F.col("gap_reason").isNull(), difference).cast("decimal(18,4)")
    labels = {
        "estimate_type": ESTIMATE_TYPE,
        "method_version": config.method_version,
        "shape_method_version": shape_method_version,
        "params_sha256": params_sha256,
    }
    points = unfolded.select(
        *by, "curve_id", "kind", "as_of_date", "position", price.alias("price"),
        F.when(F.col("gap_reason").isNull(), "ok").otherwise("gap").alias("status"),
        "gap_reason", "shape_source", *[F.lit(v).alias(k) for k, v in labels.items()],
    )
    return points.select(*by, *[F.col(f.name).cast(f.dataType) for f in CURVE.fields])


def curve_rule_violations(points: DataFrame) -> DataFrame:
    """Rows that break `(status = 'ok') = (price is not null)` or use an unknown status."""
    ok, priced = F.col("status") == "ok", F.col("price").isNotNull()
    return points.filter(~F.col("status").isin("ok", "gap") | (ok != priced))
