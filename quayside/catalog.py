"""Static dimensions: the series ingested, the curve positions and the curve definitions."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession

# Positions in display order, and the series with their unit strings.
POSITIONS = ("Spot", "C1", "C2", "C3", "C4")
SHAPE_POSITIONS = POSITIONS[1:]
UNIT = "$/BBL"
SPOT_ROUTE, FUTURES_ROUTE = "petroleum/pri/spt", "petroleum/pri/fut"
FUTURES_END = date(2024, 4, 5)
SPOT_SERIES = ("RWTC", "RBRTE")
FUTURES = {"RCLC1": "C1", "RCLC2": "C2", "RCLC3": "C3", "RCLC4": "C4"}
ANCHOR = "RWTC"
LOOKBACK_DAYS = 10

CATALOG_SCHEMA = (
    "series_id string, route string, kind string, unit string, label string, position string, "
    "discontinued date"
)
CATALOG_ROWS = [
    ("RWTC", SPOT_ROUTE, "spot", UNIT, "WTI Cushing spot", None, None),
    ("RBRTE", SPOT_ROUTE, "spot", UNIT, "Brent spot", None, None),
    *[
        (sid, FUTURES_ROUTE, "future", UNIT, f"WTI {pos}", pos, FUTURES_END)
        for sid, pos in FUTURES.items()
    ],
]


def series_catalog(spark: SparkSession) -> DataFrame:
    """The six series as a table. It is a constant, so joining it by broadcast is always safe."""
    return spark.createDataFrame(CATALOG_ROWS, CATALOG_SCHEMA)


@dataclass(frozen=True)
class Outright:
    curve_id: str
    anchor: str
    shape_source: str


@dataclass(frozen=True)
class Spread:
    curve_id: str
    long: str
    short: str


@dataclass(frozen=True)
class CurveConfig:
    method_version: str = "curve-v1"
    outrights: tuple[Outright, ...] = field(default=(
        Outright("WTI", "RWTC", "WTI futures C1-C4 (RCLC1-RCLC4)"),
        Outright("BRENT", "RBRTE", "WTI futures C1-C4 (borrowed; no Brent futures in EIA)"),
    ))
    spreads: tuple[Spread, ...] = field(default=(Spread("BRENT_WTI", "BRENT", "WTI"),))

    @classmethod
    def from_toml(cls, text: str) -> CurveConfig:
        doc = tomllib.loads(text)
        return cls(
            doc["method_version"],
            tuple(Outright(o["id"], o["anchor"], o["shape_source"])
                  for o in doc.get("outright", [])),
            tuple(Spread(s["id"], s["long"], s["short"]) for s in doc.get("spread", [])),
        )

    @property
    def curve_ids(self) -> frozenset[str]:
        return frozenset(c.curve_id for c in (*self.outrights, *self.spreads))


DEFAULT_CURVES = CurveConfig()
