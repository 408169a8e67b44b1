"""Named SQL over the loaded warehouse tables, with parameters and a fixed order of rows.

A query is ordinary Spark SQL text over `{curve_points}` and `{revisions}`; values go in as named
parameters, never as text. Output is range-sorted, so rows come in the same order however they are
computed.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from quayside.errors import ConfigError
from quayside.plans.warehouse import read_loaded


@dataclass(frozen=True)
class NamedQuery:
    text: str
    tables: tuple[str, ...]
    order: tuple[str, ...]
    defaults: dict[str, Any] = field(default_factory=dict)


# The names under which the queries are called, and the order of their rows.
NAMED = {
    # Every position of each curve's newest date. Dates are gathered first (at most one price per
    # position), so the newest one is an aggregate and not a join.
    "latest_curve_per_series": NamedQuery("""
        WITH dated AS (
          SELECT curve_id, as_of_date, collect_list(named_struct('position', position, 'price', price)) AS held
          FROM {curve_points} WHERE status = 'ok' GROUP BY curve_id, as_of_date),
        newest AS (
          SELECT curve_id, max(as_of_date) AS as_of_date, max_by(held, as_of_date) AS held FROM dated GROUP BY curve_id)
        SELECT curve_id, as_of_date, inline(held) FROM newest""",
        ("curve_points",), ("curve_id", "position")),
    # Where both curves have a price, in one grouped pass.
    "wti_brent_spread_by_tenor": NamedQuery("""
        WITH legs AS (
          SELECT as_of_date, position, max(price) FILTER (WHERE curve_id = :upper) AS up,
            max(price) FILTER (WHERE curve_id = :lower) AS down
          FROM {curve_points} WHERE status = 'ok' AND curve_id IN (:upper, :lower) GROUP BY as_of_date, position)
        SELECT as_of_date, position, up - down AS spread FROM legs WHERE up IS NOT NULL AND down IS NOT NULL""",
        ("curve_points",), ("as_of_date", "position"), {"upper": "BRENT", "lower": "WTI"}),
    # Days on which the far contract is above or below spot, from one row per curve and day.
    "contango_backwardation_days": NamedQuery("""
        WITH days AS (
          SELECT curve_id, as_of_date, max(price) FILTER (WHERE position = 'Spot' AND kind = 'outright') AS near,
            max(price) FILTER (WHERE position = :far) AS away
          FROM {curve_points} WHERE status = 'ok' AND position IN ('Spot', :far) GROUP BY curve_id, as_of_date)
        SELECT curve_id, count_if(away > near) AS contango_days, count_if(away < near) AS backwardation_days
        FROM days WHERE near IS NOT NULL AND away IS NOT NULL GROUP BY curve_id""",
        ("curve_points",), ("curve_id",), {"far": "C4"}),
    "revisions_per_month": NamedQuery("""
        SELECT date_format(observation_date, 'yyyy-MM') AS month, series_id, count(*) AS revisions
        FROM {revisions} GROUP BY ALL""",
        ("revisions",), ("month", "series_id")),
    # A window never holds more than a month of one position.
    "rolling_percentile": NamedQuery("""
        SELECT curve_id, position, as_of_date, price,
          percent_rank() OVER (PARTITION BY curve_id, position, trunc(as_of_date, 'MM') ORDER BY price) AS month_percent_rank
        FROM {curve_points} WHERE curve_id = :curve AND status = 'ok'""",
        ("curve_points",), ("curve_id", "position", "as_of_date"), {"curve": "WTI"}),
}


def run_named(spark: SparkSession, warehouse: str, name: str, **values: Any) -> DataFrame:
    """The rows of a named query over the current load, in the query's order."""
    if name not in NAMED:
        raise ConfigError(f"no query is named {name!r}; there are {', '.join(NAMED)}")
    wanted = NAMED[name]
    unknown = sorted(set(values) - set(wanted.defaults))
    if unknown:
        raise ConfigError(f"{name} takes no parameter {unknown[0]!r}")
    tables = {t: read_loaded(spark, warehouse, t) for t in wanted.tables}
    return spark.sql(wanted.text, args={**wanted.defaults, **values}, **tables).orderBy(*wanted.order)
