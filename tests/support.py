"""Small synthetic inputs shared by the tests."""

from datetime import date, datetime
from decimal import Decimal

from quayside.operators.shape import METHOD_VERSION, params_sha256
from quayside.plans.ingest import ShapeInput, run_ingest
from quayside.schemas import GOLD, MONITORED, PARAMS, REQUEST, RULE, SILVER
from quayside.sources.synthetic import synthetic_history, synthetic_pages

T1, T2, T3 = (datetime(2026, 3, d) for d in (1, 2, 3))
SPOT = ("RBRTE", "RWTC")
JANUARY = (date(2024, 1, 1), date(2024, 1, 31))
FEBRUARY = (date(2024, 2, 1), date(2024, 2, 29))
OVERRIDE = "series_id string, observation_date date, price decimal(18,6)"
OMIT = "series_id string, observation_date date"


def flat_params(spark):
    rows = [(f"C{k}", m, Decimal(k) / 100, 20) for k in range(1, 5) for m in range(1, 13)]
    return spark.createDataFrame(rows, PARAMS)


def flat_shape(spark, origin="synthetic"):
    params = flat_params(spark)
    return ShapeInput(params, params_sha256(params), METHOD_VERSION, origin)


def request(spark, window, series=SPOT):
    return spark.createDataFrame([("r1", list(series), *window)], REQUEST)


def pages(spark, window, at=T1, series=SPOT, override=(), omit=(), value=None):
    history = synthetic_history(
        spark, series, *window,
        spark.createDataFrame([(s, d, Decimal(p)) for s, d, p in override], OVERRIDE)
        if override else None,
        spark.createDataFrame(list(omit), OMIT) if omit else None,
    )
    return synthetic_pages(
        history, request_id="r1", route="petroleum/pri/spt", retrieved_at=at, value=value
    )


def ingest(spark, store, window, at=T1, series=SPOT, shape=None, **kw):
    options = {k: kw.pop(k) for k in ("fault", "source") if k in kw}
    return run_ingest(
        spark, store, pages(spark, window, at, series, **kw), request(spark, window, series),
        source=options.pop("source", "synthetic"), shape=shape, **options,
    )


def silver(spark, rows, at, source="synthetic"):
    """rows of (series, date, price)"""
    return spark.createDataFrame(
        [(source, s, d, Decimal(p), "$/BBL", Decimal(p) <= 0, at, "in", "key") for s, d, p in rows],
        SILVER,
    )


def gold(spark, rows, source="synthetic"):
    """rows of (series, date, price, retrieved_at, last_seen_at)"""
    return spark.createDataFrame(
        [(source, s, d, Decimal(p), "$/BBL", Decimal(p) <= 0, at, "old", "key", seen)
         for s, d, p, at, seen in rows],
        GOLD,
    )


def observed(spark, rows):
    return spark.createDataFrame(
        [(s, d, Decimal(p)) for s, d, p in rows],
        "series_id string, observation_date date, price decimal(18,6)",
    )


def values(spark, prices, curve="WTI", position="C1", first=1):
    """Monitored values for consecutive versions; None is a gap."""
    return spark.createDataFrame(
        [(v, curve, position, date(2024, 1, v), None if p is None else Decimal(str(p)),
          "gap" if p is None else "ok") for v, p in enumerate(prices, first)],
        MONITORED,
    )


def rule(spark, threshold="70", baseline=1, rule_id="r1", curve="WTI", position="C1",
         created=datetime(2024, 1, 1), state=(None, None, None, None)):
    return spark.createDataFrame(
        [(rule_id, curve, position, Decimal(threshold), created, None, baseline, *state)], RULE
    )
