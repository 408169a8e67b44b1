import hashlib
import math
import os
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quayside.catalog import CurveConfig
from quayside.errors import MixedSourceError, ShapeEstimationError
from quayside.operators import curves, reports, shape
from quayside.schemas import CURVE, PARAMS
from quayside.sources.synthetic import synthetic_history, synthetic_prices
from tests.support import flat_params, gold, observed, T1
from workloads import tables
from workloads.queries import QUERIES

SERIES = ("RWTC", "RBRTE", "RCLC1", "RCLC2", "RCLC3", "RCLC4")
# The published digests of the generated price grid and of the parameters.
GRID_DIGEST = "65cb463762827da000a844d1d03818ad3b1ffc622aac68b93f22079dac583b8e"
PARAMS_DIGEST = "4a111aa831712d152a387c8c8dcd9687132241ea0488a05dbdc925eacf253af4"
EDGES = [(2020, 4, 17), (2020, 4, 18), (2020, 4, 20), (2020, 4, 21), (2024, 4, 4), (2024, 4, 5),
         (2024, 4, 8), (2024, 12, 31)]


def test_generated_prices_match_the_published_grid(spark):
    days = [date(1983, 1, 3) + timedelta(days=7 * i) for i in range(2143)]
    days += [date(*e) for e in EDGES]
    table = spark.createDataFrame([(d,) for d in set(days)], "observation_date date")
    prices = {(r[0], r[1]): r[2] for r in synthetic_prices(table, SERIES).collect()}
    text, priced = hashlib.sha256(), 0
    for d in days:
        for sid in SERIES:
            value = prices.get((sid, d))
            priced += value is not None
            shown = None if value is None else value.quantize(Decimal("0.01"))
            text.update(f"{sid}|{d}|{shown}\n".encode())
    assert (priced, text.hexdigest()) == (12892, GRID_DIGEST)


def test_generated_history_gives_the_published_parameters_for_any_partitioning(spark):
    history = synthetic_history(spark, SERIES, date(1983, 1, 3), date(2024, 4, 5))
    for parts in (None, 3):
        df = history if parts is None else history.repartition(parts)
        found = shape.estimate_shape(df)
        assert shape.params_sha256(found.params) == PARAMS_DIGEST
    excluded = [(str(r[0]), r[1], r[2]) for r in found.excluded.orderBy("position").collect()]
    assert excluded == [("2020-04-20", f"C{k}", "non-positive spot") for k in range(1, 5)]


def crafted(days_of_month, skip=None):
    """Spot 50 and futures 50 exp(0.005 k + 0.002 k cos(2 pi m / 12)), some weekdays per month."""
    rows = []
    for month in range(1, 13):
        day, used = date(2015, month, 1), 0
        while day.month == month and used < days_of_month.get(month, 15):
            if day.weekday() < 5 and month != skip:
                used += 1
                rows.append(("RWTC", day, "50.00"))
                for k in range(1, 5):
                    log = 0.005 * k + 0.002 * k * math.cos(2 * math.pi * month / 12)
                    rows.append((f"RCLC{k}", day, f"{50 * math.exp(log):.2f}"))
            day += timedelta(days=1)
    return rows


WINDOW = (date(2015, 1, 1), date(2015, 12, 31))


def test_known_ratios_are_recovered(spark):
    rows = crafted({3: 16, 4: 20, 5: 21}) + [("RBRTE", date(2015, 3, 2), "1.00")]
    params = shape.estimate_shape(observed(spark, rows), WINDOW).params.collect()
    by_key = {(p, d.month): Decimal(v) for s, d, v in rows for p in ["C" + s[-1]] if s[:4] == "RCLC"}
    for r in params:
        ratio = float(by_key[r["position"], r["month"]]) / 50.0
        wanted = Decimal(repr(math.log(ratio))).quantize(Decimal("1e-10"))
        assert r["s"] == wanted
    assert {r["month"]: r["n_obs"] for r in params}[5] == 21


def test_a_shape_reproduces_and_its_inputs_have_a_digest(spark):
    rows = crafted({}) + [("RBRTE", date(2015, 3, 2), "1.00")]
    seen = observed(spark, rows)
    found = shape.estimate_shape(seen, WINDOW)
    assert shape.verify_shape(found.params, seen, window=WINDOW).count() == 0
    moved = [(s, d, "51.00" if (s, d) == ("RCLC2", date(2015, 6, 1)) else p) for s, d, p in rows]
    other = shape.estimate_shape(observed(spark, moved), WINDOW)
    wrong = shape.verify_shape(found.params, observed(spark, moved), window=WINDOW).collect()
    assert {(r["position"], r["month"]) for r in wrong} <= {("C2", 6)}
    assert len(found.inputs_sha256) == 64 and other.inputs_sha256 != found.inputs_sha256
    unread = observed(spark, [*rows, ("RBRTE", date(2015, 3, 3), "2.00"), ("RWTC", date(2016, 1, 4), "3.00")])
    assert shape.inputs_digest(shape.used_observations(unread, WINDOW)).first()["digest"] == found.inputs_sha256


def test_thin_and_missing_groups_are_refused(spark):
    with pytest.raises(ShapeEstimationError, match=r"under 15 observations for C1 in month 7 \(14\), C2"):
        shape.estimate_shape(observed(spark, crafted({7: 14})), WINDOW)
    with pytest.raises(ShapeEstimationError, match="nothing was observed for C1 in month 5, .*C4 in month 5"):
        shape.estimate_shape(observed(spark, crafted({}, skip=5)), WINDOW)
    with pytest.raises(ShapeEstimationError):
        shape.estimate_shape(observed(spark, crafted({})), (WINDOW[0], date(2015, 12, 14)))


def test_non_positive_prices_are_excluded_with_the_spot_named_first(spark):
    rows = [r for r in crafted({m: 18 for m in range(1, 13)})
            if r[:2] not in {("RWTC", date(2015, 3, 2)), ("RCLC2", date(2015, 3, 3))}]
    rows += [("RWTC", date(2015, 3, 2), "-1.00"), ("RCLC2", date(2015, 3, 3), "0.00")]
    found = shape.estimate_shape(observed(spark, rows), WINDOW)
    got = sorted((r["observation_date"].day, r["position"], r["reason"]) for r in found.excluded.collect())
    assert got == [(2, f"C{k}", "non-positive spot") for k in range(1, 5)] + [
        (3, "C2", "non-positive future")]
    counts = {r["position"]: r["n_obs"] for r in found.params.filter("month = 3").collect()}
    assert counts == {"C1": 17, "C2": 16, "C3": 17, "C4": 17}


def test_mixed_sources_are_refused_by_shape_and_curves(spark):
    rows = [("RWTC", date(2024, 1, 2), "70", T1, T1)]
    both = gold(spark, rows, "a").union(gold(spark, rows, "b"))
    with pytest.raises(MixedSourceError):
        shape.estimate_shape(both, None)
    with pytest.raises(MixedSourceError):
        curves.build_curves(both, flat_params(spark), params_sha256="x", shape_method_version="v")


def test_parameter_sets_are_compared_as_data(spark):
    base = flat_params(spark)
    problems = lambda b: [r["problem"] for r in shape.compare_params(base, b).collect()]
    moved = lambda by: base.withColumn("s", F.when(
        (F.col("position") == "C1") & (F.col("month") == 2), F.col("s") + F.lit(Decimal(by)))
        .otherwise(F.col("s")).cast("decimal(20,10)"))
    assert problems(base.orderBy(F.rand(1))) == []
    assert problems(moved("0.000000001")) == []
    assert problems(moved("0.000000002")) == [
        "s 0.0100000000 vs 0.0100000020 exceeds 0.000000001"]
    assert problems(base.filter("not (position = 'C1' and month = 2)")) == ["parameter keys differ"]
    counted = base.withColumn("n_obs", F.when(F.col("month") == 1, 21).otherwise(F.col("n_obs")).cast("bigint"))
    assert problems(counted) == ["n_obs 20 != 21"] * 4
    assert shape.missing_groups(base.filter("month <> 4")).count() == 4


def built(spark, rows, **options):
    df = curves.build_curves(observed(spark, rows), flat_params(spark), params_sha256="abc",
                             shape_method_version="shape-v1", **options)
    assert df.schema == CURVE or df.columns == CURVE.names
    return {(r["curve_id"], r["as_of_date"].day, r["position"]): r for r in df.collect()}


def test_outright_and_spread_arithmetic_is_exact(spark):
    d = date(2024, 1, 2)
    rows = built(spark, [("RWTC", d, "70.00"), ("RBRTE", d, "74.50")])
    price = lambda c, p: rows[c, 2, p]["price"]
    assert (price("WTI", "Spot"), price("WTI", "C1"), price("WTI", "C4")) == (
        Decimal("70.0000"), Decimal("70.7035"), Decimal("72.8568"))
    for p in ("Spot", "C1", "C2", "C3", "C4"):
        assert price("BRENT_WTI", p) == price("BRENT", p) - price("WTI", p)
    assert rows["BRENT_WTI", 2, "C1"]["shape_source"] == "BRENT minus WTI"
    assert {r["estimate_type"] for r in rows.values()} == {"modelled"}
    assert len(rows) == 15


def test_gaps_name_their_reason_and_nothing_is_filled(spark):
    one, two = date(2024, 1, 2), date(2024, 1, 3)
    rows = built(spark, [("RWTC", one, "70"), ("RBRTE", one, "74"), ("RWTC", two, "-8.88")])
    assert rows["BRENT", 3, "C1"]["gap_reason"] == "no RBRTE spot on 2024-01-03"
    assert rows["WTI", 3, "Spot"]["gap_reason"] == (
        "non-positive RWTC spot (-8.880000); shape undefined")
    assert rows["BRENT_WTI", 3, "C4"]["gap_reason"] == (
        "no RBRTE spot on 2024-01-03; non-positive RWTC spot (-8.880000); shape undefined")
    gaps = [r for r in rows.values() if r["status"] == "gap"]
    assert len(gaps) == 15 and all(r["price"] is None for r in gaps)


def test_spot_rounds_half_to_even(spark):
    rows = built(spark, [("RWTC", date(2024, 1, 2), "70.00005"), ("RWTC", date(2024, 1, 3), "70.00015")])
    assert rows["WTI", 2, "Spot"]["price"] == Decimal("70.0000")
    assert rows["WTI", 3, "Spot"]["price"] == Decimal("70.0002")


def test_products_equal_34_digit_arithmetic(spark):
    prices = [Decimal(i * 37 + 1) / 100 for i in range(700)]
    days = [date(2020, 1, 1) + timedelta(days=i) for i in range(700)]
    rows = curves.build_curves(
        observed(spark, [("RWTC", d, str(p)) for d, p in zip(days, prices)]), flat_params(spark),
        params_sha256="x", shape_method_version="v").filter("curve_id = 'WTI'").collect()
    price_of = dict(zip(days, prices))
    for r in rows:
        k = 0 if r["position"] == "Spot" else int(r["position"][1])
        exact = curves.CONTEXT.multiply(price_of[r["as_of_date"]], curves.CONTEXT.exp(Decimal(k) / 100))
        assert r["price"] == exact.quantize(Decimal("0.0001"), "ROUND_HALF_EVEN")


def test_curves_are_configured_by_data(spark):
    config = CurveConfig.from_toml("""
        method_version = "curve-v9"
        [[outright]]
        id = "X"
        anchor = "RBRTE"
        shape_source = "borrowed"
    """)
    rows = built(spark, [("RBRTE", date(2024, 1, 2), "10")], config=config)
    assert {k[0] for k in rows} == {"X"} and rows["X", 2, "C1"]["method_version"] == "curve-v9"


def test_factor_rows_are_the_parameters_only(spark):
    assert curves.shape_factors(flat_params(spark)).count() == 12
    assert PARAMS.names == ["position", "month", "s", "n_obs"]


@pytest.mark.parametrize("left_out", ["month = 0", "month = 3 and position <> 'C1'", "month = 3"])
def test_newest_curves_hold_every_latest_point(spark, left_out):
    """Also where the newest month's parameters do not name every position, or none."""
    rows = [(source, series, date(2024, month, day), str(50 + day)) for source in ("a", "b")
            for series in ("RWTC", "RBRTE") for month in (1, 2, 3) for day in range(1, 6)
            if (source, series, month) != ("b", "RBRTE", 3)]
    current = spark.createDataFrame(
        [(s, i, d, Decimal(p)) for s, i, d, p in rows],
        "source string, series_id string, observation_date date, price decimal(18,6)")
    params = flat_params(spark).filter(f"not ({left_out})")
    build = lambda **kw: curves.build_curves(
        current, params, params_sha256="x", shape_method_version="v", by=("source",), **kw)
    few = build(newest=True)
    latest = lambda points: sorted(map(str, reports.latest_points(points, by=("source",)).collect()))
    assert latest(few) == latest(build())
    assert few.select("source", "as_of_date").distinct().count() <= 4


def test_latest_reads_combine_by_hashing(spark):
    """Before points are unfolded, only the newest date of a source is kept, without sorting."""
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("the test tables are not here")
    for name in ("latest_points", "monitored_values", "latest_curves_grouped"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "max_by(spot_RWTC" in plan.replace("`", ""), name


def test_lines_are_dealt_to_tasks_by_their_number(spark, monkeypatch):
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("the test tables are not here")
    monkeypatch.setattr(tables, "LINES_PER_TASK", 100)
    seen = tables.observations(spark, "/root/testdata/sf0.001")
    lines = tables.table(spark, "/root/testdata/sf0.001", "lineitem").count()
    assert seen.rdd.getNumPartitions() == lines // 100 + 1
