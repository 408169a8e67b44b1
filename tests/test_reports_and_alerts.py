import random
import time
from datetime import date, datetime
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quayside.errors import QuaysideError, RuleError, StagingValidationError, UnknownVersion
from quayside.operators import alerts, checks, curves, reports
from quayside.plans import files
from quayside.schemas import DATASET_VERSION, FIRED, MONITORED, RULE
from quayside.streaming import alerts as stream
from tests.support import flat_params, observed, rule, values


@pytest.fixture(scope="module")
def points(spark):
    rows = [("RWTC", date(2024, 1, d), f"{60 + d % 5}.5") for d in range(2, 12)]
    rows += [("RBRTE", date(2024, 1, d), f"{65 + d % 3}.25") for d in range(2, 9)]
    df = curves.build_curves(observed(spark, rows), flat_params(spark), params_sha256="x",
                             shape_method_version="v")
    return spark.createDataFrame(df.collect(), df.schema)


def test_latest_complete_curve_skips_gaps_and_latest_points_keep_them(points):
    complete = {(r["curve_id"], r["as_of_date"].day) for r in reports.latest_complete_curve(points).collect()}
    assert complete == {("WTI", 11), ("BRENT", 8), ("BRENT_WTI", 8)}
    latest = reports.latest_points(points, F.lit(date(2024, 1, 15))).collect()
    assert len(latest) == 15
    assert {(r["curve_id"], r["status"], r["data_age_days"]) for r in latest} == {
        ("WTI", "ok", 4), ("BRENT", "gap", 4), ("BRENT_WTI", "gap", 4)}


def test_grouped_curves_keep_display_order(points):
    row = reports.grouped_latest(points, F.lit(date(2024, 1, 12))).filter("curve_id = 'WTI'").collect()[0]
    assert [p["position"] for p in row["points"]] == ["Spot", "C1", "C2", "C3", "C4"]
    assert (row["points"][0]["price"], row["data_age_days"]) == ("61.5000", 1)


def test_contango_counts_ties_in_neither(points):
    got = {r["curve_id"]: (r["contango_days"], r["backwardation_days"]) for r in reports.contango_days(points).collect()}
    assert got == {"WTI": (10, 0), "BRENT": (7, 0)}
    assert reports.contango_days(points, far="Spot").agg(F.sum("contango_days")).collect()[0][0] == 0


def test_percent_rank_is_within_the_month(points):
    ranks = reports.month_percent_rank(points).filter("position = 'Spot'").collect()
    by_price = sorted({(r["price"], r["month_percent_rank"]) for r in ranks})
    assert [p for _, p in by_price] == [0.0, 2 / 9, 4 / 9, 6 / 9, 8 / 9]


def test_history_bounds_are_inclusive_and_checked(points):
    got = reports.curve_history(points, "WTI", "C1", date(2024, 1, 5), date(2024, 1, 8))
    assert sorted(r["as_of"].day for r in got.collect()) == [5, 6, 7, 8]
    assert reports.curve_history(points, "WTI", "C1").count() == 10
    with pytest.raises(QuaysideError, match="start is after end"):
        reports.curve_history(points, "WTI", "C1", date(2024, 1, 8), date(2024, 1, 5))
    assert reports.is_known(points, "curve_id", "WTI") and not reports.is_known(points, "curve_id", "X")
    assert reports.as_text(got).orderBy("as_of").collect()[0]["as_of"] == "2024-01-05"


def test_staging_is_validated(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "k int, v string")
    checks.require_valid_staging(df, "t", ["k", "v"], 3)
    with pytest.raises(StagingValidationError, match="staged 3 rows, manifest says 4"):
        checks.require_valid_staging(df, "t", ["k", "v"], 4)
    with pytest.raises(StagingValidationError, match="1 duplicate keys"):
        checks.require_valid_staging(df, "t", ["k"], 3)


CASES = [
    ([65, 72, 75, 70, "70.0001"], 1, [(2, 72, 65), (5, "70.0001", 70)]),
    ([75, 76, 69, 71], 1, [(4, 71, 69)]),
    ([80, 85, 60, 71], 0, [(4, 71, 60)]),
    ([80, 65, 72], 2, [(3, 72, 65)]),
    ([65, None, 72], 1, [(3, 72, 65)]),
    ([75, None, 72], 1, []),
    ([60, None, 72], 2, []),  # a gap at the baseline leaves no previous value
    ([None, 80, 60, 80], 0, [(4, 80, 60)]),
]


@pytest.mark.parametrize(("prices", "baseline", "expected"), CASES)
def test_upward_crossings(spark, prices, baseline, expected):
    wanted = [(v, Decimal(str(p)), Decimal(str(q))) for v, p, q in expected]
    shown = lambda df: sorted((r["dataset_version"], r["price"], r["previous_price"]) for r in df.collect())
    assert shown(alerts.crossings(values(spark, prices), rule(spark, baseline=baseline), 2)) == wanted


def test_batch_crossings_equal_the_version_by_version_machine(spark):
    rng = random.Random(11)
    keys = [(f"X{i}", p) for i in range(4) for p in ("Spot", "C1")]
    rows = [(v, c, p, date(2024, 1, 1), None if rng.random() < 0.2 else Decimal(rng.randrange(60, 80)), "ok")
            for v in range(1, 13) for c, p in keys if rng.random() < 0.9]
    history = spark.createDataFrame(rows, MONITORED)
    rules = spark.createDataFrame(
        [(f"r{i}", *keys[i % 8], Decimal(rng.randrange(62, 78)), datetime(2024, 1, 1), None, 0,
          None, None, None, None) for i in range(20)], RULE)
    state, fired = rules, []
    for v in range(1, 13):
        now, after = alerts.evaluate_version(state, history.filter(F.col("dataset_version") == v), v)
        fired += [(r["rule_id"], v, r["previous_price"], r["alert_id"]) for r in now.collect()]
        state = spark.createDataFrame(after.collect(), RULE)
    for chunk in (3, 1000):
        batch = alerts.crossings(history, rules, chunk)
        got = [(r["rule_id"], r["dataset_version"], r["previous_price"], r["alert_id"]) for r in batch.collect()]
        assert sorted(got) == sorted(fired) and fired


def landed(spark, path, rows):
    """Values as (version, curve, price, follows), landed as one file more."""
    full = [(v, c, "C1", date(2024, 1, 1), None if p is None else Decimal(p), "ok", f) for v, c, p, f in rows]
    spark.createDataFrame(full, MONITORED.simpleString()[7:-1].replace(":", " ") + ", follows bigint").coalesce(1).write.mode("append").parquet(path)


def a_rule(rule_id, curve, threshold, baseline=0, deleted=None):
    return (rule_id, curve, "C1", Decimal(threshold), datetime(2024, 1, 1), deleted, baseline, None, None, None, None)


def found(spark, out):
    return sorted((r["rule_id"], r["dataset_version"], int(r["price"]), int(r["previous_price"]))
                  for r in stream.read_crossings(spark, out).collect())


def test_stream_equals_batch_while_files_land_out_of_order(spark, folder):
    rng = random.Random(12)
    source, out, checkpoint = folder("values"), folder("crossed"), folder("cp")
    rows = [(v, f"X{i}", None if rng.random() < 0.2 else rng.randrange(60, 80)) for v in range(1, 31) for i in range(5) if rng.random() < 0.8]
    last, chained = {}, []
    for v, c, p in rows:
        chained.append((v, c, p, last.get(c)))
        last[c] = v
    rng.shuffle(chained)
    rules = spark.createDataFrame([a_rule(f"r{i}", f"X{i % 5}", 65 + i, i) for i in range(8)], RULE)
    for k in range(4):  # each run sees files that were not there before, in no order of versions
        for part in (chained[k::8], chained[k + 4::8]):
            landed(spark, source, part)
        stream.run_crossings(stream.stream_monitored(spark, source, 1), lambda: rules, out, checkpoint).awaitTermination()
    plain = spark.createDataFrame(
        [(v, c, "C1", date(2024, 1, 1), None if p is None else Decimal(p), "ok") for v, c, p in rows], MONITORED)
    batch = sorted((r["rule_id"], r["dataset_version"], int(r["price"]), int(r["previous_price"])) for r in alerts.crossings(plain, rules).collect())
    assert found(spark, out) == batch != []
    assert [r["follows"] for r in stream.with_follows(plain).where("curve_id = 'X0'").orderBy("dataset_version").collect()] == [
        f for v, c, p, f in sorted(chained) if c == "X0"]


def test_versions_that_land_late_are_judged_in_their_order(spark, folder):
    source, out, checkpoint = folder("late"), folder("late_crossed"), folder("cp")
    rules = spark.createDataFrame([a_rule("r", "X", 70)], RULE)
    go = lambda: stream.run_crossings(stream.stream_monitored(spark, source, 1), lambda: rules, out, checkpoint).awaitTermination()
    landed(spark, source, [(3, "X", 60, 2), (4, "X", 80, 3)])
    go()
    assert found(spark, out) == []  # versions 1 and 2 are still missing
    landed(spark, source, [(1, "X", 65, None), (2, "X", 72, 1), (2, "X", 72, 1)])
    go()
    landed(spark, source, [(2, "X", 90, 1), (5, "X", None, 4)])  # a version seen before changes nothing
    go()
    assert found(spark, out) == [("r", 2, 72, 65), ("r", 4, 80, 60)]


def test_alerts_outlive_their_rule_and_deleted_rules_stay_silent(spark, folder):
    source, out, checkpoint = folder("gone"), folder("gone_crossed"), folder("cp")
    live = spark.createDataFrame([a_rule("r", "X", 70)], RULE)
    gone = spark.createDataFrame([a_rule("r", "X", 70, deleted=datetime(2024, 2, 1))], RULE)
    landed(spark, source, [(1, "X", 65, None), (2, "X", 72, 1)])
    stream.run_crossings(stream.stream_monitored(spark, source), lambda: live, out, checkpoint).awaitTermination()
    landed(spark, source, [(3, "X", 69, 2), (4, "X", 75, 3)])
    stream.run_crossings(stream.stream_monitored(spark, source), lambda: gone, out, checkpoint).awaitTermination()
    assert found(spark, out) == [("r", 2, 72, 65)]


def test_a_version_that_never_comes_is_waited_for_no_longer_than_asked(spark, folder):
    source, out = folder("lost"), folder("lost_crossed")
    rules = spark.createDataFrame([a_rule("r", "X", 70)], RULE)
    landed(spark, source, [(1, "X", 65, None), (3, "X", 72, 2)])
    with pytest.raises(QuaysideError, match="runs on"):
        stream.run_crossings(stream.stream_monitored(spark, source), lambda: rules, out, folder("cp"), patience_ms=100)
    run = stream.run_crossings(
        stream.stream_monitored(spark, source), lambda: rules, out, folder("cp"), patience_ms=100, every="200 milliseconds")
    try:
        until = time.monotonic() + 60
        while time.monotonic() < until and not (files.exists(spark, f"{out}/crossings") and found(spark, out)):
            time.sleep(1)
    finally:
        run.stop()
    assert found(spark, out) == [("r", 3, 72, 65)]


def test_a_micro_batch_reads_and_writes_the_state_once_however_many_positions_it_holds():
    rng, calls = random.Random(5), []

    class Kept:
        held = None

        def get(self):
            calls.append("get")
            return self.held

        def update(self, value):
            calls.append("update")
            self.held = value

    class Handle:
        def getValueState(self, name, schema):
            return Kept()

    machine = stream.Sequencer(None)
    machine.init(Handle())
    rows, want = [], []
    for i in range(40):
        last, before, priced = stream.START, None, None
        for v in sorted(rng.sample(range(1, 500), 15)):
            p = None if rng.random() < 0.2 else rng.randrange(50)
            rows.append((f"X{i}", "C1", last, v, "2024-01-01", p is not None, p or 0))
            if p is not None:
                want += [(f"X{i}", "C1", v, "2024-01-01", p, before, priced)] if before is not None and p > before else []
                before, priced = p, v
            last = v
    rng.shuffle(rows)
    got = []
    for k in range(3):
        frame = pd.DataFrame(rows[k::3], columns=stream.FLAT)
        for steps in machine.handleInputRows((0,), iter([frame.iloc[:70], frame.iloc[70:]]), None):
            got += list(steps.itertuples(index=False, name=None))
    assert sorted(got) == sorted(want) and want
    assert calls == ["get", "update"] * 3


def test_steps_look_only_at_the_rules_between_their_prices(spark):
    """10^5 rules and 10^5 steps on one position: 10^10 pairs, of which a few thousand belong together."""
    n = 100_000
    ids = spark.range(n)
    rules = ids.select(F.col("id").cast("string").alias("rule_id"), F.lit("X").alias("curve_id"), F.lit("C1").alias("position"),
                       (F.col("id") * 10).cast("decimal(18,4)").alias("threshold"), F.lit(None).cast("timestamp").alias("created_at"),
                       F.lit(None).cast("timestamp").alias("deleted_at"), F.lit(0).cast("bigint").alias("baseline_version"))
    low = (F.col("id") * 7919 % (n * 10) + F.lit(0.5)).cast("decimal(18,4)")
    steps = ids.select(F.lit("X").alias("curve_id"), F.lit("C1").alias("position"), (F.col("id") + 2).alias("dataset_version"),
                       F.lit(None).cast("date").alias("as_of"), (low + F.lit(1)).cast("decimal(18,4)").alias("price"),
                       low.alias("previous_price"), (F.col("id") + 1).alias("previous_version"))
    got = alerts.crossed_rules(steps, rules)
    want = sum(1 for i in range(n) if (i * 7919 % (n * 10)) % 10 == 9)
    assert got.count() == want
    assert got.where("threshold < previous_price or threshold >= price").count() == 0


def test_range_join_equals_brute_force_with_ties_and_empty_sides(spark):
    from quayside.functions.ranges import points_in_ranges

    rng = random.Random(4)
    pts = [("a" if rng.random() < 0.8 else "b", i, rng.randrange(20)) for i in range(60)] + [(None, 99, 3), ("a", 98, None)]
    rgs = [(rng.choice("abc"), i, rng.randrange(20), rng.randrange(22)) for i in range(60)] + [("a", 97, None, 5)]
    p = spark.createDataFrame(pts, "k string, point int, v int")
    r = spark.createDataFrame(rgs, "k string, id int, lo int, hi int")
    got = points_in_ranges(p, r, ["k"], "v", "lo", "hi", ["id"])
    want = sorted((k, i, x) for k, i, lo, hi in rgs for j, x, v in pts if k == j and None not in (k, lo, hi, v) and lo <= v < hi)
    assert sorted((x["k"], x["id"], x["point"]) for x in got.collect()) == want != []
    assert points_in_ranges(p.limit(0), r, ["k"], "v", "lo", "hi", ["id"]).count() == 0
    assert points_in_ranges(p, r.limit(0), ["k"], "v", "lo", "hi", ["id"]).count() == 0


def test_new_rules_start_from_the_current_version(spark):
    now = values(spark, [65, None], first=1).union(values(spark, [80], curve="BRENT", first=2))
    asked = lambda **kw: rule(spark, **kw).select("rule_id", "curve_id", "position", "threshold", "created_at")
    state = lambda df: tuple(df.select("baseline_version", "armed", "last_value", "last_version").collect()[0])
    assert state(alerts.rule_baseline(asked(), now, 1)) == (1, True, 65, 1)
    assert state(alerts.rule_baseline(asked(), now, 2)) == (2, None, None, None)
    assert state(alerts.rule_baseline(asked(curve="BRENT"), now, 2)) == (2, False, 80, 2)
    assert state(alerts.rule_baseline(asked(), now.limit(0), None)) == (0, None, None, None)
    with pytest.raises(RuleError, match="unknown curve"):
        alerts.rule_baseline(asked(curve="NOPE"), now, 1)
    with pytest.raises(RuleError, match="unknown position"):
        alerts.rule_baseline(asked(position="C9"), now, 1)
    gone = alerts.delete_rule(rule(spark), "r1", F.current_timestamp())
    assert alerts.live_rules(gone).count() == 0
    assert alerts.crossings(values(spark, [65, 72]), gone).count() == 0


def test_thresholds_are_strict_decimals(spark):
    cases = {"70": "70.0000", "-1.5": "-1.5000", "70.0001": "70.0001", "70.00010": None, "1e3": "1000.0000",
             "1.23456e2": "123.4560", "NaN": None, "Infinity": None, "": None, "abc": None, "1e14": None,
             "99999999999999.9999": "99999999999999.9999", "1e-5": None, "5.": "5.0000", "7\n8": None}
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    got = {r[0]: None if r[1] is None else str(r[1]) for r in df.select("t", alerts.threshold(F.col("t"))).collect()}
    assert got == cases


def test_values_of_a_version_must_exist(spark):
    known = spark.createDataFrame(
        [(v, f"i{v}", "m", "s", None, None, 0, 0, n, 0) for v, n in ((1, 5), (2, 0), (3, 5))], DATASET_VERSION)
    held = values(spark, [65])
    assert alerts.values_of_version(held, known, 1).count() == 1
    assert alerts.values_of_version(held, known, 2).count() == 0
    with pytest.raises(UnknownVersion, match="rebuild"):
        alerts.values_of_version(held, known, 3)
    with pytest.raises(UnknownVersion, match="not imported"):
        alerts.values_of_version(held, known, 9)


def test_cursors_go_on_or_start_over(spark):
    own, other = "0" * 31 + "1", "f" * 32
    cursors = [None, ""] + [f"{e}-{n}" for e in (own, other) for n in range(13)] + [
        "words", f"{own}-04", f"{own}-5\n", f"{own}-" + "9" * 19, f"x{own}-5", own]
    df = spark.createDataFrame([(c,) for c in cursors], "c string")
    for r in df.select("c", alerts.reading_place(F.col("c"), own, 4, 10).alias("place")).collect():
        n = r["c"].removeprefix(f"{own}-") if r["c"] else ""
        if n in map(str, range(4, 11)):
            want = (int(n), None)
        elif not r["c"]:
            want = (10, None)
        else:
            want = (10, "expired_cursor" if n in map(str, range(4)) else "unknown_cursor")
        assert tuple(r["place"]) == want, r["c"]


def test_the_log_is_numbered_once_and_pruned_as_a_prefix(spark):
    fired = alerts.crossings(values(spark, [65, 72, 60, 75, 60, 80]), rule(spark))
    log = alerts.append_alerts(spark.createDataFrame([], FIRED), fired, 0, F.lit(datetime(2024, 1, 1)))
    log = spark.createDataFrame(log.orderBy("seq").collect(), FIRED)
    assert [(r["seq"], r["dataset_version"]) for r in log.collect()] == [(1, 2), (2, 4), (3, 6)]
    assert alerts.append_alerts(log, fired, 3, F.lit(datetime(2024, 1, 2))).count() == 0
    assert [r["seq"] for r in alerts.alerts_after(log, 1, 1).collect()] == [2]
    assert [r["seq"] for r in alerts.latest_alerts(log, 2).collect()] == [2, 3]
    dated = log.withColumn("fired_at", F.expr("timestamp'2024-01-01' + make_interval(0,0,0,cast(4 - seq as int))"))
    kept, floor = alerts.prune(dated, 0, F.lit(datetime(2024, 1, 3)))
    assert floor == 3 and kept.count() == 0  # seq 3 is old, so everything before it goes too
    assert alerts.prune(log, 7, F.lit(datetime(2023, 1, 1)))[1] == 7
