from datetime import date, datetime
from decimal import Decimal

from quayside.operators.merge import merge_gold
from quayside.schemas import GOLD, OBSERVATION_KEY, REVISION, conform, empty
from tests.support import gold, silver

DAY = date(2024, 1, 10)
T = [datetime(2026, 3, d) for d in (1, 2, 3)]


def run(spark, steps):
    """Merge (time, price) retrievals of one key in turn; returns the last result and all stats."""
    current, revisions, stats = empty(spark, GOLD), empty(spark, REVISION), []
    for version, (at, price) in enumerate(steps, 1):
        merged = merge_gold(
            current, revisions, silver(spark, [("RWTC", DAY, price)], at), version, f"in{version}")
        current = spark.createDataFrame(merged.current.collect(), GOLD)
        revisions = spark.createDataFrame(merged.revisions.collect(), REVISION)
        stats.append(merged.stats.collect()[0].asDict())
    return current.collect(), revisions.collect(), stats, merged


def test_each_later_price_revises(spark):
    current, revisions, stats, _ = run(spark, [(T[0], "50"), (T[1], "60"), (T[2], "50")])
    assert [r["price"] for r in current] == [50]
    assert [(r["price"], r["superseded_at_version"]) for r in revisions] == [(50, 2), (60, 3)]
    assert [s["price_changes"] for s in stats] == [1, 1, 1]


def test_a_confirmation_moves_the_watermark_so_a_delayed_price_is_stale(spark):
    current, revisions, stats, last = run(spark, [(T[0], "50"), (T[2], "50"), (T[1], "60")])
    assert (current[0]["price"], current[0]["retrieved_at"], current[0]["last_seen_at"]) == (
        50, T[0], T[2])
    assert revisions == []
    assert (stats[1]["seen"], stats[1]["state_changed"], stats[1]["price_changes"]) == (1, True, 0)
    assert (stats[2]["stale"], stats[2]["state_changed"]) == (1, False)
    note = last.stale.collect()[0]["note"]
    assert note.startswith("RWTC 2024-01-10: retrieval 2026-03-02 00:00:00 is not later than")


def test_equal_times_never_replace(spark):
    current, revisions, stats, _ = run(spark, [(T[0], "50"), (T[0], "60"), (T[0], "50")])
    assert current[0]["price"] == 50 and revisions == []
    assert (stats[1]["stale"], stats[2]["unchanged"]) == (1, 1)


def test_an_older_retrieval_changes_nothing(spark):
    current, _, stats, _ = run(spark, [(T[2], "50"), (T[0], "50")])
    assert current[0]["last_seen_at"] == T[2] and stats[1]["unchanged"] == 1


def test_only_matching_keys_meet(spark):
    base = gold(spark, [("RWTC", DAY, "50", T[0], T[0]), ("RBRTE", DAY, "55", T[0], T[0])])
    merged = merge_gold(
        base, empty(spark, REVISION),
        silver(spark, [("RWTC", DAY, "51"), ("RWTC", date(2024, 1, 11), "52")], T[1]), 2, "in2")
    got = {(r["series_id"], r["observation_date"].day): r["price"] for r in merged.current.collect()}
    assert got == {("RWTC", 10): 51, ("RBRTE", 10): 55, ("RWTC", 11): 52}
    row = merged.revisions.collect()[0]
    assert (row["price"], row["superseded_by_logical_input_id"], row["logical_input_id"]) == (
        Decimal(50), "in2", "old")
    stats = merged.stats.collect()[0]
    assert (stats["inserted"], stats["revised"], stats["unchanged"]) == (1, 1, 0)


def test_sources_are_separate_keys(spark):
    base = gold(spark, [("RWTC", DAY, "50", T[0], T[0])], source="a")
    merged = merge_gold(base, empty(spark, REVISION),
                        silver(spark, [("RWTC", DAY, "60")], T[1], source="b"), 2, "x")
    assert merged.current.count() == 2


def test_legacy_gold_takes_its_retrieval_time_as_watermark(spark):
    legacy = gold(spark, [("RWTC", DAY, "50", T[1], T[2])]).drop("last_seen_at")
    shuffled = conform(legacy.select(*reversed(legacy.columns)), GOLD)
    assert shuffled.columns == GOLD.names
    assert shuffled.collect()[0]["last_seen_at"] == T[1]
    merged = merge_gold(legacy, empty(spark, REVISION),
                        silver(spark, [("RWTC", DAY, "60")], T[2]), 2, "in")
    assert merged.current.collect()[0]["price"] == 60
    old = merged.revisions.collect()[0]
    assert (old["last_seen_at"], old["superseded_at_version"]) == (T[1], 2)
    assert merged.revisions.columns == REVISION.names and set(OBSERVATION_KEY) < set(REVISION.names)
