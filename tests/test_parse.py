import json
import os
from datetime import datetime
from decimal import Decimal

import pytest

from quayside.catalog import series_catalog
from quayside.errors import PageError, StagingError
from quayside.operators.parse import CONFLICT, parse_observations
from quayside.schemas import PAGE
from quayside.sources import pages as page_source
from tests.support import JANUARY, T1, pages, request
from workloads.queries import QUERIES

ROW = {"period": "2026-09-25", "series": "RWTC", "value": "61.25", "units": "$/BBL"}


def page(spark, *row_lists, total=None, request_id="r1"):
    count = sum(map(len, row_lists)) if total is None else total
    totals = count if isinstance(count, list) else [count] * len(row_lists)
    bodies = [json.dumps({"response": {"total": str(t), "data": rows}})
              for rows, t in zip(row_lists, totals)]
    return page_source.with_hash(spark.createDataFrame(
        [("eia", request_id, i, "spt", None, T1, None, b) for i, b in enumerate(bodies, 1)], PAGE))


def parsed(spark, *rows):
    # one page per row, so that each row has a key of its own in the rejections
    everything = page_source.with_hash(spark.createDataFrame([
        ("eia", f"r{i}", 1, "spt", None, T1, None,
         json.dumps({"response": {"total": "1", "data": [r]}})) for i, r in enumerate(rows)
    ], PAGE).coalesce(1))
    return parse_observations(page_source.page_rows(everything), series_catalog(spark), "in")


def reasons(spark, rows):
    _, rejected = parsed(spark, *rows)
    found = {r["raw_artifact_key"]: r["reason"] for r in rejected.collect()}
    return [found.get(f"r{i}/page-0001.json") for i in range(len(rows))]


def test_valid_prices_are_accepted(spark):
    values = ["61.25", "-8.88", "0", "100", "70.123456", 71, "2026", -5]
    rows = [{**ROW, "value": v, "period": f"2026-09-{i:02d}"} for i, v in enumerate(values, 1)]
    silver, rejected = parsed(spark, *rows)
    assert rejected.count() == 0
    got = [r["price"] for r in silver.orderBy("observation_date").collect()]
    assert got == [Decimal(str(v)).quantize(Decimal("0.000001")) for v in values]
    flags = [r["non_positive"] for r in silver.orderBy("observation_date").collect()]
    assert flags == [Decimal(str(v)) <= 0 for v in values]


def test_malformed_text_is_rejected(spark):
    bad = ["", "NA", "--", "1,234.50", "NaN", "Infinity", "-Infinity", "1e3", " 61.25", "61.25 ",
           "+5", ".5", "5.", "01.5", "61.25.1", "0x1A", "6\n"]
    got = reasons(spark, [{**ROW, "value": v} for v in bad])
    assert got == [f"malformed numeric string '{v}'" for v in bad]


def test_other_json_kinds_are_rejected(spark):
    rows = [{**ROW, "value": v} for v in (None, True, 61.25, [1], {"v": 1}, 1e300)]
    rows.append({k: v for k, v in ROW.items() if k != "value"})
    missing = "missing or non-numeric value"
    assert reasons(spark, rows) == [
        missing, missing, "unsupported value type float", "unsupported value type list",
        "unsupported value type dict", "unsupported value type float", missing,
    ]


def test_precision_and_range_are_limited(spark):
    rows = [{**ROW, "value": v} for v in
            ("1.1234567", "1234567890123", "-1234567890123.5", 1234567890123, 10**20, "999999999999")]
    got = reasons(spark, rows)
    assert got[0] == "more than 6 decimal places: '1.1234567'"
    assert all("exceeds Decimal(18, 6)" in r for r in got[1:5])
    assert got[5] is None


@pytest.mark.parametrize(("change", "reason"), [
    ({"series": "XXXX"}, "unknown series 'XXXX'"),
    ({"series": None}, "unknown series None"),
    ({"series": 5}, "unknown series 5"),
    ({"units": "$/GAL"}, "unit '$/GAL', expected '$/BBL'"),
    ({"units": None}, "unit None, expected '$/BBL'"),
    ({"period": "2026-13-01"}, "unparseable period '2026-13-01'"),
    ({"period": "2026-09"}, "unparseable period '2026-09'"),
    ({"period": "2026-9-1"}, "unparseable period '2026-9-1'"),
    ({"period": None}, "unparseable period None"),
    ({"period": "20260925"}, "period is not a daily date: '20260925'"),
    ({"period": 20260925}, "period is not a daily date: 20260925"),
    ({"value": "n/a"}, "malformed numeric string 'n/a'"),
])
def test_row_rejections(spark, change, reason):
    assert reasons(spark, [{**ROW, **change}]) == [reason]


def test_the_first_failing_check_gives_the_reason(spark):
    assert reasons(spark, [{"series": "X", "units": "?", "period": "?", "value": "?"}]) == [
        "unknown series 'X'"]


def test_a_rejected_row_keeps_its_canonical_json_and_page(spark):
    _, rejected = parsed(spark, {**ROW, "value": "NA"})
    row = rejected.collect()[0]
    assert json.loads(row["row_json"]) == {**ROW, "value": "NA"}
    assert row["row_json"].index("period") < row["row_json"].index("series")
    assert (row["source"], row["raw_artifact_key"]) == ("eia", "r0/page-0001.json")


def test_equal_duplicates_collapse_to_the_first_and_conflicts_are_all_rejected(spark):
    other = {**ROW, "period": "2026-09-28"}
    both = page(spark, [ROW, other], [ROW, {**other, "value": "60.875"}])
    silver, rejected = parse_observations(
        page_source.page_rows(both), series_catalog(spark), "in")
    kept = silver.collect()
    assert [(str(r["observation_date"]), r["raw_artifact_key"]) for r in kept] == [
        ("2026-09-25", "r1/page-0001.json")]
    gone = rejected.collect()
    assert [r["reason"] for r in gone] == [CONFLICT] * 2
    assert {json.loads(r["row_json"])["price"] for r in gone} == {61.25, 60.875}


def test_a_key_with_most_rows_of_the_batch_is_handled(spark):
    hot = [{**ROW, "value": str(50 + i % 2)} for i in range(400)]
    rest = [{**ROW, "series": "RBRTE", "period": f"2026-0{m}-{d:02d}"}
            for m in range(1, 9) for d in range(1, 26)]
    silver, rejected = parse_observations(
        page_source.page_rows(page(spark, hot + rest)), series_catalog(spark), "in")
    assert (silver.count(), rejected.count()) == (200, 400)


def test_pages_that_do_not_reconcile_are_refused(spark):
    a, b, c = ({**ROW, "period": f"2026-09-{d}"} for d in (21, 22, 23))
    kinds = lambda p: [r["kind"] for r in page_source.reconcile_pages(p).collect()]
    assert kinds(page(spark, [a, b], [c])) == []
    assert kinds(page(spark, [a, b], [b, c])) == ["repeated row"]
    assert kinds(page(spark, [a, a], total=2)) == ["repeated row"]
    assert kinds(page(spark, [a, b], total=3)) == ["row count"]
    assert kinds(page(spark, [a, b], [c], total=[3, 4])) == ["total changed"]
    with pytest.raises(PageError, match="repeated row"):
        page_source.require_clean_pages(page(spark, [a, b], [b, c]))


def test_pages_of_another_shape_are_refused(spark):
    bodies = ["not json", '{"x":1}', '{"response":{"data":{},"total":"1"}}',
              '{"response":{"data":[],"total":"many"}}', '{"response":{"data":[],"total":0}}']
    df = spark.createDataFrame([("r", i, b) for i, b in enumerate(bodies)],
                               "request_id string, page_no int, body string")
    got = {r["page_no"]: r["detail"] for r in page_source.page_shape_errors(df).collect()}
    assert got == {0: "the body is not JSON", 1: "response.data is not a list",
                   2: "response.data is not a list", 3: "response.total is not an integer"}


def test_raw_page_files_are_read_and_redacted(spark, folder):
    from quayside.plans import files

    root = folder("raw")
    for i in (1, 2):
        body = {"response": {"total": "2", "data": [{**ROW, "period": f"2026-09-2{i}"}]},
                "request": {"params": {"api_key": "s3cr3t"}}}
        files.create_text(spark, f"{root}/page-{i:04d}.json", json.dumps(body))
    df = page_source.read_page_files(
        spark, f"{root}/*.json", source="eia", request_id="r1", route="spt",
        retrieved_at=datetime(2026, 9, 30), secret="s3cr3t")
    assert df.filter("body like '%s3cr3t%'").count() == 0
    page_source.require_clean_pages(df)
    assert page_source.page_rows(df).count() == 2


def test_staged_pages_replay_exactly_or_not_at_all(spark, folder):
    root = folder("stage")
    with pytest.raises(StagingError, match="no finished index"):
        page_source.read_staged(spark, root)
    staged = pages(spark, JANUARY)
    page_source.stage_pages(staged, root, request(spark, JANUARY))
    back, asked = page_source.read_staged(spark, root)
    assert back.select("sha256").collect() == staged.select("sha256").collect()
    assert asked.count() == 1
    index = spark.read.json(f"{root}/index")
    changed = back.withColumn("body", page_source.F.concat("body", page_source.F.lit(" ")))
    assert page_source.staged_differences(changed, index).count() == 1


def test_queries_on_events_parse_each_row_once(spark):
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("the test tables are not here")
    for name in ("silver_observations", "silver_rejected", "rejection_counts", "quality_report", "completeness_issues"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "parseJson" not in plan and "variant" not in plan.lower(), name
