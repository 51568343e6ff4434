import datetime as dt
import os

from pyspark.sql import functions as F

from parcelflow.operators.quality import keep_first_by_key, pk_violations
from parcelflow.operators.stats import merge_metrics, merge_report, sheet_slice
from parcelflow import schemas as S
from parcelflow.plans import jobs, sinks
from tests.fixtures import listing_page, listing_row, migration_page


def test_metric_merge_case(spark):
    rows = [("move_in", "A", "1"), ("move_in", "B", "2"), ("move_out", "A", "3"),
            ("move_out", "C", "4"), ("net", "A", "5"), ("net", "B", "6")]
    df = spark.createDataFrame(rows, "metric string, city string, v string")
    metrics = {"move_in": {"v": "vin"}, "move_out": {"v": "vout"}, "net": {"v": "vnet"}}
    merged = merge_metrics(df, ["city"], "metric", metrics)
    got = {r.city: (r.vin, r.vout, r.vnet) for r in merged.collect()}
    assert got == {"A": ("1", "3", "5"), "B": ("2", None, "6"), "C": (None, "4", None)}
    bad = {r.city for r in merge_report(merged, ["city"], list(metrics)).collect()}
    assert bad == {"B", "C"}


def test_sheet_slice_by_position(spark):
    rows = [(0, "title"), (1, "10812"), (2, "10901"), (3, "10902"), (4, "note"), (5, "10901")]
    df = spark.createDataFrame(rows, "row_no long, c0 string")
    assert [r.c0 for r in sheet_slice(df).orderBy("row_no").collect()] == [
        "10901", "10902", "note", "10901"]
    assert sheet_slice(df, marker="99999").count() == 0


def test_pk_checks(spark):
    df = spark.createDataFrame([(1, "a", 0), (1, "a", 1), (2, "b", 2)] + [(9, "h", i) for i in range(3, 60)],
                               "k int, s string, ord int")
    assert {(r.k, r.n) for r in pk_violations(df, ["k", "s"]).collect()} == {(1, 2), (9, 57)}
    kept, dups = keep_first_by_key(df, ["k", "s"], "ord")
    assert sorted(r.ord for r in kept.collect()) == [0, 2, 3]
    assert dups.count() == 57


def test_load_loans(spark, root):
    rows = [(0, "title"), (1, "10812"), (2, "10901"), (3, "10902"), (4, "note")]
    sheet = spark.createDataFrame([(n, c0, *[str(i) for i in range(1, 9)]) for n, c0 in rows],
                                  "row_no long, " + ", ".join(f"c{i} string" for i in range(9)))
    out = jobs.load_loans(spark, root, sheet, dt.datetime(2025, 8, 14))
    assert out["consumer_loans"] == {"deleted_rows": 0, "inserted_rows": 2}
    cons = sinks.read_or_empty(spark, os.path.join(root, "consumer_loans"), S.CONSUMER_LOANS).orderBy("roc_month").collect()
    assert [(r.roc_year, r.roc_month, r.ad_year, r.ad_month) for r in cons] == [
        (109, 1, 2020, 1), (109, 2, 2020, 2)]
    assert cons[0].car_loan == "4"
    constr = sinks.read_or_empty(spark, os.path.join(root, "construction_loans"), S.CONSTRUCTION_LOANS).collect()
    assert {r.construction_loan for r in constr} == {"8"}
    rejects = spark.read.parquet(os.path.join(root, "rejects")).collect()
    assert {r.reason for r in rejects} == {"BAD_YEAR_MONTH"} and len(rejects) == 2
    again = jobs.load_loans(spark, root, sheet, dt.datetime(2025, 8, 15))
    assert again["consumer_loans"] == {"deleted_rows": 2, "inserted_rows": 2}


def test_load_migration(spark, root):
    def page(metric, rows):
        return (metric, "113", "1", migration_page(rows))
    pages = spark.createDataFrame([
        page("move_in", [["臺北市", "10", "11"], ["新北市", "20", "21"]]),
        page("move_out", [["臺北市", "4", "5"], ["桃園市", "1", "1"]]),
        page("net", [["臺北市", "6", "6"], ["新北市", "20", "21"]]),
    ], "metric string, roc_year string, roc_month string, html string")
    report, net = jobs.load_migration(spark, root, pages, dt.datetime(2025, 8, 14))
    assert {r.city_district_name for r in report.collect()} == {"新北市", "桃園市"}
    # 臺北市: 10 - 4 = 6 and 11 - 5 = 6 agree; the rows missing a metric cannot be checked.
    assert net.count() == 0
    mig = {r.city_district_name: r for r in spark.read.parquet(os.path.join(root, "migration")).collect()}
    assert (mig["臺北市"].m_move_in, mig["臺北市"].f_move_out, mig["臺北市"].m_net_migration) == ("10", "5", "6")
    assert mig["桃園市"].m_move_in is None and mig["臺北市"].roc_year == 113
    assert (mig["臺北市"].id, mig["新北市"].id) == (1, 2)


def test_load_migration_ids_skip_short_rows_across_pages(spark, root):
    pages = spark.createDataFrame([
        ("move_in", "113", "2", 1, migration_page([["合計"], ["臺北市", "1", "2"]])),
        ("move_in", "113", "2", 2, migration_page([["新北市", "3", "4"]])),
        ("move_out", "113", "2", 1, migration_page([["臺北市", "0", "0"], ["新北市", "1", "1"]])),
        ("net", "113", "2", 1, migration_page([["臺北市", "1", "2"], ["新北市", "2", "3"]])),
    ], "metric string, roc_year string, roc_month string, page int, html string")
    report, net = jobs.load_migration(spark, root, pages, dt.datetime(2025, 8, 14))
    assert report.count() == 0
    # Both cities' nets equal move-in minus move-out.
    assert net.count() == 0
    mig = {r.city_district_name: r.id for r in spark.read.parquet(os.path.join(root, "migration")).collect()}
    assert mig == {"臺北市": 1, "新北市": 2}


def test_load_listings(spark, root):
    keys = spark.createDataFrame([(1, "臺北市", "大安區"), (2, "臺北市", "信義區")],
                                 "record_id int, city_name string, district_name string")
    d = dt.date(2025, 8, 12)
    jobs.write_check_list(spark, root, keys, d, dt.datetime(2025, 8, 12, 8))
    p1 = listing_page([listing_row("A路1號"), listing_row("A路2號"), "<tr><td>x</td></tr>"])
    p2 = listing_page([listing_row("A路3號")])
    old = listing_page([listing_row("Z路9號")])
    pages = spark.createDataFrame([
        (1, "臺北市", "大安區", 1, 2, p2), (2, "臺北市", "大安區", 1, 1, p1),
        (3, "臺北市", "信義區", 1, 1, old)],
        "page_id long, city_name string, district_name string, batch_id int, page int, html string")
    out = jobs.load_listings(spark, root, pages, d, dt.datetime(2025, 8, 12, 9))
    assert out == {"rejects": 1, "emptied": 0}
    stage = spark.read.parquet(os.path.join(root, "stage"))
    got = sorted((r.district_name, r.city_district_id, r.address) for r in stage.collect())
    assert got == [("信義區", 1, "Z路9號"), ("大安區", 1, "A路1號"), ("大安區", 2, "A路2號"),
                   ("大安區", 3, "A路3號")]
    # The second district now reports no result: its stage rows go, the rest stay.
    lines = spark.createDataFrame([("臺北市", "信義區", "查詢結果：0 筆")],
                                  "city_name string, district_name string, text string")
    empty_pages = pages.where("false")
    out = jobs.load_listings(spark, root, pages.where(F.col("district_name") == "大安區"), d,
                             dt.datetime(2025, 8, 12, 10), result_lines=lines)
    assert out["emptied"] == 1 and empty_pages.count() == 0
    stage = spark.read.parquet(os.path.join(root, "stage"))
    assert stage.where(F.col("district_name") == "信義區").count() == 0
    assert stage.where(F.col("district_name") == "大安區").count() == 3
    ck = {r.district_name: r for r in spark.read.parquet(os.path.join(root, "check_list")).collect()}
    assert ck["大安區"].done_yn == "Y" and ck["大安區"].total_row_count == 3
    assert ck["信義區"].done_yn == "Y" and ck["信義區"].total_row_count == 0


def test_load_listings_full_crawl_resumes(spark, root):
    keys = spark.createDataFrame([(1, "臺北市", "大安區"), (2, "臺北市", "信義區")],
                                 "record_id int, city_name string, district_name string")
    jobs.write_check_list(spark, root, keys, None, dt.datetime(2025, 7, 1))
    # Seeding again keeps the existing list (the crawl resumes).
    again = jobs.write_check_list(spark, root, keys.where("record_id = 1"), None, dt.datetime(2025, 7, 2))
    assert again.count() == 2
    page = listing_page([listing_row("A路1號"), listing_row("A路2號")])
    pages = spark.createDataFrame([(1, "臺北市", "大安區", 1, 1, page)],
                                  "page_id long, city_name string, district_name string, batch_id int, page int, html string")
    jobs.load_listings(spark, root, pages, None, dt.datetime(2025, 7, 1, 9))
    full = spark.read.parquet(os.path.join(root, "full_stage"))
    assert full.count() == 2
    from parcelflow.operators.checklist import pending_keys
    ck = sinks.read_or_empty(spark, os.path.join(root, "full_check_list"), S.CHECK_LIST)
    assert [r.district_name for r in pending_keys(ck).collect()] == ["信義區"]
    done = ck.where("done_yn = 'Y'").first()
    assert done.total_row_count == 2 and done.scraped_time == dt.datetime(2025, 7, 1, 9)


def test_net_mismatch_reported_not_dropped(spark, root):
    def page(metric, male, female):
        return (metric, "113", "3", migration_page([["臺北市", male, female]]))
    pages = spark.createDataFrame([page("move_in", "1,000", "10"), page("move_out", "400", "4"),
                                   page("net", "500", "6")],
                                  "metric string, roc_year string, roc_month string, html string")
    _, net = jobs.load_migration(spark, root, pages, dt.datetime(2025, 8, 14))
    assert [r.m_net_migration for r in net.collect()] == ["500"]
    assert spark.read.parquet(os.path.join(root, "migration")).count() == 1


def test_loaders_write_run_and_error_logs(spark, root):
    import pytest
    rows = [(0, "10901", *[str(i) for i in range(1, 9)])]
    sheet = spark.createDataFrame(rows, "row_no long, " + ", ".join(f"c{i} string" for i in range(9)))
    jobs.load_loans(spark, root, sheet, dt.datetime(2025, 8, 14))
    runs = spark.read.parquet(os.path.join(root, "run_log")).collect()
    assert [(r.job, r.result_msg) for r in runs] == [("load_loans", "LOAD_LOANS_DONE")]
    with pytest.raises(Exception):
        jobs.load_loans(spark, root, sheet.drop("c8"), dt.datetime(2025, 8, 14))
    errs = spark.read.parquet(os.path.join(root, "error_log")).collect()
    assert [e.job for e in errs] == ["load_loans"] and errs[0].err_msg


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None)
@given(st.dictionaries(st.sampled_from(["in", "out", "net"]),
                       st.dictionaries(st.sampled_from(list("ABCDEFG")), st.integers(0, 99), max_size=7),
                       max_size=3))
def test_merge_metrics_equals_full_outer_join(spark, tables):
    metrics = ["in", "out", "net"]
    rows = [(m, k, v) for m, kv in tables.items() for k, v in kv.items()]
    df = spark.createDataFrame(rows, "metric string, key string, v int")
    merged = merge_metrics(df, ["key"], "metric", {m: {"v": f"v_{m}"} for m in metrics})
    got = {r.key: (r.v_in, r.v_out, r.v_net) for r in merged.collect()}
    keys = {k for kv in tables.values() for k in kv}
    want = {k: tuple(tables.get(m, {}).get(k) for m in metrics) for k in keys}
    assert got == want


def test_cli_loaders(spark, root, capsys):
    import json
    from parcelflow.plans import cli
    sheet_path = os.path.join(root, "in_sheet")
    rows = [(0, "title"), (1, "10901"), (2, "10902")]
    spark.createDataFrame([(n, c0, *[str(i) for i in range(1, 9)]) for n, c0 in rows],
                          "row_no long, " + ", ".join(f"c{i} string" for i in range(9))
                          ).write.parquet(sheet_path)
    assert cli.main(["load-loans", "--root", root, "--sheet", sheet_path]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["consumer_loans"] == {"deleted_rows": 0, "inserted_rows": 2}
    pages_path = os.path.join(root, "in_pages")
    spark.createDataFrame([(1, "臺北市", "大安區", 1, 1, listing_page([listing_row("A路1號")]))],
                          "page_id long, city_name string, district_name string, batch_id int, "
                          "page int, html string").write.parquet(pages_path)
    assert cli.main(["load-listings", "--root", root, "--pages", pages_path,
                     "--stage-date", "2025-08-12"]) == 0
    assert spark.read.parquet(os.path.join(root, "stage")).count() == 1


def test_cli_load_migration(spark, root, capsys):
    import json
    from parcelflow.plans import cli
    path = os.path.join(root, "in_migration")
    spark.createDataFrame([
        ("move_in", "113", "1", migration_page([["臺北市", "10", "11"]])),
        ("move_out", "113", "1", migration_page([["臺北市", "4", "5"]])),
        ("net", "113", "1", migration_page([["臺北市", "6", "7"]]))],
        "metric string, roc_year string, roc_month string, html string").write.parquet(path)
    assert cli.main(["load-migration", "--root", root, "--pages", path]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out == {"mismatched_keys": 0, "net_mismatch_rows": 1}   # female: 11 - 5 != 7
