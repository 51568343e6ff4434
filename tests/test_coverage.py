"""Page coverage, crawl identity, done flags and replaced rejects."""

import datetime as dt
import os
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelflow import schemas as S
from parcelflow.operators.coverage import page_gaps
from parcelflow.operators.crawls import crawls, last_crawl
from parcelflow.operators.plan import page_batches
from parcelflow.plans import jobs
from parcelflow.streaming.stage_feed import integrate_batch
from tests.test_crawl import DAY, TS, listing_pages, page
from tests.test_jobs import D1, D2, K1, K2, ledger, put_checks, put_full, stage_df

TIERS = {"tiers": ((20, 5), (10, 3)), "default": 2}
GOOD, SHORT = ["A"] * 19, ["short"]


def gaps_by_hand(plan, loaded):
    out = set()
    for key, batch, begin, end in plan:
        have = {p for k, p in loaded if k == key}
        lo = None
        for p in range(begin, end + 2):
            missing = p <= end and p not in have
            if missing and lo is None:
                lo = p
            if not missing and lo is not None:
                out.add((key, batch, lo, p - 1, p - lo))
                lo = None
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 47), min_size=1, max_size=6), st.integers(0, 10**6))
def test_gaps_against_a_loop(spark, pages, seed):
    rnd = random.Random(seed)
    keys = [(f"k{i}" if i else None, n) for i, n in enumerate(pages)]
    plan = page_batches(spark.createDataFrame(keys, "k string, pages int"), "pages", **TIERS)
    loaded = [(k, p) for k, n in keys for p in range(1, n + 4) if rnd.random() < 0.7] * 2 + [("k1", None), ("other", 1)]
    got = page_gaps(plan, spark.createDataFrame(loaded, "k string, page int"), ["k"])
    want = gaps_by_hand([tuple(r) for r in plan.select("k", "batch_id", "begin_page_num", "end_page_num").collect()], loaded)
    rows = [tuple(r) for r in got.select("k", "batch_id", "gap_begin", "gap_end", "n_pages").collect()]
    assert len(rows) == len(want) and set(rows) == want


def checks(spark, root):
    return {r.district_name: (r.total_row_count, r.done_yn, r.scraped_time and r.scraped_time.hour)
            for r in spark.read.schema(S.CHECK_LIST).parquet(os.path.join(root, "check_list")).collect()}


def table(spark, root, name, *cols):
    return sorted(map(tuple, spark.read.parquet(os.path.join(root, name)).select(*cols).collect()))


def paged(spark, rows):
    """rows: (district, page, html)."""
    return spark.createDataFrame([(i, K1[0], d, 1, p, h) for i, (d, p, h) in enumerate(rows)],
                                 "page_id long, city_name string, district_name string, batch_id int, page int, html string")


def put_plan(spark, root, plan):
    """plan: (district, pages) for DAY."""
    rows = [(K1[0], d, n * 15, 1, 1, n, DAY) for d, n in plan]
    spark.createDataFrame(rows, S.CRAWL_PLAN).write.partitionBy("stage_date").mode("append").parquet(
        os.path.join(root, "crawl_plan"))


def test_a_missing_page_keeps_its_district_pending(spark, root):
    put_checks(spark, root, [(1, K1), (2, K2)], DAY)
    put_plan(spark, root, [(K1[1], 3), (K2[1], 2)])
    one = page(GOOD)
    out = jobs.load_listings(spark, root, paged(spark, [(K1[1], 1, one), (K1[1], 3, one), (K2[1], 1, one), (K2[1], 2, one)]),
                             DAY, TS)
    assert out["missing_pages"] == 1
    assert checks(spark, root) == {K1[1]: (None, None, None), K2[1]: (2, "Y", 10)}
    assert table(spark, root, "crawl_gaps", "district_name", "gap_begin", "gap_end", "n_pages") == [(K1[1], 2, 2, 1)]
    assert table(spark, root, "load_record", "district_name", "good_rows", "bad_rows", "missing_pages") == sorted([
        (K1[1], 2, 0, 1), (K2[1], 2, 0, 0)])
    # The resumed load brings the whole district: it is done, and its gap is gone.
    out = jobs.load_listings(spark, root, paged(spark, [(K1[1], p, one) for p in (1, 2, 3)] + [(K2[1], 1, page(GOOD, GOOD))]),
                             DAY, TS.replace(hour=11), resume=True)
    assert "missing_pages" not in out
    assert checks(spark, root) == {K1[1]: (3, "Y", 11), K2[1]: (2, "Y", 10)}
    assert spark.read.schema(S.CRAWL_GAPS).parquet(os.path.join(root, "crawl_gaps")).count() == 0


def test_a_recrawl_without_good_rows_is_pending(spark, root):
    put_checks(spark, root, [(1, K1), (2, K2)], DAY)
    jobs.load_listings(spark, root, listing_pages(spark, [(K1[1], page(GOOD, GOOD)), (K2[1], page(GOOD, SHORT))]), DAY, TS)
    assert checks(spark, root) == {K1[1]: (2, "Y", 10), K2[1]: (1, "Y", 10)}
    jobs.load_listings(spark, root, listing_pages(spark, [(K1[1], page(SHORT, SHORT)), (K2[1], "<p>error</p>")]),
                       DAY, TS.replace(hour=11))
    assert checks(spark, root) == {K1[1]: (None, None, None), K2[1]: (None, None, None)}
    # The old rows stay, and the rejects are those of the last crawl of each district.
    assert table(spark, root, "stage", "district_name", "address") == sorted([(K1[1], "A")] * 2 + [(K2[1], "A")])
    assert len(table(spark, root, "rejects", "key")) == 2
    jobs.load_listings(spark, root, listing_pages(spark, [(K1[1], page(GOOD)), (K2[1], page(GOOD))]), DAY, TS.replace(hour=12))
    assert checks(spark, root) == {K1[1]: (1, "Y", 12), K2[1]: (1, "Y", 12)}
    assert spark.read.schema(S.REJECTS).parquet(os.path.join(root, "rejects")).count() == 0


def test_a_district_without_result_is_done(spark, root):
    put_checks(spark, root, [(1, K1), (2, K2)], DAY)
    lines = spark.createDataFrame([(*K1, "查詢結果 : 0 筆"), (*K2, "no line")], "city_name string, district_name string, text string")
    jobs.load_listings(spark, root, listing_pages(spark, [(K1[1], "<p></p>"), (K2[1], "<p></p>")]), DAY, TS, lines)
    assert checks(spark, root) == {K1[1]: (0, "Y", 10), K2[1]: (None, None, None)}


def test_rejects_of_a_mended_sheet_and_month_go(spark, root):
    sheet = [(1, "10901", *["1"] * 8), (2, "note", *["1"] * 8)]
    schema = "row_no long, " + ", ".join(f"c{i} string" for i in range(9))
    jobs.load_loans(spark, root, spark.createDataFrame(sheet, schema), TS)
    assert len(table(spark, root, "rejects", "source")) == 2
    jobs.load_loans(spark, root, spark.createDataFrame(sheet[:1], schema), TS)
    assert spark.read.schema(S.REJECTS).parquet(os.path.join(root, "rejects")).count() == 0


# --- crawl identity ---------------------------------------------------------

def landed(spark, rows):
    """rows: (district, address, crawl_id, seconds, arrival)."""
    data = [(K1[0], d, a, c, None if s is None else TS + dt.timedelta(seconds=s), n, n) for d, a, c, s, n in rows]
    return spark.createDataFrame(data, "city_name string, district_name string, address string, crawl_id string, "
                                       "scraped_time timestamp_ntz, arrival string, landed string")


def kept(spark, rows):
    return sorted(r.address for r in last_crawl(landed(spark, rows), S.KEYS).collect())


def test_rows_of_one_crawl_have_many_times(spark):
    assert len(kept(spark, [("d", f"a{i}", None, i * 0.007, "1") for i in range(30)])) == 30
    assert len(kept(spark, [("d", f"a{i}", "c", i * 900, "1") for i in range(30)])) == 30


def test_the_last_crawl_stays_whole(spark):
    first = [("d", f"a{i}", None, i, "1") for i in range(5)]
    assert kept(spark, first + [("d", "b", None, 7200 + i, "1") for i in range(3)]) == ["b"] * 3
    # Named crawls: over two arrivals, one inside the other's time.
    named = [("d", "a", "c1", 0, "1"), ("d", "b", "c2", 5, "1"), ("d", "a", "c1", 10, "2"), ("d", "b", "c2", 20, "2")]
    assert kept(spark, named) == ["b", "b"]
    # Landed later, crawled earlier: not the last crawl.  At the same time: the later arrival.
    assert kept(spark, [("d", "new", None, 9000, "1"), ("d", "old", None, 0, "2")]) == ["new"]
    assert kept(spark, [("d", "old", None, 0, "1"), ("d", "new", None, 0, "2")]) == ["new"]
    assert kept(spark, [("d", "x", None, None, "1"), ("d", "y", None, None, "1"), (None, "z", None, 0, "1")]) == ["x", "y", "z"]
    assert crawls(landed(spark, named), S.KEYS).count() == 2


def ready(spark, root, *keys):
    put_full(spark, root, [(*K1, "A1")])
    put_checks(spark, root, [(i, k) for i, k in enumerate(keys, 1)], None)
    jobs.integrate_job(spark, root, D1)
    put_checks(spark, root, [(i, k) for i, k in enumerate(keys, 1)], D2)


def batch(spark, rows, crawl, second):
    """rows: (city, district, address, page)."""
    out = stage_df(spark, [r[:3] for r in rows], D2).withColumn("crawl_id", F.lit(crawl))
    pages = F.create_map(*[F.lit(x) for r in rows for x in (r[2], r[3])])
    at = F.lit(f"{TS:%Y-%m-%d %H:%M:%S}").cast("timestamp_ntz") + F.make_dt_interval(
        secs=(F.lit(second) + F.rand(1)).cast("decimal(18,6)"))
    return out.withColumns({"page": F.try_element_at(pages, "address"), "scraped_time": at})


def test_a_crawl_over_two_batches_is_whole(spark, root):
    ready(spark, root, K1, K2)
    integrate_batch(spark, root, batch(spark, [(*K1, "a", 1), (*K2, "z", 1)], "c1", 0), 0)
    integrate_batch(spark, root, batch(spark, [(*K1, "b", 2)], "c1", 60), 1)
    assert sorted(r.address for r in ledger(spark, root).collect()) == ["A1", "a", "b", "z"]
    for _ in range(2):  # replayed after a failure: the same tables
        integrate_batch(spark, root, batch(spark, [(*K1, "n", 1)], "c2", 7200), 2)
        assert sorted(r.address for r in ledger(spark, root).collect()) == ["A1", "n", "z"]


def test_a_planned_crawl_waits_for_all_its_pages(spark, root):
    ready(spark, root, K1, K2)
    spark.createDataFrame([(*K1, 30, 1, 1, 2, D2)], S.CRAWL_PLAN).write.partitionBy("stage_date").parquet(
        os.path.join(root, "crawl_plan"))
    integrate_batch(spark, root, batch(spark, [(*K1, "a", 1), (*K2, "z", 1)], "c1", 0), 0)
    assert sorted(r.address for r in ledger(spark, root).collect()) == ["A1", "z"]
    assert len(integrate_batch(spark, root, batch(spark, [(*K1, "b", 2)], "c1", 60), 1)) == 1
    assert sorted(r.address for r in ledger(spark, root).collect()) == ["A1", "a", "b", "z"]


def test_undated_rows_are_rejected_once(spark, root):
    ready(spark, root, K1)
    undated = stage_df(spark, [(*K1, "U"), (*K1, "V")], D2).withColumn("stage_date", F.lit(None).cast("date"))
    for epoch in (3, 3, 4):
        integrate_batch(spark, root, undated, epoch)
    rows = spark.read.parquet(os.path.join(root, "rejects")).collect()
    assert [r.reason for r in rows] == ["NO_STAGE_DATE"] * 4
