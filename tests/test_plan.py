import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from parcelflow.operators.plan import (
    crawl_period, page_batches, period_filter, renumber, year_month_calendar,
)


def batches(spark, pages):
    df = spark.createDataFrame([("c", "d", p) for p in pages], "city string, district string, pages long")
    return [(r.batch_id, r.begin_page_num, r.end_page_num)
            for r in page_batches(df).orderBy("begin_page_num").collect()]


def test_batches_230(spark):
    got = [(b, e) for _, b, e in batches(spark, [230])]
    assert got == [(1, 100), (101, 200), (201, 230)]


def test_batch_tiers(spark):
    df = spark.createDataFrame([(str(p), p) for p in (999, 1000, 1999, 2000)], "k string, pages long")
    out = page_batches(df).where("batch_id = 1").select("k", "end_page_num").collect()
    assert {r.k: r.end_page_num for r in out} == {"999": 100, "1000": 300, "1999": 300, "2000": 500}


def test_no_pages_no_batch(spark):
    assert batches(spark, [0]) == []


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=4000), min_size=1, max_size=6))
def test_batches_cover_pages(spark, pages):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "k int, pages long")
    out = page_batches(df).collect()
    for i, p in enumerate(pages):
        mine = sorted((r.batch_id, r.begin_page_num, r.end_page_num) for r in out if r.k == i)
        assert [b for b, _, _ in mine] == list(range(1, len(mine) + 1))
        covered = [x for _, b, e in mine for x in range(b, e + 1)]
        assert covered == list(range(1, p + 1))


def test_calendar_case(spark):
    rows = [("113", str(m)) for m in range(1, 13)] + [("113", "全年")] + [("114", str(m)) for m in range(1, 8)]
    offered = spark.createDataFrame(rows, "roc_year string, roc_month string")
    out = year_month_calendar(offered, 113, dt.date(2025, 8, 14)).orderBy("id").collect()
    assert [r.id for r in out] == list(range(1, 20))
    assert (out[0].roc_year, out[0].roc_month) == ("113", "1")
    assert (out[-1].roc_year, out[-1].roc_month) == ("114", "7")


def test_crawl_period():
    assert crawl_period(dt.date(2025, 8, 14), 4, monthly=False) == (202101, 202508)
    assert crawl_period(dt.date(2025, 8, 14), 0, monthly=True) == (202508, 202508)
    assert crawl_period(dt.date(2025, 8, 14), 1, monthly=True) == (202408, 202508)


def test_renumber_matches_window_with_hot_key(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        if i % 3 == 0:
            key = ("hot", "h")                      # a third of all rows
        elif i % 97 == 0:
            key = (None, "n")                       # NULL key
        else:
            key = ("c", f"d{rnd.randint(0, 20)}")
        rows.append((*key, rnd.randint(0, 50), i))
    df = spark.createDataFrame(rows, "city string, district string, b int, i int")
    got = renumber(df, ["city", "district"], ["b", "i"], "n", num_partitions=7)
    w = Window.partitionBy("city", "district").orderBy("b", "i")
    want = df.withColumn("n", F.row_number().over(w))
    assert sorted(map(tuple, got.select("i", "n").collect())) == sorted(
        map(tuple, want.select("i", "n").collect()))


def test_renumber_spreads_hot_key(spark):
    df = spark.range(4000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    got = renumber(df, ["k"], ["v"], "n", num_partitions=8)
    parts = got.select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 1
    assert got.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first() == (1, 4000, 4000)


def explain_text(df):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_period_filter_pushed_to_scan(spark):
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    q = period_filter(o, "o_orderdate", 199701, 200010, "o_orderstatus", ["F", "O"]).select("o_orderkey")
    plan = explain_text(q)
    assert "PushedFilters" in plan and "o_orderdate" in plan.split("PushedFilters")[1]
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz>" in plan


def test_crawl_batches(spark):
    from parcelflow.operators.plan import crawl_batches
    lines = spark.createDataFrame([("a", "查詢結果：1,234 筆"), ("b", "載入中"), ("c", "查詢結果：0 筆")],
                                  "district string, text string")
    out = crawl_batches(lines).collect()
    assert {(r.district, r.total_records, r.batch_id, r.begin_page_num, r.end_page_num) for r in out} == {
        ("a", 1234, 1, 1, 83)}


def test_renumber_same_after_losing_its_cache(spark):
    from parcelflow.operators.plan import release
    df = spark.range(3000).select((F.col("id") % 4).cast("string").alias("k"),
                                  (F.col("id") * 7 % 1000).alias("v"), "id")
    out = renumber(df, ["k"], ["v", "id"], "n", num_partitions=5)
    first = sorted(map(tuple, out.select("id", "n").collect()))
    release(out)  # as if the executors holding the cache were lost
    again = sorted(map(tuple, out.select("id", "n").collect()))
    assert first == again


def test_no_pending_key_gives_empty_result(spark):
    from parcelflow.operators.checklist import pending_keys, pending_range
    ck = spark.createDataFrame([(1, "c", "d", "Y")], "record_id int, city string, district string, done_yn string")
    assert pending_keys(ck, status_cols=("done_yn",)).count() == 0
    assert tuple(pending_range(ck, "district", status_cols=("done_yn",)).first()) == (None, None, None, None)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 5)), min_size=0, max_size=60),
       st.integers(min_value=1, max_value=9))
def test_renumber_property(spark, rows, parts):
    df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(rows)], "k string, v int, i int")
    got = renumber(df, ["k"], ["v", "i"], "n", num_partitions=parts)
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("v", "i")))
    assert sorted(map(tuple, got.select("i", "n").collect())) == sorted(
        map(tuple, want.select("i", "n").collect()))


def test_partitions_for():
    from parcelflow.operators.plan import partitions_for
    assert partitions_for(0, 1000, 50) == 1
    assert partitions_for(2500, 1000, 50) == 3
    assert partitions_for(10**9, 1000, 50) == 50


def test_month_gaps(spark):
    from parcelflow.operators.plan import month_gaps
    offered = [("110", str(m)) for m in range(1, 13)] + [("111", "1"), ("111", "2"), ("111", "全年"), ("111", "5"), (None, "1")]
    loaded = [(110, 1), (110, 4), (111, 5), (110, 4), (99, 1)]
    got = month_gaps(spark.createDataFrame(offered, "roc_year string, roc_month string"),
                     spark.createDataFrame(loaded, "roc_year int, roc_month int"))
    assert sorted(map(tuple, got.collect())) == [(110, 2, 110, 3, 2), (110, 5, 111, 2, 10)]
    none = spark.createDataFrame([], "roc_year int, roc_month int")
    assert month_gaps(none, none).count() == 0


def test_migration_load_reports_missing_months(spark, root, capsys):
    import json
    import os
    from parcelflow import schemas as S
    from parcelflow.plans import cli, sinks
    from tests.fixtures import migration_page
    def put(name, rows, schema):
        path = os.path.join(root, "in", name)
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(path)
        return path
    months = put("months", [("113", str(m)) for m in range(1, 13)] + [("113", "全年"), ("109", "1")], "roc_year string, roc_month string")
    def said():
        return json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert cli.main(["plan-migration", "--root", root, "--months", months, "--begin-roc-year", "110",
                     "--run-date", "2024-12-31"]) == 0
    assert said() == {"months": 12, "missing_ranges": 1, "missing_months": 12}
    page = migration_page([["臺北市", "1", "2"]])
    pages = put("pages", [(m, "113", str(k), page) for m in ("move_in", "move_out", "net") for k in (3, 4, 11)],
                "metric string, roc_year string, roc_month string, html string")
    assert cli.main(["load-migration", "--root", root, "--pages", pages]) == 0
    assert said()["missing"] == ["113/1-113/2", "113/5-113/10", "113/12-113/12"]
    gaps = sinks.read_or_empty(spark, os.path.join(root, "migration_gaps"), S.MIGRATION_GAPS)
    assert gaps.agg(F.sum("n_months")).first()[0] == 9
