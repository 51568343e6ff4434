"""Primary keys across loads, fingerprints, carried counts."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from parcelflow import schemas as S
from parcelflow.operators import keys
from parcelflow.operators.integrate import drop_known, with_fingerprint
from parcelflow.plans import jobs
from parcelflow.streaming.stage_feed import integrate_batch
from tests.test_jobs import D1, D2, K1, K2, ledger, put_checks, put_full, put_stage, record, stage_df

D3 = dt.date(2025, 8, 22)


def rows(spark, numbers):
    return spark.createDataFrame([(n, None if n % 7 == 0 else f"k{n}") for n in numbers], "a long, b string")


@pytest.mark.parametrize("stored,asked", [(range(0), range(5)), (range(5), range(0)), (range(3000), range(2900, 9000)),
                                          (range(100), range(1000, 2000))])
def test_stored_duplicates(spark, stored, asked):
    old, new = rows(spark, stored), rows(spark, asked)
    filters = keys.key_filter(old, ["a", "b"])
    got = sorted(r.a for r in keys.stored_duplicates(new, old, ["a", "b"], filters).collect())
    assert got == sorted(set(stored) & set(asked))
    assert got == sorted(r.a for r in keys.stored_duplicates(new, old, ["a", "b"]).collect())


def test_false_positives_are_few_and_looked_up(spark):
    old, new = rows(spark, range(20_000)), rows(spark, range(20_000, 60_000))
    filters = keys.key_filter(old, ["a", "b"])
    maybe = keys.might_be_stored(new, filters, ["a", "b"]).count()
    assert 0 < maybe < 400  # 1 %
    assert keys.stored_duplicates(new, old, ["a", "b"], filters).count() == 0
    both = keys.might_be_stored(rows(spark, range(19_990, 20_010)), filters, ["a", "b"])
    assert {r.a for r in both.collect()} >= set(range(19_990, 20_000))  # never a false negative


def test_filters_of_several_loads(spark):
    loads = [rows(spark, r) for r in (range(10), range(10, 5000), range(5000, 5100))]
    filters = loads[0].sparkSession.createDataFrame([], keys.FILTER)
    for load in loads:
        filters = filters.unionByName(keys.key_filter(load, ["a", "b"]))
    asked = rows(spark, [3, 4000, 5050, 70_001])
    got = {r.a for r in keys.might_be_stored(asked, filters, ["a", "b"]).collect()}
    assert got >= {3, 4000, 5050}


# --- fingerprints -----------------------------------------------------------

def business(spark, values):
    """values: (address, note)."""
    out = spark.createDataFrame(values, "address string, note string")
    for c in S.LEDGER_COLUMNS:
        if c not in ("address", "note"):
            out = out.withColumn(c, F.lit(None if c == "type" else "x").cast("string"))
    return with_fingerprint(out)


def test_known_rows_are_dropped(spark):
    old = business(spark, [("a", "1"), ("a", None), ("b", "1"), ("b", "1")])
    new = business(spark, [("a", "1"), ("a", "-"), ("a", None), ("b", "2"), ("1:b", None), (None, None)])
    got = drop_known(new, old).select("address", "note").collect()
    assert sorted(map(tuple, got), key=str) == sorted([("a", "-"), ("b", "2"), ("1:b", None), (None, None)], key=str)


def test_equal_fingerprints_of_different_rows_are_confirmed(spark):
    old = business(spark, [("a", "1")]).withColumn("fingerprint", F.lit(b"same"))
    new = business(spark, [("a", "1"), ("z", "1")]).withColumn("fingerprint", F.lit(b"same"))
    assert [r.address for r in drop_known(new, old).collect()] == ["z"]


def test_fingerprints_tell_columns_apart(spark):
    made = business(spark, [("ab", "c"), ("a", "bc"), ("", None), (None, ""), ("-", "-"), (None, None)])
    assert made.select("fingerprint").distinct().count() == 6
    assert {len(r.fingerprint) for r in made.collect()} == {16}


def test_dedupe_shuffles_only_fingerprints(spark):
    old, new = business(spark, [("a", "1")] * 3), business(spark, [("a", "1"), ("b", "1")])
    plan = drop_known(new, old)._jdf.queryExecution().executedPlan().toString()
    keys_of = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert keys_of and all("hashpartitioning(fingerprint" in line for line in keys_of)


# --- carried counts -----------------------------------------------------------

def run(spark, root, day, rows, **kw):
    put_stage(spark, root, rows, day)
    put_checks(spark, root, [(1, K1), (2, K2)], day)
    return jobs.integrate_job(spark, root, day, dt.datetime.combine(day, dt.time(kw.pop("hour", 1))), **kw)


def counts(spark, root, day):
    return record(spark, root, day, K1), record(spark, root, day, K2)


@pytest.fixture()
def started(spark, root):
    put_full(spark, root, [(*K1, "A1"), (*K1, "A2"), (*K2, "Z1")])
    put_checks(spark, root, [(1, K1), (2, K2)], None)
    jobs.integrate_job(spark, root, D1)
    return root


@pytest.mark.parametrize("kw", [{}, {"recount": True}])
def test_carried_counts_equal_a_recount(spark, started, kw):
    run(spark, started, D2, [(*K1, "B1")], **kw)
    run(spark, started, D3, [(*K1, "C1"), (*K2, "C2"), (*K2, "C3")], **kw)
    assert counts(spark, started, D2) == ([(2, 1, 3)], [(1, 0, 1)])
    assert counts(spark, started, D3) == ([(3, 1, 4)], [(1, 2, 3)])
    assert ledger(spark, started).count() == 7


def test_a_rerun_of_a_day_carries_from_the_day_before(spark, started):
    run(spark, started, D2, [(*K1, "B1"), (*K1, "B2")])
    run(spark, started, D2, [(*K1, "B1")], hour=2)
    assert counts(spark, started, D2) == ([(2, 1, 3)], [(1, 0, 1)])


def test_an_earlier_day_after_a_later_one_is_counted(spark, started):
    run(spark, started, D3, [(*K1, "C1")])
    run(spark, started, D2, [(*K1, "B1"), (*K1, "B2")], hour=9)
    assert counts(spark, started, D2) == ([(3, 2, 5)], [(1, 0, 1)])
    late = dt.date(2025, 9, 2)
    run(spark, started, late, [(*K2, "E1")])
    assert counts(spark, started, late) == ([(5, 0, 5)], [(1, 1, 2)])


def test_a_daily_run_reads_no_old_ledger_file(spark, started):
    run(spark, started, D2, [(*K1, "B1")])
    old = [os.path.join(d, f) for d, _, fs in os.walk(os.path.join(started, "ledger")) for f in fs if f.endswith(".parquet")]
    whole = {f: open(f, "rb").read() for f in old}
    for f in old:
        with open(f, "wb") as fh:
            fh.write(b"no parquet file")
        crc = os.path.join(os.path.dirname(f), "." + os.path.basename(f) + ".crc")
        if os.path.exists(crc):
            os.unlink(crc)
    run(spark, started, D3, [(*K1, "C1")])
    assert counts(spark, started, D3) == ([(3, 1, 4)], [(1, 0, 1)])
    with pytest.raises(Exception):
        run(spark, started, D3, [(*K1, "C1")], recount=True)
    for f, data in whole.items():
        with open(f, "wb") as fh:
            fh.write(data)
    spark.catalog.refreshByPath(os.path.join(started, "ledger"))
    run(spark, started, D3, [(*K1, "C1")], recount=True)
    assert counts(spark, started, D3) == ([(3, 1, 4)], [(1, 0, 1)])


def test_a_key_without_a_record_is_counted(spark, started):
    k3 = ("臺北市", "中山區")
    put_stage(spark, started, [(*k3, "N1")], D2)
    put_checks(spark, started, [(1, K1), (3, k3)], D2)
    jobs.integrate_job(spark, started, D2)
    assert record(spark, started, D2, K1) == [(2, 0, 2)] and record(spark, started, D2, k3) == [(0, 1, 1)]


# --- keys across feed batches -------------------------------------------------

def feed_batch(spark, addresses, crawl="c1"):
    return stage_df(spark, [(*K1, a) for a in addresses], D2).withColumns(
        {"crawl_id": F.lit(crawl), "city_district_id": F.ascii("address")})


def test_rows_landed_before_are_rejected(spark, started):
    put_checks(spark, started, [(1, K1)], D2)
    integrate_batch(spark, started, feed_batch(spark, ["a", "b", "b"]), 0)
    for _ in range(2):  # a replay finds the same
        integrate_batch(spark, started, feed_batch(spark, ["b", "c"]), 1)
        got = sorted(r.address for r in ledger(spark, started).where("stage_date is not null").collect())
        assert got == ["a", "b", "c"]
        rejects = spark.read.parquet(os.path.join(started, "rejects")).collect()
        assert sorted((r.reason, r.key.split("/")[1]) for r in rejects) == [("DUPLICATE_KEY", "0"), ("DUPLICATE_KEY", "1")]
    # The same row of another crawl is no duplicate.
    integrate_batch(spark, started, feed_batch(spark, ["b"], "c2"), 2)
    assert len(spark.read.parquet(os.path.join(started, "rejects")).collect()) == 2
    assert spark.read.parquet(os.path.join(started, "feed_keys")).count() == 3
