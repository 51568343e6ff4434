"""Integration invariants on the driver's tables (sf0.001): total = main +
sub for every key, the ledger holds exactly the integrated rows, keys outside
the check list stay untouched, and a second run on the same day changes
nothing."""

import datetime as dt
import os

from pyspark.sql import functions as F

import bench
from parcelflow import schemas as S
from parcelflow.plans import jobs, sinks
from parcelflow.sources.testdata import ck

SF = "/root/testdata/sf0.001"


def test_integration_invariants_on_test_tables(spark, root):
    d1, d2 = dt.date(2000, 1, 1), dt.date(2000, 1, 2)
    cols = [f.name for f in S.STAGE.fields]
    before_2000 = F.col("tx_date") < F.lit("2000-01-01").cast("timestamp_ntz")
    full = bench._stage_from_tx(spark, SF, before_2000, None)
    sinks.overwrite_partitions(full, os.path.join(root, "full_stage"), S.KEYS, cols)
    day = bench._stage_from_tx(spark, SF, ~before_2000, d2)
    sinks.overwrite_partitions(day, os.path.join(root, "stage"), ["stage_date", *S.KEYS], cols)
    opts = ck(spark, SF).select("record_id", F.col("city").alias("city_name"),
                                F.col("district").alias("district_name"))
    jobs.write_check_list(spark, root, opts, None, dt.datetime(2000, 1, 1))
    # The daily list leaves out five districts.
    jobs.write_check_list(spark, root, opts.where("record_id > 5"), d2, dt.datetime(2000, 1, 2))
    jobs.integrate_job(spark, root, d1)
    ledger_path = os.path.join(root, "ledger")
    after_first = spark.read.parquet(ledger_path)
    outside = {(r.city_name, r.district_name, r.n) for r in opts.where("record_id <= 5").join(
        after_first, S.KEYS).groupBy(*S.KEYS).agg(F.count(F.lit(1)).alias("n")).collect()}
    jobs.integrate_job(spark, root, d2)
    led = spark.read.parquet(ledger_path)
    rec = spark.read.parquet(os.path.join(root, "ledger_record")).where(F.col("exec_date") == F.lit(d2))
    bad = rec.where(F.col("total_row_count") != F.col("main_table_row_count") + F.col("sub_table_row_count"))
    assert bad.count() == 0 and rec.count() == 20
    in_list = led.join(opts.where("record_id > 5"), S.KEYS, "left_semi").count()
    assert in_list == rec.agg(F.sum("total_row_count")).first()[0]
    assert led.count() == full.count() + day.join(opts.where("record_id > 5"), S.KEYS, "left_semi").count()
    outside_now = {(r.city_name, r.district_name, r.n) for r in opts.where("record_id <= 5").join(
        led, S.KEYS).groupBy(*S.KEYS).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert outside_now == outside
    snapshot = sorted(map(tuple, led.select("address", "stage_date").collect()))
    jobs.integrate_job(spark, root, d2)
    again = sorted(map(tuple, spark.read.parquet(ledger_path).select("address", "stage_date").collect()))
    assert again == snapshot
