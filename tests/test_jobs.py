import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from parcelflow import schemas as S
from parcelflow.plans import jobs, sinks

D1, D2 = dt.date(2025, 8, 2), dt.date(2025, 8, 12)
K1 = ("臺北市", "大安區")
K2 = ("臺北市", "信義區")


def stage_df(spark, rows, stage_date):
    """rows: (city, district, address[, transaction_date])."""
    data = []
    for i, r in enumerate(rows):
        city, district, address = r[:3]
        tdate = r[3] if len(r) > 3 else "114/07/01"
        biz = {c: "無" for c in S.BUSINESS}
        biz.update(address=address, transaction_date=tdate)
        data.append((i + 1, 1, 1, city, district, *[biz[c] for c in S.BUSINESS],
                     dt.datetime(2025, 8, 1, 10), stage_date))
    return spark.createDataFrame(data, S.STAGE)


def put_full(spark, root, rows):
    sinks.overwrite_partitions(stage_df(spark, rows, None), os.path.join(root, "full_stage"),
                               S.KEYS, [f.name for f in S.STAGE.fields])


def put_stage(spark, root, rows, d):
    sinks.overwrite_partitions(stage_df(spark, rows, d), os.path.join(root, "stage"),
                               ["stage_date", *S.KEYS], [f.name for f in S.STAGE.fields])


def put_checks(spark, root, keys, d):
    opts = spark.createDataFrame([(i, c, t) for i, (c, t) in keys],
                                 "record_id int, city_name string, district_name string")
    jobs.write_check_list(spark, root, opts, d, dt.datetime(2025, 8, 1))


def ledger(spark, root):
    return spark.read.parquet(os.path.join(root, "ledger"))


def record(spark, root, d, key=K1):
    r = (spark.read.parquet(os.path.join(root, "ledger_record"))
         .where((F.col("exec_date") == F.lit(d)) & (F.col("main_table_city_name") == key[0])
                & (F.col("main_table_district_name") == key[1])).collect())
    return [(x.main_table_row_count, x.sub_table_row_count, x.total_row_count) for x in r]


@pytest.fixture()
def first_run(spark, root):
    put_full(spark, root, [(*K1, "A1"), (*K1, "A2")])
    put_stage(spark, root, [(*K1, "B1")], D1)
    put_checks(spark, root, [(1, K1)], None)
    res = jobs.integrate_job(spark, root, D1)
    return root, res


def test_first_run(spark, first_run):
    root, res = first_run
    assert res.first_run and res.result_msg == "FIRST_TIME_RUN_20250802_DONE"
    assert ledger(spark, root).count() == 3
    assert record(spark, root, D1) == [(2, 1, 3)]
    flags = {r.done_yn for r in spark.read.parquet(os.path.join(root, "ledger_record")).collect()}
    assert flags == {"Y_FIRST_TIME_RUN"}


def next_run(spark, root, **kw):
    put_stage(spark, root, [(*K1, "C1"), (*K1, "C2")], D2)
    put_checks(spark, root, [(1, K1)], D2)
    return jobs.integrate_job(spark, root, D2, **kw)


def test_next_run(spark, first_run):
    root, _ = first_run
    res = next_run(spark, root)
    assert not res.first_run and res.result_msg == "DAILY_BY_MONTH_20250812_DONE"
    assert ledger(spark, root).count() == 5
    assert record(spark, root, D2) == [(3, 2, 5)]
    runs = spark.read.parquet(os.path.join(root, "run_log")).count()
    assert runs == 2


def test_rerun_same_day_replaces(spark, first_run):
    root, _ = first_run
    next_run(spark, root)
    jobs.integrate_job(spark, root, D2)
    assert ledger(spark, root).count() == 5
    assert record(spark, root, D2) == [(3, 2, 5)]  # purge kept one record per key


def test_rerun_same_day_append(spark, first_run):
    root, _ = first_run
    next_run(spark, root)
    jobs.integrate_job(spark, root, D2, on_rerun="append")
    assert ledger(spark, root).count() == 7


def test_district_without_rows_and_outside_list(spark, root):
    put_full(spark, root, [(*K1, "A1"), (*K2, "Z1")])
    put_stage(spark, root, [(*K1, "B1")], D1)
    put_checks(spark, root, [(1, K1), (2, ("臺北市", "中山區"))], None)
    jobs.integrate_job(spark, root, D1)
    # K2 is not in the check list: nothing of it is integrated.
    assert ledger(spark, root).where(F.col("district_name") == K2[1]).count() == 0
    assert record(spark, root, D1, ("臺北市", "中山區")) == [(0, 0, 0)]
    before = sorted(map(tuple, ledger(spark, root).select("address").collect()))
    # A later run whose list names a district with no rows leaves the ledger alone.
    put_checks(spark, root, [(1, ("臺北市", "中山區"))], D2)
    put_stage(spark, root, [(*K2, "Q1")], D2)
    jobs.integrate_job(spark, root, D2)
    assert sorted(map(tuple, ledger(spark, root).select("address").collect())) == before
    assert record(spark, root, D2, ("臺北市", "中山區")) == [(0, 0, 0)]


def test_equal_rows_kept(spark, root):
    put_full(spark, root, [(*K1, "A1", "114/07/01"), (*K1, "A1", "114/07/01")])
    put_checks(spark, root, [(1, K1)], None)
    jobs.integrate_job(spark, root, D1)
    assert ledger(spark, root).count() == 2


def test_gap_in_record_id(spark, root):
    put_full(spark, root, [(*K1, "A1"), (*K2, "Z1")])
    put_checks(spark, root, [(1, K1), (3, K2)], None)
    jobs.integrate_job(spark, root, D1)
    assert record(spark, root, D1, K1) == [(1, 0, 1)]
    assert record(spark, root, D1, K2) == [(1, 0, 1)]
    assert ledger(spark, root).count() == 2


def test_failing_write_logs_and_raises(spark, first_run, monkeypatch):
    root, _ = first_run
    put_stage(spark, root, [(*K1, "C1")], D2)
    put_checks(spark, root, [(1, K1)], D2)
    before = ledger(spark, root).count()

    def boom(*a, **k):
        raise RuntimeError("disk full")
    monkeypatch.setattr(sinks, "overwrite_partitions", boom)
    with pytest.raises(RuntimeError):
        jobs.integrate_job(spark, root, D2)
    monkeypatch.undo()
    assert ledger(spark, root).count() == before
    errs = spark.read.parquet(os.path.join(root, "error_log")).collect()
    assert len(errs) == 1 and "disk full" in errs[0].err_msg and errs[0].text == "step: write ledger"


def test_restamp_only_new_rows(spark, first_run):
    root, _ = first_run
    next_run(spark, root, run_ts=dt.datetime(2025, 8, 12, 9))
    stamps = {r.address: r.update_time for r in ledger(spark, root).collect()}
    assert stamps["A1"] == dt.datetime(2025, 8, 2)
    assert stamps["C1"] == dt.datetime(2025, 8, 12, 9)


def test_dedupe_drops_rows_already_in_ledger(spark, first_run):
    root, _ = first_run
    put_stage(spark, root, [(*K1, "A1"), (*K1, "C9")], D2)
    put_checks(spark, root, [(1, K1)], D2)
    jobs.integrate_job(spark, root, D2, dedupe=True)
    assert sorted(r.address for r in ledger(spark, root).collect()) == ["A1", "A2", "B1", "C9"]


def test_restamp_all(spark, first_run):
    root, _ = first_run
    next_run(spark, root, run_ts=dt.datetime(2025, 8, 12, 9), restamp_all=True)
    stamps = {r.update_time for r in ledger(spark, root).collect()}
    assert stamps == {dt.datetime(2025, 8, 12, 9)} and ledger(spark, root).count() == 5


def test_daily_run_writes_only_new_partitions(spark, first_run):
    root, _ = first_run
    before = {p for p, _, fs in os.walk(os.path.join(root, "ledger")) if any(f.endswith(".parquet") for f in fs)}
    next_run(spark, root)
    after = {p for p, _, fs in os.walk(os.path.join(root, "ledger")) if any(f.endswith(".parquet") for f in fs)}
    assert before < after and len(after - before) == 1
    assert "stage_date=2025-08-12" in next(iter(after - before))


def test_views_answer_sql(spark, first_run):
    from parcelflow.sources.tables import register_views
    root, _ = first_run
    register_views(spark, root, prefix="t_")
    got = spark.sql("SELECT city_name, district_name, count(*) AS n FROM t_ledger "
                    "GROUP BY 1, 2").collect()
    assert [(r.city_name, r.district_name, r.n) for r in got] == [(*K1, 3)]
    assert spark.sql("SELECT count(*) FROM t_migration").first()[0] == 0
    assert spark.sql("SELECT result_msg FROM t_run_log").first()[0] == "FIRST_TIME_RUN_20250802_DONE"


def test_cli_integrate(spark, root, capsys):
    from parcelflow.plans import cli
    put_full(spark, root, [(*K1, "A1")])
    put_checks(spark, root, [(1, K1)], None)
    assert cli.main(["integrate", "--root", root, "--run-date", "2025-08-02"]) == 0
    assert '"result_msg": "FIRST_TIME_RUN_20250802_DONE"' in capsys.readouterr().out
    assert ledger(spark, root).count() == 1


def test_dated_views(spark, first_run):
    from parcelflow.sources.tables import register_dated_views
    root, _ = first_run
    next_run(spark, root)
    names = register_dated_views(spark, root, prefix="v_")
    assert names == ["v_stage_20250802", "v_stage_20250812", "v_check_list_20250812"]
    assert spark.sql("SELECT count(*) FROM v_stage_20250812").first()[0] == 2


def test_rerun_after_district_emptied_removes_its_rows(spark, first_run):
    root, _ = first_run
    next_run(spark, root)                                   # K1 gets C1, C2 on D2
    sinks.clear_partitions(spark, os.path.join(root, "stage"), S.STAGE,
                           ["stage_date", *S.KEYS],
                           [{"stage_date": D2, "city_name": K1[0], "district_name": K1[1]}])
    jobs.integrate_job(spark, root, D2)                     # the day's re-crawl found nothing
    assert sorted(r.address for r in ledger(spark, root).collect()) == ["A1", "A2", "B1"]
    assert record(spark, root, D2) == [(3, 0, 3)]


def test_restamp_all_covers_keys_without_new_rows(spark, root):
    put_full(spark, root, [(*K1, "A1"), (*K2, "Z1")])
    put_checks(spark, root, [(1, K1), (2, K2)], None)
    jobs.integrate_job(spark, root, D1)
    put_stage(spark, root, [(*K1, "C1")], D2)                 # K2 gets no new rows
    put_checks(spark, root, [(1, K1), (2, K2)], D2)
    jobs.integrate_job(spark, root, D2, run_ts=dt.datetime(2025, 8, 12, 9), restamp_all=True)
    stamps = {r.address: r.update_time for r in ledger(spark, root).collect()}
    assert stamps == {"A1": dt.datetime(2025, 8, 12, 9), "Z1": dt.datetime(2025, 8, 12, 9),
                      "C1": dt.datetime(2025, 8, 12, 9)}


def test_register_tables_in_catalog(spark, first_run):
    from parcelflow.sources.tables import register_tables
    root, _ = first_run
    next_run(spark, root)
    names = register_tables(spark, root, database="pf_test_db")
    assert "pf_test_db.ledger" in names
    n = spark.sql("SELECT count(*) FROM pf_test_db.ledger WHERE stage_date = DATE '2025-08-12'").first()[0]
    assert n == 2
    parts = spark.sql("SHOW PARTITIONS pf_test_db.ledger").count()
    assert parts == 3   # (K1, NULL date), (K1, D1), (K1, D2)
    spark.sql("DROP DATABASE pf_test_db CASCADE")
