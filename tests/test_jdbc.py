"""Mapping of database-layout tables (no database here: rows stand in for a
JDBC read)."""

import datetime as dt

from parcelflow import schemas as S
from parcelflow.sources.jdbc import dated_table_date, ledger_rows, migration_rows, stage_rows


def shape(schema):
    return [(f.name, f.dataType) for f in schema.fields]


def test_stage_rows_from_database_layout(spark):
    cols = ["CITY_DISTRICT_ID", "BATCH_ID", "PAGE", "CITY_NAME", "DISTRICT_NAME"] + [
        c.upper() for c in S.BUSINESS] + ["SCRAPED_TIME"]
    row = [1, 2, 3, "臺北市", "大安區"] + ["x"] * len(S.BUSINESS) + ["2025-08-12 10:00:00.1234"]
    db = spark.createDataFrame([row], ", ".join(f"{c} string" for c in cols))
    out = stage_rows(db, dt.date(2025, 8, 12))
    assert shape(out.schema) == shape(S.STAGE)
    r = out.first()
    assert (r.city_district_id, r.page, r.stage_date) == (1, 3, dt.date(2025, 8, 12))
    assert r.scraped_time == dt.datetime(2025, 8, 12, 10, 0, 0, 123400)


def test_ledger_and_migration_rows(spark):
    db = spark.createDataFrame([("臺北市", "大安區", "A1", "2025-08-14 00:00:00", "job")],
                               "CITY_NAME string, DISTRICT_NAME string, ADDRESS string, "
                               "UPDATE_TIME string, UPDATE_BY string")
    led = ledger_rows(db)
    assert shape(led.schema) == shape(S.LEDGER) and led.first().community is None
    mig = spark.createDataFrame([(7, "113", "1", "臺北市", "1", "2")],
                                "EACH_YEAR_MONTH_CITY_DISTRICT_ID int, ROC_YEAR string, ROC_MONTH string, "
                                "CITY_DISTRICT_NAME string, M_MOVE_IN string, F_MOVE_IN string")
    m = migration_rows(mig).first()
    assert (m.id, m.roc_year, m.m_move_in, m.m_move_out) == (7, "113", "1", None)


def test_dated_table_date():
    assert dated_table_date("X_20250812_STAGE") == dt.date(2025, 8, 12)
    assert dated_table_date("X_FULL_STAGE") is None


def test_import_database_with_stand_in_reader(spark, root):
    import os
    from parcelflow.plans import jobs
    cols = ["CITY_DISTRICT_ID", "BATCH_ID", "PAGE", "CITY_NAME", "DISTRICT_NAME", "ADDRESS"]
    stage = spark.createDataFrame([(1, 1, 1, "臺北市", "大安區", "A1"), (2, 1, 1, "臺北市", "大安區", "A2")],
                                  ", ".join(f"{c} {'int' if c.endswith(('ID', 'PAGE')) else 'string'}"
                                            for c in cols))
    checks = spark.createDataFrame([(1, "臺北市", "大安區", "Y")],
                                   "RECORD_ID int, CITY_NAME string, DISTRICT_NAME string, DONE_YN string")
    data = spark.createDataFrame([("臺北市", "大安區", "A0")], "CITY_NAME string, DISTRICT_NAME string, ADDRESS string")
    tables = {"S_FULL_STAGE": stage, "S_20250812_STAGE": stage, "S_FULL_CHECK_LIST": checks, "S_DATA": data}
    out = jobs.import_database(spark, root, tables.__getitem__, full_stage="S_FULL_STAGE",
                               dated_stages=["S_20250812_STAGE"], full_check_list="S_FULL_CHECK_LIST",
                               ledger="S_DATA")
    assert out == {"full_stage": 2, "stage": 2, "full_check_list": 1, "ledger": 1}
    st = spark.read.parquet(os.path.join(root, "stage")).first()
    assert str(st.stage_date) == "2025-08-12"
    # The imported ledger is a loaded ledger: the next integration is a daily run.
    assert not spark.read.parquet(os.path.join(root, "ledger")).isEmpty()


def test_import_of_records_logs_and_loans(spark, root):
    import os
    from parcelflow.plans import jobs, sinks
    record = spark.createDataFrame([("20250802", "F", "臺北市", "大安區", 2, 1, 3, "Y", "2025-08-02 01:00:00"),
                                    ("2025-08-12", "D", "臺北市", "大安區", 3, 1, 4, "Y", "2025-08-12 01:00:00")],
                                   "EXEC_DATE string, MAIN_TABLE string, MAIN_TABLE_CITY_NAME string, MAIN_TABLE_DISTRICT_NAME "
                                   "string, MAIN_TABLE_ROW_COUNT int, SUB_TABLE_ROW_COUNT int, TOTAL_ROW_COUNT int, DONE_YN "
                                   "string, UPDATE_TIME string")
    log = spark.createDataFrame([(7, "nightly", "2025-08-02 01:00:00", "Y")], "ID int, SP_NAME string, DATA_DT string, DONE_YN string")
    loans = spark.createDataFrame([(114, 7, "12")], "ROC_YEAR int, ROC_MONTH int, CONSTRUCTION_LOAN string")
    tables = {"R": record, "L": log, "E": log, "C": loans}
    for _ in range(2):  # imported again: in place of what is there
        out = jobs.import_database(spark, root, tables.__getitem__, record="R", run_log="L", error_log="E",
                                   construction_loans="C")
        assert out == {"ledger_record": 2, "run_log": 1, "error_log": 1, "construction_loans": 1}

    def read(name, schema):
        return sinks.read_or_empty(spark, os.path.join(root, name), schema).collect()
    assert {(str(r.exec_date), r.total_row_count) for r in read("ledger_record", S.LEDGER_RECORD)} == {
        ("2025-08-02", 3), ("2025-08-12", 4)}
    assert [r.construction_loan for r in read("construction_loans", S.CONSTRUCTION_LOANS)] == ["12"]
    assert "nightly" in [r.job for r in read("run_log", S.RUN_LOG)]
    from parcelflow.operators.integrate import carried_counts
    records = sinks.read_or_empty(spark, os.path.join(root, "ledger_record"), S.LEDGER_RECORD)
    assert carried_counts(records, dt.date(2025, 9, 1), S.KEYS).count() == 0
