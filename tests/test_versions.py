"""Versioned replaces and writes through the catalog."""

import datetime as dt
import os
import threading
import uuid

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from parcelflow import schemas as S
from parcelflow.plans import jobs, sinks, versions
from parcelflow.sources.tables import use_catalog
from tests.test_coverage import GOOD, TS, checks, listing_pages, page
from tests.test_jobs import D1, D2, K1, K2, put_checks, put_full, put_stage, record

LATER = dt.datetime.now() + dt.timedelta(days=1)


def numbers(spark, n, tag):
    return spark.range(0, n, 1, 4).select("id", F.lit(tag).alias("tag"))


@pytest.fixture()
def database(spark):
    yield f"pf_{uuid.uuid4().hex[:8]}"
    spark.conf.unset(versions.DATABASE)


class Reader(threading.Thread):
    """Reads in a loop until stopped; keeps what it saw and what it raised."""

    def __init__(self, read):
        super().__init__()
        self.read, self.seen, self.errors, self.stop = read, set(), [], threading.Event()

    def run(self):
        while not self.stop.is_set():
            try:
                self.seen.add(self.read())
            except Exception as exc:  # noqa: BLE001
                self.errors.append(exc)
                return

    def __exit__(self, *_):
        self.stop.set()
        self.join()

    def __enter__(self):
        self.start()
        return self


def whole(df):
    """(rows, tags) of one read."""
    r = df.agg(F.count(F.lit(1)), F.collect_set("tag")).first()
    return r[0], tuple(sorted(r[1]))


def test_a_reader_never_sees_a_missing_or_half_table(spark, root):
    path = os.path.join(root, "t")
    schema = numbers(spark, 1, "a").schema
    sinks.full_replace(spark, numbers(spark, 1000, "a"), path)
    with Reader(lambda: whole(sinks.read_or_empty(spark, path, schema))) as reader:
        for i in range(6):
            out = sinks.full_replace(spark, numbers(spark, 1000 + i, f"v{i}"), path)
            assert out == {"deleted_rows": 999 + i if i else 1000, "inserted_rows": 1000 + i}
    assert not reader.errors
    assert reader.seen <= {(1000, ("a",))} | {(1000 + i, (f"v{i}",)) for i in range(6)}


def test_versions_are_listed_and_expire(spark, root):
    path = os.path.join(root, "t")
    schema = numbers(spark, 1, "a").schema
    for i in range(4):
        sinks.full_replace(spark, numbers(spark, i + 1, "a"), path)
    with pytest.raises(Exception):
        sinks.full_replace(spark, numbers(spark, 9, "x").select("id", F.raise_error(F.lit("no")).cast("string").alias("tag")), path)
    known = versions.versions(spark, path)
    assert [(v.number, v.complete, v.current) for v in known] == [
        (1, True, False), (2, True, False), (3, True, False), (4, True, True), (5, False, False)]
    assert sinks.read_or_empty(spark, path, schema).count() == 4
    assert versions.expire(spark, path, dt.datetime(2000, 1, 1)) == []
    assert versions.expire(spark, path, LATER, keep=2) == [v.path for v in known if v.number in (1, 2, 5)]
    assert [v.number for v in versions.versions(spark, path)] == [3, 4]
    assert versions.versions(spark, os.path.join(root, "none")) == []


def catalog_counts(spark, database, name):
    return spark.table(f"{database}.{name}").count()


def test_jobs_on_catalog_tables(spark, root, database):
    use_catalog(spark, root, database)
    put_full(spark, root, [(*K1, "A1"), (*K2, "Z1")])
    put_stage(spark, root, [(*K1, "B1")], D1)
    put_checks(spark, root, [(1, K1), (2, K2)], None)
    assert jobs.integrate_job(spark, root, D1).first_run
    put_checks(spark, root, [(1, K1), (2, K2)], D2)
    for n in (1, 2):  # a second load replaces the first
        jobs.load_listings(spark, root, listing_pages(spark, [(K1[1], page(*[GOOD] * n)), (K2[1], page(["short"]))]), D2, TS)
        jobs.integrate_job(spark, root, D2)
        assert catalog_counts(spark, database, "ledger") == 3 + n
    # What the catalog has is what is on disk under its locations.
    for name, schema in (("ledger", S.LEDGER), ("stage", S.STAGE), ("rejects", S.REJECTS)):
        files = spark.table(f"{database}.{name}").select("_metadata.file_path").distinct()
        on_disk = spark.read.schema(schema).parquet(*[r[0] for r in files.collect()]).count()
        assert catalog_counts(spark, database, name) == on_disk > 0
    ck = spark.table(f"{database}.check_list").where(F.col("stage_date") == F.lit(D2)).orderBy("record_id").collect()
    assert [(r.total_row_count, r.done_yn) for r in ck] == [(2, "Y"), (None, None)]
    assert spark.table(f"{database}.run_log").count() == 5
    gone = versions.expire(spark, os.path.join(root, "ledger"), LATER)
    assert gone and catalog_counts(spark, database, "ledger") == 5


def test_a_partition_is_replaced_at_once(spark, root, database):
    use_catalog(spark, root, database)
    put_stage(spark, root, [(*K1, f"a{i}") for i in range(50)] + [(*K2, "z")], D1)
    own = spark.table(f"{database}.stage").where(F.col("district_name") == K1[1])
    assert own.count() == 50

    def read():
        r = (spark.table(f"{database}.stage").where(F.col("district_name") == K1[1])
             .agg(F.count(F.lit(1)), F.collect_set(F.substring("address", 1, 1))).first())
        return r[0], tuple(sorted(r[1]))

    with Reader(read) as reader:
        for i in range(4):
            put_stage(spark, root, [(*K1, f"{'bcde'[i]}{k}") for k in range(60 + i)], D1)
    assert not reader.errors
    assert reader.seen <= {(50, ("a",))} | {(60 + i, ("bcde"[i],)) for i in range(4)}
    assert spark.table(f"{database}.stage").where(F.col("district_name") == K2[1]).count() == 1


def test_many_partitions_are_emptied_in_one_statement(spark, root, database, monkeypatch):
    use_catalog(spark, root, database)
    keys = [("C'1", f"d{i}") for i in range(365)]
    put_stage(spark, root, [(*k, "a") for k in keys] + [(*K1, "kept")], D1)
    said, sql = [], SparkSession.sql
    monkeypatch.setattr(SparkSession, "sql", lambda self, q, *a, **k: said.append(q) or sql(self, q, *a, **k))
    sinks.clear_partitions(spark, os.path.join(root, "stage"), S.STAGE, ["stage_date", *S.KEYS],
                           [{"stage_date": D1, "city_name": c, "district_name": d} for c, d in keys])
    assert sum("DROP" in q for q in said) == 1 and len(said) < 5
    assert [r.address for r in spark.table(f"{database}.stage").collect()] == ["kept"]


def test_paths_are_emptied_too(spark, root):
    put_stage(spark, root, [("C'1 %", f"d/{i}", "a") for i in range(20)] + [(*K1, "kept")], D1)
    put_stage(spark, root, [("C'1 %", "d/3", "other day")], D2)
    sinks.clear_partitions(spark, os.path.join(root, "stage"), S.STAGE, ["stage_date", *S.KEYS],
                           [{"stage_date": D1, "city_name": "C'1 %", "district_name": f"d/{i}"} for i in range(20)])
    left = spark.read.schema(S.STAGE).parquet(os.path.join(root, "stage")).collect()
    assert sorted(r.address for r in left) == ["kept", "other day"]


def test_null_dates_are_partitions_too(spark, root, database):
    use_catalog(spark, root, database)
    for reason in ("X", "Y"):
        bad = spark.createDataFrame([("s", "k", reason, "{}")], "source string, key string, reason string, row_json string")
        jobs.put_rejects(spark, root, bad, None, keep=lambda old: old.where("false"))
        assert [r.reason for r in spark.table(f"{database}.rejects").collect()] == [reason]
    none = bad.where("false")
    jobs.put_rejects(spark, root, none, None, keep=lambda old: old.where("false"))
    assert spark.table(f"{database}.rejects").count() == 0


def test_paths_without_a_catalog_are_as_before(spark, root):
    put_checks(spark, root, [(1, K1)], D2)
    jobs.load_listings(spark, root, listing_pages(spark, [(K1[1], page(GOOD))]), D2, TS)
    assert checks(spark, root) == {K1[1]: (1, "Y", 10)}
    assert versions.catalog_table(spark, os.path.join(root, "stage")) is None
    assert record
