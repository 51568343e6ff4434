"""Every registered query against its DuckDB oracle at sf0.001 (the driver
runs the same comparison at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as entry
from parcelflow.plans.queries import QUERIES
from parcelflow.sources.testdata import TABLES
from tools.oracle_check import digest

SF = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP",
         "date": "DATE", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(entry.oracle_sql()[name])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    spark_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    assert spark_types == dict(zip(rel.columns, map(str, rel.types)))
    assert len(rows) == len(drows)
    assert digest(df.columns, rows) == digest(rel.columns, drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["city", "district", "main_table_row_count", "sub_table_row_count",
                          "total_row_count", "done_yn"]
    assert df.count() == 25


@pytest.mark.parametrize("name", ["renumber", "result_total", "roc_split", "cells_to_columns",
                                  "page_batches", "sheet_slice"])
def test_query_matches_oracle_without_ansi_and_many_partitions(spark, duck, name):
    old = {k: spark.conf.get(k) for k in ("spark.sql.ansi.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.ansi.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        df = entry.queries()[name](spark, SF)
        rows = [tuple(r) for r in df.collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    rel = duck.sql(entry.oracle_sql()[name])
    assert digest(df.columns, rows) == digest(rel.columns, rel.fetchall())
