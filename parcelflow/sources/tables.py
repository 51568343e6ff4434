"""The ledger tables as Spark SQL views, so the queries people ran against
the database tables (ledger, stages, check lists, records, logs, statistics)
run unchanged in ``spark.sql``."""

from __future__ import annotations

from pyspark.sql import SparkSession

from parcelflow import schemas as S
from parcelflow.plans import sinks, versions

TABLES = {
    "full_stage": S.STAGE,
    "stage": S.STAGE,
    "full_check_list": S.CHECK_LIST,
    "check_list": S.CHECK_LIST,
    "ledger": S.LEDGER,
    "ledger_record": S.LEDGER_RECORD,
    "run_log": S.RUN_LOG,
    "error_log": S.ERROR_LOG,
    "migration": S.MIGRATION,
    "calendar": S.CALENDAR,
    "migration_gaps": S.MIGRATION_GAPS,
    "consumer_loans": S.CONSUMER_LOANS,
    "construction_loans": S.CONSTRUCTION_LOANS,
    "rejects": S.REJECTS,
    "crawl_plan": S.CRAWL_PLAN,
    "crawl_gaps": S.CRAWL_GAPS,
    "load_record": S.LOAD_RECORD,
    "feed_rows": S.FEED_ROWS,
    "feed_keys": S.KEY_FILTER,
}


def register_views(spark: SparkSession, root: str, prefix: str = "") -> list[str]:
    """Create (or replace) a temporary view per table under ``root``; a table
    not written yet is an empty view with its declared schema.  Views are
    lazy: filters on partition columns still prune partitions."""
    names = []
    for name, schema in TABLES.items():
        view = prefix + name
        sinks.read_or_empty(spark, sinks.table_path(root, name), schema).createOrReplaceTempView(view)
        names.append(view)
    return names


def register_dated_views(spark: SparkSession, root: str, prefix: str = "") -> list[str]:
    """One view per crawl date, named as the dated tables were
    (``stage_yyyyMMdd``, ``check_list_yyyyMMdd``): each is the one partitioned
    table filtered on its ``stage_date``, so a query on it reads one partition.
    The dates come from the partition column alone (a short list)."""
    from pyspark.sql import functions as F

    names = []
    for name in ("stage", "check_list"):
        df = sinks.read_or_empty(spark, sinks.table_path(root, name), TABLES[name])
        dates = [r.stage_date for r in df.select("stage_date").distinct().collect()
                 if r.stage_date is not None]
        for d in sorted(dates):
            view = f"{prefix}{name}_{d:%Y%m%d}"
            df.where(F.col("stage_date") == F.lit(d)).createOrReplaceTempView(view)
            names.append(view)
    return names


PARTITIONS = {
    "full_stage": S.KEYS, "stage": ["stage_date", *S.KEYS], "check_list": ["stage_date"],
    "ledger": [*S.KEYS, "stage_date"], "ledger_record": ["exec_date"],
    "migration": ["roc_year", "roc_month"], "rejects": ["stage_date"],
    "crawl_plan": ["stage_date"], "crawl_gaps": ["stage_date"], "load_record": ["stage_date"],
    "feed_rows": ["stage_date", "feed", "feed_batch"], "feed_keys": ["stage_date", "feed", "feed_batch"],
}


def register_tables(spark: SparkSession, root: str, database: str = "parcelflow") -> list[str]:
    """Register every written table in the catalog (a metastore on a
    cluster) as an external Parquet table over its folder, with its partition
    columns, and recover the partitions already on disk.  Queries on the
    catalog tables then prune partitions through the catalog instead of
    listing every folder."""
    return _register(spark, root, database, lambda path: sinks.exists(spark, path))


def use_catalog(spark: SparkSession, root: str, database: str = "parcelflow") -> list[str]:
    """Register all tables, written or not, and let the jobs of this session
    read and write ``root`` through them: counts in the catalog and on disk then
    always agree, and replaces are switches of locations."""
    names = _register(spark, root, database, lambda path: True)
    spark.conf.set(versions.DATABASE, database)
    return names


def _register(spark: SparkSession, root: str, database: str, wanted) -> list[str]:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for name, schema in TABLES.items():
        path = sinks.table_path(root, name)
        if wanted(path):
            versions.create_table(spark, f"{database}.{name}", path, schema, PARTITIONS.get(name, []))
            names.append(f"{database}.{name}")
    return names
