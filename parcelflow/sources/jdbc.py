"""Existing database tables into the ledger layout.

The stage, check-list, ledger and statistics tables of a running database
are read with Spark's JDBC source -- in parallel, split on a numeric column --
and mapped to the declared schemas (lower-case names, typed timestamps, the
``stage_date`` that dated table names carried).  Needs the database's JDBC
driver on the classpath; nothing here opens a connection until a read runs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow import schemas as S
from parcelflow.operators.integrate import with_fingerprint


def hash_predicates(columns: list[str], buckets: int) -> list[str]:
    """One predicate per bucket; a row satisfies exactly one, NULLs included."""
    text = ", ".join(f"COALESCE({c.strip()}, '')" for c in columns)
    return [f"MOD(CRC32(CONCAT_WS('|', {text})), {buckets}) = {i}" for i in range(buckets)]


def read_table(spark: SparkSession, url: str, table: str, user: str, password: str,
               split_column: str | None = None, bounds: tuple[int, int] | None = None,
               num_partitions: int = 64, fetch_size: int = 10_000,
               driver: str | None = None, hash_column: str | None = None) -> DataFrame:
    """A table through JDBC.  With ``split_column`` (numeric) the read runs as
    ``num_partitions`` range queries in parallel; ``bounds`` (min, max) are
    looked up with one aggregate query when not given.  A table without a
    numeric column splits on ``hash_column`` (one or more columns, separated by
    commas) instead: one query per ``MOD(CRC32(...), n)`` bucket (MySQL's
    CRC32).  NULLs count as empty text, so every row is in one bucket.  Filters and column
    selections on the result are pushed into the queries."""
    opts = {"url": url, "dbtable": table, "user": user, "password": password,
            "fetchsize": str(fetch_size)}
    if driver:
        opts["driver"] = driver
    if hash_column and not split_column:
        props = {k: v for k, v in opts.items() if k not in ("url", "dbtable")}
        preds = hash_predicates(hash_column.split(","), num_partitions)
        return spark.read.jdbc(url, table, predicates=preds, properties=props)
    if split_column:
        if bounds is None:
            probe = (spark.read.format("jdbc")
                     .options(**{**opts, "dbtable": f"(SELECT MIN({split_column}) AS lo, "
                                                   f"MAX({split_column}) AS hi FROM {table}) b"})
                     .load().first())
            bounds = (int(probe["lo"] or 0), int(probe["hi"] or 0))
        opts.update(partitionColumn=split_column, lowerBound=str(bounds[0]),
                    upperBound=str(bounds[1] + 1), numPartitions=str(num_partitions))
    return spark.read.format("jdbc").options(**opts).load()


def _conform(df: DataFrame, schema: T.StructType, extra: dict | None = None) -> DataFrame:
    """Lower-case the columns and cast them to ``schema``; columns the source
    lacks become NULL, ``extra`` supplies computed ones."""
    lower = {c.lower(): c for c in df.columns}
    cols = []
    for f in schema.fields:
        if extra and f.name in extra:
            cols.append(extra[f.name].cast(f.dataType).alias(f.name))
        elif f.name in lower:
            cols.append(F.col(f"`{lower[f.name]}`").cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def stage_rows(db_stage: DataFrame, stage_date: dt.date | None) -> DataFrame:
    """A full or dated stage table (23 upper-case columns) -> the stage layout;
    the date that the dated table's name carried becomes ``stage_date``."""
    return _conform(db_stage, S.STAGE, {"stage_date": F.lit(stage_date).cast("date")})


def check_list_rows(db_check_list: DataFrame, stage_date: dt.date | None) -> DataFrame:
    return _conform(db_check_list, S.CHECK_LIST, {"stage_date": F.lit(stage_date).cast("date")})


def ledger_rows(db_data: DataFrame) -> DataFrame:
    """The integrated data table -> the ledger layout.  Its rows carry no stage
    date (the database kept none), so they land in the NULL-date partition."""
    rows = _conform(db_data, S.LEDGER, {"stage_date": F.lit(None).cast("date")})
    return with_fingerprint(rows).select(*S.LEDGER.names)


def migration_rows(db_migration: DataFrame) -> DataFrame:
    extra = {"id": F.col("`" + next(c for c in db_migration.columns
                                    if c.lower().endswith("district_id")) + "`")}
    return _conform(db_migration, S.MIGRATION, extra)


def record_rows(db_record: DataFrame) -> DataFrame:
    """The integration records -> the record layout.  ``EXEC_DATE`` is text,
    ``yyyyMMdd`` or ``yyyy-MM-dd``.  They have no ``written_time``, so counts are
    not carried on from them."""
    text = F.col("`" + next(c for c in db_record.columns if c.lower() == "exec_date") + "`").cast("string")
    day = F.coalesce(F.try_to_date(text, "yyyyMMdd"), F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd"))
    return _conform(db_record, S.LEDGER_RECORD, {"exec_date": day})


def log_rows(db_log: DataFrame, schema: T.StructType) -> DataFrame:
    """The run log or the error log; ``SP_NAME`` becomes the job.  Their
    auto-increment ids are dropped."""
    name = next((c for c in db_log.columns if c.lower() == "sp_name"), None)
    return _conform(db_log, schema, {"job": F.col(f"`{name}`")} if name else None)


def loan_rows(db_loans: DataFrame, schema: T.StructType) -> DataFrame:
    return _conform(db_loans, schema)


def dated_table_date(name: str) -> dt.date | None:
    """The ``yyyyMMdd`` a dated table name carries (``…_20250812_STAGE``), if any."""
    for part in name.split("_"):
        if len(part) == 8 and part.isdigit():
            return dt.datetime.strptime(part, "%Y%m%d").date()
    return None
