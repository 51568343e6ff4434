"""Versioned replaces: new rows go to a new folder, then one step switches to it.

Tables replaced whole live in numbered folders, ``<path>/version=<n>-<tag>``.
A version counts once Spark's commit has put ``_SUCCESS`` into it, and the
highest one that counts is the table: a reader sees the old rows or the new
ones, never none or a part, and a failed write leaves a folder that no one
reads.

Where the table is in the catalog (``use_catalog``), writes end with a catalog
call instead: ``ALTER TABLE ... SET LOCATION`` for a whole table or for each
replaced partition, one ``ADD PARTITION`` for all new ones, one ``DROP
PARTITION`` for all emptied ones.  Partition versions are kept beside the
table, in ``<path>__versions``.

Old versions stay readable for those who still read them until ``expire``.
"""

from __future__ import annotations

import datetime as dt
import os
import re
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Session setting: the database whose tables the jobs read and write.
DATABASE = "parcelflow.database"
_NAME = re.compile(r"version=(\d+)-\w+$")


class Version(NamedTuple):
    number: int
    path: str
    written: dt.datetime
    complete: bool
    current: bool


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _child(spark: SparkSession, parent: str, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(f"{parent}/{name}")


# --- whole tables ------------------------------------------------------------

def versions(spark: SparkSession, path: str) -> list[Version]:
    """The versions at ``path``, oldest first; a short list (see ``expire``)."""
    fs, _ = _fs(spark, path)
    found = []
    for status in fs.globStatus(_child(spark, path, "version=*")) or []:
        name = status.getPath().getName()
        if at := _NAME.match(name):
            done = fs.exists(_child(spark, f"{path}/{name}", "_SUCCESS"))
            when = dt.datetime.fromtimestamp(status.getModificationTime() / 1000)
            found.append((int(at[1]), name, when, done))
    found.sort()
    last = max((i for i, v in enumerate(found) if v[3]), default=-1)
    return [Version(n, f"{path}/{name}", when, done, i == last) for i, (n, name, when, done) in enumerate(found)]


def current(spark: SparkSession, path: str) -> str:
    """The folder to read: the current version, or ``path`` where there is none."""
    return next((v.path for v in versions(spark, path) if v.current), path)


def write_version(spark: SparkSession, df: DataFrame, path: str) -> str:
    """Write ``df`` as the next version of the table at ``path``."""
    known = versions(spark, path)
    new = f"{path}/version={(known[-1].number if known else 0) + 1:08d}-{uuid.uuid4().hex}"
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(new)
    return new


def expire(spark: SparkSession, path: str, older_than: dt.datetime, keep: int = 2) -> list[str]:
    """Delete versions written before ``older_than``, except the last ``keep``
    whole ones; with them partition versions that no partition points to, and
    remains of failed writes.  Returns the deleted folders."""
    known = versions(spark, path)
    kept = {v.path for v in [v for v in known if v.complete][-max(1, keep):]}
    gone = [v.path for v in known if v.path not in kept and v.written < older_than]
    beside = f"{path}__versions"
    fs, at = _fs(spark, beside)
    if fs.exists(at) and (table := catalog_table(spark, path)):
        files = spark.table(table).select(F.col("_metadata.file_path").alias("f"))
        used = {r.tag for r in files.select(F.regexp_extract("f", "__versions/([^/]+)/", 1).alias("tag")).distinct().collect()}
        for status in fs.listStatus(at):
            when = dt.datetime.fromtimestamp(status.getModificationTime() / 1000)
            if status.getPath().getName() not in used and when < older_than:
                gone.append(f"{beside}/{status.getPath().getName()}")
    for folder in gone:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(folder), True)
    return gone


# --- catalog tables ----------------------------------------------------------

def catalog_table(spark: SparkSession, path: str) -> str | None:
    """The catalog table of the table at ``path``, if the session works on one."""
    database = spark.conf.get(DATABASE, None)
    table = f"{database}.{os.path.basename(path)}"
    if not database or not spark.catalog.tableExists(table):
        return None
    own = spark.sql(f"SHOW TBLPROPERTIES {table} ('parcelflow.path')").first()
    return table if own and own["value"] == path else None


def create_table(spark: SparkSession, table: str, path: str, schema: T.StructType, partition_cols: list[str]) -> None:
    """An external Parquet table over ``path`` (its current version), with the
    partitions that are on disk already."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet{parts} "
              f"LOCATION {literal(current(spark, path))} TBLPROPERTIES ('parcelflow.path' = {literal(path)})")
    fs, at = _fs(spark, path)
    if partition_cols and fs.exists(at):
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")


def switch(spark: SparkSession, path: str, new: str) -> None:
    """Point the catalog's table, if there is one, to the new version."""
    if table := catalog_table(spark, path):
        spark.sql(f"ALTER TABLE {table} SET LOCATION {literal(new)}")
        spark.catalog.refreshTable(table)


def replace_partitions(spark: SparkSession, table: str, df: DataFrame, path: str, partition_cols: list[str]) -> None:
    """Write the partitions of ``df`` to a new folder and point the table's
    partitions to it.  A reader sees each partition before or after its switch."""
    folder = f"{path}__versions/{dt.datetime.now():%Y%m%d%H%M%S}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_cols).parquet(folder)
    written = (spark.read.schema(df.schema).parquet(folder)
               .select(*partition_cols, F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("_folder")).distinct())
    # One row per written partition: control keys (districts, months), not data.
    rows = [(spec(r.asDict(), partition_cols), r["_folder"]) for r in written.collect()]
    if not rows:
        return
    added = " ".join(f"PARTITION ({s}) LOCATION {literal(at)}" for s, at in rows)
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {added}")
    for s, at in rows:
        spark.sql(f"ALTER TABLE {table} PARTITION ({s}) SET LOCATION {literal(at)}")
    spark.catalog.refreshTable(table)


def drop_partitions(spark: SparkSession, table: str, partition_cols: list[str], keys: list[dict]) -> None:
    """Empty all the given partitions in one statement."""
    specs = ", ".join(f"PARTITION ({spec(k, partition_cols)})" for k in keys)
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    spark.catalog.refreshTable(table)


def spec(key: dict, partition_cols: list[str]) -> str:
    return ", ".join(f"`{c}` = {literal(key[c])}" for c in partition_cols)


def literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, (int, float)):
        return str(v)
    if hasattr(v, "isoformat"):
        return f"DATE '{v.isoformat()}'"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
