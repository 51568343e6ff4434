"""Writes: partition overwrites, appends, full replaces; and the reads of the
same tables.

Parquet tables at paths, partitioned by their keys.  With
``partitionOverwriteMode=dynamic`` an overwrite replaces exactly the
partitions present in the written frame -- the "delete this district, insert
its rows" of the reference as one commit.  Tables replaced whole are versioned
(``plans.versions``).  In a session that works on catalog tables
(``sources.tables.use_catalog``) every read and write goes through the catalog,
and a replaced partition is switched by its location.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow.plans import versions


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table has been written at ``path`` (Spark's own listing)."""
    try:
        spark.read.parquet(versions.current(spark, path)).schema  # resolves the file listing only
        return True
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path`` (with the declared schema), or an empty frame.
    With the schema given, resolving the path lists files but reads no footer."""
    if table := versions.catalog_table(spark, path):
        return spark.table(table).select(*schema.names)
    try:
        return spark.read.schema(schema).parquet(versions.current(spark, path))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def overwrite_partitions(df: DataFrame, path: str, partition_cols: list[str],
                         columns: list[str] | None = None) -> None:
    """Dynamic partition overwrite.  ``rebalance`` asks AQE to spread rows by
    the partition keys and to split a skewed key over several tasks (and files)
    instead of writing it from one task."""
    if columns:
        df = df.select(*columns)
    if table := versions.catalog_table(spark := df.sparkSession, path):
        versions.replace_partitions(spark, table, df.hint("rebalance", *partition_cols), path, partition_cols)
        return
    (df.hint("rebalance", *partition_cols)
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_cols).parquet(path))


def append(df: DataFrame, path: str, partition_cols: list[str] | None = None) -> None:
    if table := versions.catalog_table(spark := df.sparkSession, path):
        df.select(*spark.table(table).columns).write.mode("append").insertInto(table)
        return
    w = df.write.mode("append")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)


def replace_table(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Replace an unpartitioned table by a new version.  A failed write leaves
    the table as it was; readers see the old rows until all new ones are there."""
    versions.switch(spark, path, versions.write_version(spark, df, path))


def full_replace(spark: SparkSession, df: DataFrame, path: str) -> dict[str, int]:
    """Replace the whole table at ``path``; returns deleted and inserted row
    counts.  The inserted count is observed during the write itself (no second
    pass); the deleted count is the old table's row count."""
    deleted = spark.read.parquet(versions.current(spark, path)).count() if exists(spark, path) else 0
    obs = Observation("full_replace")
    replace_table(spark, df.observe(obs, F.count(F.lit(1)).alias("rows")), path)
    return {"deleted_rows": deleted, "inserted_rows": int(obs.get["rows"])}


def table_path(root: str, name: str) -> str:
    return os.path.join(root, name)


def clear_partitions(spark: SparkSession, path: str, schema: T.StructType,
                     partition_cols: list[str], keys: list[dict]) -> None:
    """Empty the given partitions (districts confirmed to have no rows).
    ``keys`` is a short control list (districts whose result page said 0), not
    data.  In the catalog that is one statement; at a plain path one Spark job
    finds the folders of all the partitions, which are then deleted."""
    if not keys:
        return
    if table := versions.catalog_table(spark, path):
        versions.drop_partitions(spark, table, partition_cols, keys)
        return
    types = {f.name: f.dataType for f in schema.fields}
    hit = F.lit(False)
    for key in keys:
        same = F.lit(True)
        for c in partition_cols:
            same = same & F.col(c).eqNullSafe(F.lit(key[c]).cast(types[c]))
        hit = hit | same
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder")
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    for r in read_or_empty(spark, path, schema).where(hit).select(folder).distinct().collect():
        # the file path is a URI: read it as one, so that escapes are resolved
        at = jvm_path(spark._jvm.java.net.URI(r.folder))
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    spark.catalog.refreshByPath(path)
