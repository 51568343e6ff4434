"""Session-level helpers shared by the operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.session import ensure_checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the checkpoint folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Spark removes the shuffle files of a write when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a narrow intermediate table to the shared checkpoint folder and
    read it back: lineage ends there, a lost executor costs no rerun, and the
    shuffles behind it leave the disk at once, not when the driver collects
    garbage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


#: Ids broadcast at most; 16 bytes each in a hash table.
BROADCAST_IDS = 500_000


def only_ids(rows: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """The rows whose id is in ``ids`` (one long column, same name).  Up to
    ``BROADCAST_IDS`` ids are broadcast, so the rows aren't shuffled to be
    filtered; more take a shuffled semi-join."""
    ids = ids.distinct()
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return rows.join(ids, column, "left_semi")


def with_own_names(docs: DataFrame, names: Iterable[str], step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``step`` on the documents, while columns of theirs that are named like
    one of the step's own carry other names (as Spark compares them, without
    regard to case).  The step returns the columns it was given."""
    taken = {n.lower() for n in names}
    held = {c: f"{c}__{uuid.uuid4().hex}" for c in docs.columns if c.lower() in taken}
    out = step(docs.withColumnsRenamed(held))
    return out.withColumnsRenamed({v: k for k, v in held.items()}).select(*[f"`{c}`" for c in docs.columns])
