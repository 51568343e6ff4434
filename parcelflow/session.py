"""Session construction and cluster-shared settings."""

from __future__ import annotations

import os
import tempfile
import threading

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins from runtime sizes, splits
# skewed sort-merge-join partitions and coalesces tiny shuffle partitions;
# dynamic partition overwrite makes "replace these districts" a plain write.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Pages reach the HTML UDF in Arrow batches; 1,000 pages of up to ~150 KB
    # keep a Python worker's batch in the low hundreds of MB.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # Checkpoint files of data no longer referenced are deleted (the stream
    # checkpoints each micro-batch; a long-running feed must not pile them up).
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "parcelflow",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # getOrCreate may hand back a running session: apply the SQL settings anyway.
    # Static settings only take effect when the session is made.
    for k, v in conf.items():
        if k.startswith("spark.sql.") and spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``; only when it is unset (local tests) make one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="parcelflow-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return configured


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``parcelflow`` importable by local Python workers (the UDFs
    reference it): zip the package once per SparkContext and ``addPyFile`` it.
    On a cluster the package is deployed with the job (``--py-files`` or an
    installed wheel), so nothing is written here."""
    sc = spark.sparkContext
    if getattr(sc, "_parcelflow_shipped", False) or not sc.master.startswith("local"):
        return
    with _SHIP_LOCK:  # queries may be built from several threads
        if getattr(sc, "_parcelflow_shipped", False):
            return
        _ship(sc)


def _ship(sc) -> None:
    import io
    import zipfile

    root = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(root)))
    out_dir = tempfile.mkdtemp(prefix="parcelflow-pyfiles-")
    path = os.path.join(out_dir, "parcelflow.zip")
    with open(path, "wb") as fh:
        fh.write(buf.getvalue())
    sc.addPyFile(path)
    sc._parcelflow_shipped = True


def scale_conf(input_bytes: int, total_cores: int,
               partition_bytes: int = 512 * 1024 ** 2) -> dict[str, str]:
    """Settings sized for a cluster run over ``input_bytes`` of input.

    * Shuffle partitions: one per ``partition_bytes`` of input, at least two
      waves of tasks, at most 50,000 (beyond that the shuffle's block count,
      maps x reducers, becomes the bottleneck).  AQE coalesces them back when
      projections and partial aggregation shrink the data.
    * Scan splits of the same size keep a task's input within executor memory.
    * A partition over 1 GiB (and 5x the median) counts as skewed and AQE
      splits it in joins and rebalancing writes.
    * The broadcast threshold stays small and fixed: a broadcast side is
      copied to every executor, so its bound must not grow with the data.
    """
    want = -(-input_bytes // partition_bytes)
    parts = max(2 * total_cores, min(want, 50_000))
    mb = f"{partition_bytes // 1024 ** 2}m"
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": mb,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": mb,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.parquet.filterPushdown": "true",
    }
