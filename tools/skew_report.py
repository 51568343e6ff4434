"""Skew evidence from Spark's event log.

Builds listing-shaped rows from the test tables in which one district holds a
third of all rows, numbers them per district twice -- with a plain per-key
window and with ``renumber`` -- writes them partitioned by district twice --
after a plain repartition by key and through the rebalancing sink -- and
reads the event log (written to a fresh
scratch folder) for the largest task's share of the shuffle records each
stage reads.  Usage: python tools/skew_report.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from parcelflow.operators.plan import renumber  # noqa: E402
from parcelflow.plans import sinks  # noqa: E402
from parcelflow.session import build_session  # noqa: E402
from parcelflow.sources.testdata import tx  # noqa: E402


def stage_task_shares(log_dir: str) -> dict:
    """job group -> list of (stage id, tasks, shuffle records read, largest task's share)."""
    files = sorted(p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
                   if os.path.isfile(p))
    per_stage: dict[int, list[int]] = {}
    group_of_stage: dict[int, str] = {}
    lines = (line for f in files for line in open(f))
    for line in lines:
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "")
            for sid in ev.get("Stage IDs", []):
                group_of_stage[sid] = group
        elif kind == "SparkListenerTaskEnd":
            m = ev.get("Task Metrics") or {}
            rec = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            per_stage.setdefault(ev["Stage ID"], []).append(rec)
    out: dict[str, list] = {}
    for sid, recs in sorted(per_stage.items()):
        total = sum(recs)
        if total:
            out.setdefault(group_of_stage.get(sid, ""), []).append(
                (sid, len(recs), total, round(max(recs) / total, 3)))
    return out


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="pf-eventlog-")
    spark = build_session("local[8]", shuffle_partitions=16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        # Scaled down with the data: the hot district (a few MB here) must be
        # far above the target partition size, as it would be at scale.
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k"})
    rows = tx(spark, sf).select("city", "district", "o_orderkey", "tx_date")
    hot = F.col("o_orderkey") % 3 == 0           # a third of all rows in one district
    skewed = rows.select(F.when(hot, "HOT").otherwise(F.col("city")).alias("city"),
                         F.when(hot, "HOT").otherwise(F.col("district")).alias("district"),
                         "o_orderkey", "tx_date")
    # A large scan has many map tasks; AQE splits a skewed partition by
    # grouping map outputs, so give the small test input several as well.
    skewed = skewed.repartition(16).persist()
    skewed.count()
    sc = spark.sparkContext
    sc.setJobGroup("window", "per-key window")
    w = Window.partitionBy("city", "district").orderBy("tx_date", "o_orderkey")
    skewed.withColumn("n", F.row_number().over(w)).write.format("noop").mode("overwrite").save()
    sc.setJobGroup("renumber", "range-partitioned renumber")
    renumber(skewed, ["city", "district"], ["tx_date", "o_orderkey"], "n", num_partitions=16) \
        .write.format("noop").mode("overwrite").save()
    out_dir = tempfile.mkdtemp(prefix="pf-skew-write-")
    sc.setJobGroup("write_repartition", "partitioned write after repartition by key")
    skewed.repartition("city", "district").write.mode("overwrite").partitionBy(
        "city", "district").parquet(os.path.join(out_dir, "a"))
    sc.setJobGroup("write_rebalance", "partitioned write through sinks.overwrite_partitions")
    sinks.overwrite_partitions(skewed, os.path.join(out_dir, "b"), ["city", "district"])
    spark.stop()
    shares = stage_task_shares(log_dir)
    print(json.dumps({g: [{"stage": s, "tasks": t, "records": n, "max_task_share": x}
                          for s, t, n, x in v] for g, v in shares.items()}))


if __name__ == "__main__":
    main()
