"""Check list of (city, district) work items: seed, pending, range, mark done."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.operators.joins import bounded_broadcast

STATUS_COLS = ("scraped_time", "total_row_count", "done_yn")


def seed_if_empty(check_list: DataFrame, seed: DataFrame) -> DataFrame:
    """The existing list when it has rows (a crawl resumes), else the seed.

    ``isEmpty`` runs a one-row probe on the driver and picks the plan; nothing
    but a boolean crosses to the driver."""
    return seed if check_list.isEmpty() else check_list


def number_options(options: DataFrame, order_cols: list[str], id_col: str = "record_id",
                   exclude: dict[str, list[str]] | None = None) -> DataFrame:
    """Drop header entries and number the remaining options 1..n in page order.
    Option lists are bounded (a dropdown), so one numbering window is fine."""
    df = options
    for col, values in (exclude or {}).items():
        df = df.where(~F.col(col).isin(values))
    w = Window.orderBy(*order_cols)
    return df.withColumn(id_col, F.row_number().over(w).cast("int"))


def _pending(check_list: DataFrame, status_cols) -> DataFrame:
    """Rows whose status columns (those present) are all NULL."""
    cond = F.lit(True)
    for c in status_cols:
        if c in check_list.columns:
            cond = cond & F.col(c).isNull()
    return check_list.where(cond)


def pending_keys(check_list: DataFrame, status_cols=STATUS_COLS) -> DataFrame:
    """Keys not yet loaded: all status columns NULL, in record-id order."""
    return _pending(check_list, status_cols).orderBy("record_id")


def pending_range(check_list: DataFrame, key_col: str = "district_name",
                  status_cols=STATUS_COLS, id_col: str = "record_id") -> DataFrame:
    """min / max record id of the pending keys and the key at each end, in
    one aggregation pass.  No pending key gives one row of NULLs."""
    return (_pending(check_list, status_cols)
            .agg(F.min(id_col).alias("min_record_id"), F.max(id_col).alias("max_record_id"),
                 F.min_by(key_col, id_col).alias("min_district"),
                 F.max_by(key_col, id_col).alias("max_district")))


def key_counts(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """Row count per key (partial aggregation before the shuffle, so a hot key
    costs one row per map task)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def mark_done(check_list: DataFrame, target: DataFrame, keys: list[str],
              done_keys: DataFrame | None = None, scraped_time=None,
              done_flag: str = "Y") -> DataFrame:
    """Set ``total_row_count`` (rows of the key in ``target``, 0 when absent),
    ``done_yn`` and ``scraped_time`` on the keys processed in this run
    (``done_keys``; all keys when None).  Keys with no data are marked too."""
    counts = key_counts(target, keys, "_cnt")
    cl = check_list.join(counts, keys, "left")
    if done_keys is not None:
        flag = done_keys.select(*keys).distinct().withColumn("_done", F.lit(True))
        cl = cl.join(bounded_broadcast(flag), keys, "left")
        hit = F.coalesce(F.col("_done"), F.lit(False))
    else:
        hit = F.lit(True)
    out = {
        "total_row_count": F.when(hit, F.coalesce(F.col("_cnt"), F.lit(0)).cast("long"))
                            .otherwise(F.col("total_row_count").cast("long")
                                       if "total_row_count" in check_list.columns else F.lit(None)),
        "done_yn": F.when(hit, F.lit(done_flag)).otherwise(
            F.col("done_yn") if "done_yn" in check_list.columns else F.lit(None)),
    }
    if scraped_time is not None:
        ts = F.lit(scraped_time).cast("timestamp_ntz")
        out["scraped_time"] = F.when(hit, ts).otherwise(
            F.col("scraped_time") if "scraped_time" in check_list.columns else F.lit(None))
    cl = cl.withColumns(out)
    cols = list(check_list.columns) + [c for c in out if c not in check_list.columns]
    return cl.select(*cols)


def mark_pending(check_list: DataFrame, failed: DataFrame, keys: list[str],
                 status_cols=STATUS_COLS) -> DataFrame:
    """Clear the status columns of the keys in ``failed``: their last crawl
    brought no whole result, so they are to be crawled again."""
    flag = bounded_broadcast(failed.select(*keys).distinct().withColumn("_failed", F.lit(True)))
    cl = check_list.join(flag, keys, "left")
    return cl.select(*[
        F.when(F.col("_failed").isNull(), F.col(c)).alias(c) if c in status_cols else F.col(c)
        for c in check_list.columns])
