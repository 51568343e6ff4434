"""Crawl planning: period filter, page batches, calendar, renumbering."""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.functions.text import ROC_OFFSET
from parcelflow.operators.joins import DEFAULT_BROADCAST_ROWS, bounded_broadcast

# --- fixed values ------------------------------------------------------------
# Page-batch size tiers: (minimum page count, batch size), checked in order.
BATCH_TIERS = ((2000, 500), (1000, 300))
BATCH_DEFAULT = 100
WHOLE_YEAR = "全年"       # the "whole year" entry of the month dropdown
# -----------------------------------------------------------------------------


def _month_start(ym: int) -> dt.datetime:
    return dt.datetime(ym // 100, ym % 100, 1)


def _next_month_start(ym: int) -> dt.datetime:
    y, m = divmod(ym, 100)
    return dt.datetime(y + (m == 12), 1 if m == 12 else m + 1, 1)


def _bound(df: DataFrame, col: str, value: dt.datetime) -> Column:
    kind = df.schema[col].dataType.typeName()
    text = value.strftime("%Y-%m-%d %H:%M:%S")
    if kind == "date":
        return F.lit(value.date())
    if kind == "timestamp_ntz":
        return F.lit(text).cast("timestamp_ntz")
    return F.lit(text).cast("timestamp")


def crawl_period(run_date: dt.date, previous_years: int, monthly: bool) -> tuple[int, int]:
    """(lo, hi) as yyyymm.  The period starts ``previous_years`` before the
    run year -- in January for the full crawl, in the run month for the
    monthly crawl (so with 0 years it covers the run month only) -- and ends
    at the run month."""
    hi = run_date.year * 100 + run_date.month
    lo = (run_date.year - previous_years) * 100 + (run_date.month if monthly else 1)
    return lo, hi


def period_filter(df: DataFrame, date_col: str, lo_ym: int, hi_ym: int,
                  kind_col: str | None = None, kinds=None) -> DataFrame:
    """Rows whose month lies in [lo_ym, hi_ym] (yyyymm) and whose kind is one
    of ``kinds``.  The month range becomes a half-open date range on the raw
    column so that it reaches the Parquet scan as a pushed filter."""
    c = F.col(date_col)
    cond = (c >= _bound(df, date_col, _month_start(lo_ym))) & (
        c < _bound(df, date_col, _next_month_start(hi_ym)))
    if kind_col is not None:
        cond = cond & F.col(kind_col).isin(list(kinds))
    return df.where(cond)


def batch_size(pages, tiers=BATCH_TIERS, default: int = BATCH_DEFAULT) -> Column:
    p = F.col(pages) if isinstance(pages, str) else pages
    expr = None
    for floor, size in tiers:
        expr = (F.when(p >= floor, F.lit(size)) if expr is None
                else expr.when(p >= floor, F.lit(size)))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def page_batches(df: DataFrame, pages_col: str = "pages", tiers=BATCH_TIERS,
                 default: int = BATCH_DEFAULT) -> DataFrame:
    """One row per batch: ``batch_id`` 1..n, ``begin_page_num``,
    ``end_page_num``.  A key with no page gets no batch (``sequence(1, 0, s)``
    would raise, so it is filtered first)."""
    p = F.col(pages_col).cast("long")
    size = batch_size(p, tiers, default).cast("long")
    cols = [c for c in df.columns if c != pages_col]
    return (df.where(p >= 1)
              .select(*cols, p.alias("_pages"), size.alias("_size"))
              .select(*cols, "_pages", "_size",
                      F.posexplode(F.sequence(F.lit(1).cast("long"), F.col("_pages"),
                                              F.col("_size"))).alias("_pos", "begin_page_num"))
              .select(*cols,
                      (F.col("_pos") + 1).cast("int").alias("batch_id"),
                      F.col("begin_page_num"),
                      F.least(F.col("begin_page_num") + F.col("_size") - 1,
                              F.col("_pages")).alias("end_page_num")))


def year_month_calendar(months_offered: DataFrame, begin_roc_year: int,
                        run_date: dt.date) -> DataFrame:
    """(id, roc_year, roc_month) for every offered month of ROC years
    begin..(run year - 1911); the whole-year entry is dropped; ids 1..n in
    year, month order.  The calendar holds at most 12 rows per year, so the
    global numbering window sees a bounded input."""
    end = run_date.year - ROC_OFFSET
    y = F.col("roc_year").try_cast("int")
    m = F.col("roc_month").try_cast("int")
    months = (months_offered
              .where((F.col("roc_month") != WHOLE_YEAR) & m.isNotNull()
                     & y.between(begin_roc_year, end))
              .select(y.alias("_y"), m.alias("_m")).distinct())
    w = Window.orderBy("_y", "_m")
    return months.select(F.row_number().over(w).cast("int").alias("id"),
                         F.col("_y").cast("string").alias("roc_year"),
                         F.col("_m").cast("string").alias("roc_month"))


def month_gaps(offered: DataFrame, loaded: DataFrame) -> DataFrame:
    """Ranges of consecutive months (roc_year, roc_month, numbers or texts) that
    are offered and not loaded: from_year, from_month, to_year, to_month,
    n_months.  Entries that are no months are ignored.  A calendar has 12 months
    a year, so its one window is small however many rows are loaded."""
    def months(df):
        y, m = F.col("roc_year").try_cast("int"), F.col("roc_month").try_cast("int")
        return df.where(y.isNotNull() & m.between(1, 12)).select((y * 12 + m - 1).alias("_at")).distinct()
    missing = months(offered).join(months(loaded), "_at", "left_anti")
    island = (F.col("_at") - F.row_number().over(Window.orderBy("_at"))).alias("_island")
    ends = missing.select("_at", island).groupBy("_island").agg(
        F.min("_at").alias("lo"), F.max("_at").alias("hi"))
    year, month = (lambda c: F.floor(F.col(c) / 12).cast("int")), (lambda c: (F.col(c) % 12 + 1).cast("int"))
    return ends.select(year("lo").alias("from_year"), month("lo").alias("from_month"), year("hi").alias("to_year"),
                       month("hi").alias("to_month"), (F.col("hi") - F.col("lo") + 1).cast("int").alias("n_months"))


def partitions_for(rows: int, rows_per_partition: int, cap: int) -> int:
    """A fixed partition count for ``rows`` rows: ``rows_per_partition`` each,
    at least 1, at most ``cap``.  Used where AQE cannot coalesce (an explicit
    range exchange), so that a small input does not become thousands of tasks."""
    return max(1, min(cap, -(-rows // rows_per_partition)))


def renumber(df: DataFrame, keys: list[str], order_cols: list, out_col: str,
             num_partitions: int | None = None,
             max_blocks: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Number rows 1..n within each key in ``order_cols`` order, without a
    per-key window, so that one key holding most rows does not land in one task.

    1. Range-partition on (keys, order) and sort inside partitions: a hot key
       is spread over many consecutive partitions.
    2. Tag rows with (partition id, running row id) and count each
       (partition, key) block -- at most #keys + #partitions - 1 blocks.
    3. A key's offset in a partition is the sum of its block sizes in lower
       partitions (a window over the small block table).
    4. Join the blocks back (broadcast when their count is within bound).

    The range exchange has an explicit partition count, so AQE never
    coalesces it and the partition ids seen by steps 2 and 4 agree.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort_cols = [F.col(k) for k in keys] + [F.col(c) if isinstance(c, str) else c
                                            for c in order_cols]
    ranged = (df.repartitionByRange(n, *sort_cols)
                .sortWithinPartitions(*sort_cols)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_rid", F.monotonically_increasing_id())
                .persist(StorageLevel.MEMORY_AND_DISK))
    blocks = (ranged.groupBy("_pid", *keys)
                    .agg(F.min("_rid").alias("_first"), F.count(F.lit(1)).alias("_n")))
    w = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("_pid", *[F.col(k).alias(f"_k_{k}") for k in keys], "_first",
                           F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    blocks = bounded_broadcast(blocks, max_blocks)
    cond = ranged["_pid"] == blocks["_pid"]
    for k in keys:
        cond = cond & ranged[k].eqNullSafe(blocks[f"_k_{k}"])
    joined = ranged.join(blocks, cond, "inner")
    number = (F.col("_before") + F.col("_rid") - F.col("_first") + 1).cast("int")
    out = joined.select(*[ranged[c] for c in df.columns], number.alias(out_col))
    out._pf_cached = ranged  # released by release() once the result is written
    return out


def release(df: DataFrame) -> None:
    """Drop the cache an operator such as :func:`renumber` keeps for ``df``."""
    cached = getattr(df, "_pf_cached", None)
    if cached is not None:
        cached.unpersist()


def crawl_batches(result_lines: DataFrame, text_col: str = "text",
                  tiers=BATCH_TIERS, default: int = BATCH_DEFAULT) -> DataFrame:
    """Result line of each key -> record total -> page count -> page batches.
    A line without a total gives no batch (the key stays pending)."""
    from parcelflow.functions.text import page_count, result_total

    keys = [c for c in result_lines.columns if c != text_col]
    totals = result_lines.select(*keys, result_total(text_col).alias("total_records"))
    pages = totals.where(F.col("total_records").isNotNull()).select(
        *keys, "total_records", page_count("total_records").alias("pages"))
    return page_batches(pages, "pages", tiers, default)
