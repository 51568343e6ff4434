"""Monthly statistics: metric merge, sheet slicing, the two loan projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.functions.text import city_squeeze, clean_cell, roc_split
from parcelflow.sources.pages import with_min_cells

# --- fixed values ------------------------------------------------------------
SHEET_MARKER = "10901"          # first data row of the loan sheet (column 0)
MIN_MIGRATION_CELLS = 3
# Loan sheet columns 0..7 -> consumer loan names; columns 0 and 8 -> construction.
CONSUMER_COLUMNS = ["roc_ym", "consumer_total_sum", "house_loan", "house_repair_loan",
                    "car_loan", "employee_welfare_loan", "individual_consumption_loan",
                    "credit_card_loan"]
CONSTRUCTION_COLUMNS = {"c0": "roc_ym", "c8": "construction_loan"}
# -----------------------------------------------------------------------------


def merge_metrics(long_df: DataFrame, keys: list[str], metric_col: str,
                  metrics: dict[str, dict[str, str]], order: str | None = None) -> DataFrame:
    """Merge per-metric rows into one wide row per key.

    ``metrics`` maps a metric name to {value column: output column}.  A key
    missing from a metric gets NULLs there (full outer merge).  Instead of two
    full outer joins this is one union-shaped input and one aggregation: a
    single shuffle, with partial aggregation before it.  ``n_<metric>`` counts
    the rows each metric had for the key (0 = missing, >1 = duplicate) so that
    mismatches can be reported, never silently merged by position.  With
    ``order`` (unique in a key and metric) a duplicate's values are those of
    its first row, all of them; without it, the largest of each column.
    """
    aggs = []
    for metric, cols in metrics.items():
        hit = F.col(metric_col) == F.lit(metric)
        for src, out in cols.items():
            value = F.when(hit, F.col(src))
            first = F.max(value) if order is None else F.min_by(value, F.when(hit, F.col(order)))
            aggs.append(first.alias(out))
        aggs.append(F.count(F.when(hit, F.lit(1))).alias(f"n_{metric}"))
    return (long_df.where(F.col(metric_col).isin(list(metrics)))
                   .groupBy(*keys).agg(*aggs))


def merge_report(merged: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Keys where some metric is missing or duplicated."""
    bad = None
    for m in metrics:
        e = F.col(f"n_{m}") != 1
        bad = e if bad is None else bad | e
    return merged.where(bad).select(*keys, *[f"n_{m}" for m in metrics])


def migration_rows(cells: DataFrame, min_cells: int = MIN_MIGRATION_CELLS) -> DataFrame:
    """Rows of a migration table with at least ``min_cells`` cells: cells 0, 1,
    2 are city, male count, female count (texts)."""
    return (with_min_cells(cells, min_cells)
                 .select(*[c for c in cells.columns if c != "cells"],
                         city_squeeze(F.get("cells", 0)).alias("city_district_name"),
                         clean_cell(F.get("cells", 1)).alias("male"),
                         clean_cell(F.get("cells", 2)).alias("female")))


def net_mismatch(df: DataFrame) -> DataFrame:
    """Rows where net migration != move-in - move-out (reported, not dropped)."""
    def n(c):
        return F.regexp_replace(F.col(c), ",", "").try_cast("long")
    bad = ((n("m_net_migration") != n("m_move_in") - n("m_move_out"))
           | (n("f_net_migration") != n("f_move_in") - n("f_move_out")))
    return df.where(bad)


def sheet_slice(sheet: DataFrame, marker: str = SHEET_MARKER, marker_col: str = "c0",
                order_col: str = "row_no") -> DataFrame:
    """Rows from the first row whose ``marker_col`` equals ``marker`` to the
    end, by position.  The first marker position is a scalar subquery: Spark
    computes it once and inlines it into the filter; no row goes to the driver.
    No marker -> no rows."""
    first = sheet.where(F.col(marker_col) == F.lit(marker)).select(F.min(order_col))
    return sheet.where(F.col(order_col) >= first.scalar())


def loan_projections(sheet: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two projections of one loan sheet: consumer (columns 0-7) and
    construction (columns 0 and 8), each with ROC and AD year/month.  Year-month
    cells that are not numbers come back with NULL parts (see quality rules)."""
    def with_ym(df):
        ym = roc_split(F.col("roc_ym"))
        return df.withColumns({"roc_year": ym.roc_year, "roc_month": ym.roc_month,
                               "ad_year": ym.ad_year, "ad_month": ym.ad_month})
    consumer = with_ym(sheet.select("row_no", *[F.col(f"c{i}").alias(n)
                                               for i, n in enumerate(CONSUMER_COLUMNS)]))
    construction = with_ym(sheet.select("row_no", *[F.col(c).alias(n)
                                                    for c, n in CONSTRUCTION_COLUMNS.items()]))
    return consumer, construction


def tag_projections(df: DataFrame, conditions: dict[str, object], tag_col: str = "sheet") -> DataFrame:
    """Several projections of one input in one pass: each row gets the name
    of the first condition it meets; rows meeting none are dropped."""
    expr = None
    for name, cond in conditions.items():
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return df.withColumn(tag_col, expr).where(F.col(tag_col).isNotNull())
