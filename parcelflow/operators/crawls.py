"""Which rows belong to the last crawl of a district.

Every row carries the clock of its own extraction, so a crawl has many times.
What identifies a crawl is its ``crawl_id``; without one, rows landed together
belong to one crawl as long as no pause of ``CRAWL_PAUSE`` separates them
(a Spark session window).  The last crawl is the one whose last row is latest;
of two that end at the same time, the one that landed later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.operators.joins import null_safe_on

CRAWL_PAUSE = "30 minutes"


def crawls(rows: DataFrame, keys: list[str], pause: str = CRAWL_PAUSE) -> DataFrame:
    """One row per crawl: keys, crawl, first, last, landed, n_rows.  ``rows``
    has keys, crawl_id, scraped_time, landed (any orderable) and ``arrival``, which
    rows landed together share."""
    at = F.coalesce("scraped_time", F.lit("1970-01-01").cast("timestamp_ntz"))
    rows = rows.select(*keys, "crawl_id", "arrival", "landed", at.alias("at"))
    measures = [F.min("at").alias("first"), F.max("at").alias("last"), F.max("landed").alias("landed"),
                F.count(F.lit(1)).alias("n_rows")]
    named = (rows.where("crawl_id is not null").groupBy(*keys, F.concat(F.lit("="), "crawl_id").alias("crawl"))
             .agg(*measures))
    paused = (rows.where("crawl_id is null")
              .groupBy(*keys, F.concat(F.lit("#"), "arrival").alias("crawl"), F.session_window("at", pause))
              .agg(*measures).drop("session_window"))
    return named.unionByName(paused)


def last_crawl(rows: DataFrame, keys: list[str], pause: str = CRAWL_PAUSE) -> DataFrame:
    """The rows of each key's last crawl, whole.  Only one row per crawl is
    compared; a key with most of all rows is aggregated map-side."""
    best = F.max(F.struct("last", "landed", "crawl", "first"))
    chosen = crawls(rows, keys, pause).groupBy(*keys).agg(best.alias("c")).select(
        *keys, F.col("c.crawl").alias("crawl"), F.col("c.first").alias("first"))
    crawl = F.coalesce(F.concat(F.lit("="), rows["crawl_id"]), F.concat(F.lit("#"), rows["arrival"]))
    at = F.coalesce(rows["scraped_time"], F.lit("1970-01-01").cast("timestamp_ntz"))
    same = null_safe_on(rows, chosen, keys) & (crawl == chosen["crawl"]) & (at >= chosen["first"])
    return rows.join(chosen, same, "left_semi")
