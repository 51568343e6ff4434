"""Continuous integration of crawled stage files.

The reference runs a crawl, then triggers the integration procedure.  Here a
crawl drops Parquet files (stage layout, with a ``crawl_id`` where a crawl is
spread over several files) into a landing folder; a Structured Streaming query
picks them up and, per micro-batch,

1. rejects rows of a named crawl whose key has landed already, in this batch
   or an earlier one (``operators.keys``: the keys of each batch are kept as a
   Bloom filter, so the rows landed before are read for possible repeats only),
   and keeps the others as landed (``feed_rows``, one partition per feed and
   batch),
2. finds the last crawl of every district the batch touched, over all that
   has landed for its stage date (``operators.crawls``): a crawl spread over
   several batches comes together, and a re-crawl takes the place of the crawl
   before it,
3. lets a district wait whose planned pages (``crawl_plan``) have not all
   landed; it stays in ``feed_rows`` until they have,
4. replaces the other districts in the dated stage (dynamic partition
   overwrite by stage_date, city, district), and
5. runs :func:`parcelflow.plans.jobs.integrate_job` for their stage dates.

Every step overwrites the partitions it wrote before (undated rows go to
rejects under the batch's own key), so a micro-batch that is replayed after a
failure gives the same tables: exactly-once results on top of the
at-least-once ``foreachBatch`` sink.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parcelflow import schemas as S
from parcelflow.operators.coverage import page_gaps
from parcelflow.operators.crawls import last_crawl
from parcelflow.operators.integrate import fingerprint
from parcelflow.operators.joins import bounded_broadcast, null_safe_on
from parcelflow.operators.keys import FILTER, key_filter, stored_duplicates
from parcelflow.operators.quality import split_rejects
from parcelflow.plans import jobs, sinks

KEYS = ["stage_date", *S.KEYS]
FEED_PARTITIONS = ["stage_date", "feed", "feed_batch"]


def _key():
    """The key of a landed row, as one column."""
    return fingerprint(["stage_date", "crawl_id", *S.STAGE_PK]).alias("key")




def _repeats(spark: SparkSession, root: str, batch: DataFrame, dates: list, feed: str, epoch: int) -> DataFrame:
    """Rows (``row``) of named crawls whose key landed before."""
    def landed(name, schema):
        df = sinks.read_or_empty(spark, sinks.table_path(root, name), schema)
        return df.where(F.col("stage_date").isin(dates) & ~((F.col("feed") == feed) & (F.col("feed_batch") == epoch)))

    named = batch.where("crawl_id is not null").select("row", _key())
    again = named.join(named.groupBy("key").agg(F.min("row").alias("row")), "row", "left_anti")
    filters = landed("feed_keys", S.KEY_FILTER).select(*FILTER.names)
    stored = landed("feed_rows", S.FEED_ROWS).where("crawl_id is not null").select(_key())
    return again.unionByName(stored_duplicates(named, stored, ["key"], filters)).select("row").distinct()


def _land(spark: SparkSession, root: str, batch: DataFrame, feed: str, epoch: int) -> None:
    own = {"feed": F.lit(feed), "feed_batch": F.lit(epoch).cast("long")}
    now = F.lit(f"{dt.datetime.now():%Y-%m-%d %H:%M:%S.%f}").cast("timestamp_ntz")
    sinks.overwrite_partitions(batch.withColumns(own | {"landed": now}), sinks.table_path(root, "feed_rows"),
                               FEED_PARTITIONS, [f.name for f in S.FEED_ROWS.fields])
    named = batch.where("crawl_id is not null")
    for day in [r.stage_date for r in named.select("stage_date").distinct().collect()]:
        keys = key_filter(named.where(F.col("stage_date") == F.lit(day)).select(_key()), ["key"])
        sinks.overwrite_partitions(keys.withColumns(own | {"stage_date": F.lit(day)}), sinks.table_path(root, "feed_keys"),
                                   FEED_PARTITIONS, [f.name for f in S.KEY_FILTER.fields])


def incomplete(spark: SparkSession, root: str, rows: DataFrame) -> DataFrame:
    """Page gaps of the districts in ``rows`` that have a crawl plan."""
    plan = sinks.read_or_empty(spark, sinks.table_path(root, "crawl_plan"), S.CRAWL_PLAN)
    touched = rows.select(*KEYS).distinct()
    return page_gaps(plan.join(bounded_broadcast(touched), KEYS, "left_semi"), rows.select(*KEYS, "page"), KEYS)


def integrate_batch(spark: SparkSession, root: str, batch: DataFrame, epoch: int = 0, feed: str = "direct",
                    **integrate_kw) -> list:
    """The per-micro-batch work; returns the integration results."""
    stage_cols = [f.name for f in S.STAGE.fields]
    if "crawl_id" not in batch.columns:
        batch = batch.withColumn("crawl_id", F.lit(None).cast("string"))
    batch = batch.select(*stage_cols, "crawl_id", F.monotonically_increasing_id().alias("row"))
    batch = batch.checkpoint()  # the batch is read several times below
    if batch.isEmpty():
        return []
    # The dates of one batch: a handful (one per crawl day), never data.
    dates = sorted(r.stage_date for r in batch.select("stage_date").distinct().collect() if r.stage_date)
    repeats = _repeats(spark, root, batch, dates, feed, epoch).withColumn("repeat", F.lit(True))
    batch = batch.join(repeats, "row", "left").checkpoint()
    rules = {"NO_STAGE_DATE": F.col("stage_date").isNull(), "DUPLICATE_KEY": F.col("repeat")}
    batch, bad = split_rejects(batch, rules, "stage_feed", S.KEYS)
    own = f"{feed}/{epoch}/"
    mine = (F.col("source") == "stage_feed") & F.col("key").startswith(own)
    jobs.put_rejects(spark, root, bad.withColumn("key", F.concat(F.lit(own), "key")), None,
                     keep=lambda old: old.where(~mine))
    _land(spark, root, batch, feed, epoch)

    landed = sinks.read_or_empty(spark, sinks.table_path(root, "feed_rows"), S.FEED_ROWS).where(
        F.col("stage_date").isin(dates))
    touched = bounded_broadcast(batch.select(*KEYS).distinct())
    landed = landed.join(touched, null_safe_on(landed, touched, KEYS), "left_semi").withColumn(
        "arrival", F.concat_ws("/", "feed", F.col("feed_batch").cast("string")))
    rows = last_crawl(landed, KEYS).checkpoint()
    waiting = incomplete(spark, root, rows).select(*KEYS).distinct().checkpoint()
    whole = rows.join(bounded_broadcast(waiting), KEYS, "left_anti")
    sinks.overwrite_partitions(whole, sinks.table_path(root, "stage"), KEYS, stage_cols)
    ready = sorted(r.stage_date for r in whole.select("stage_date").distinct().collect())
    return [jobs.integrate_job(spark, root, d, **integrate_kw) for d in ready]


def start_stage_feed(spark: SparkSession, root: str, landing_dir: str,
                     checkpoint_location: str | None = None, available_now: bool = True,
                     max_files_per_trigger: int | None = None, **integrate_kw) -> StreamingQuery:
    """Start the feed.  ``available_now`` processes what is there and stops
    (a scheduled run); otherwise it keeps watching with the default trigger.
    The stream's checkpoint lives beside the tables, at the same place in every
    session, unless a location is given; it also names the feed."""
    location = checkpoint_location or sinks.table_path(root, "_stage_feed_checkpoint")
    feed = hashlib.sha256(location.encode()).hexdigest()[:12]
    reader = spark.readStream.schema(S.FEED)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(landing_dir)
    writer = (stream.writeStream.queryName("parcelflow_stage_feed")
              .option("checkpointLocation", location)
              .foreachBatch(lambda df, epoch: integrate_batch(spark, root, df, epoch, feed, **integrate_kw)))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
