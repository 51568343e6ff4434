"""End-to-end jobs over the ledger tables (all paths under one root).

Layout (Parquet, partitioned):
  full_stage        city_name, district_name          (full-history crawl)
  stage             stage_date, city_name, district_name  (dated crawls)
  full_check_list   -                                  (keys of the full crawl)
  check_list        stage_date                         (keys of dated crawls)
  ledger            city_name, district_name, stage_date
  ledger_record     exec_date
  run_log, error_log, migration (roc_year, roc_month),
  consumer_loans, construction_loans
  rejects, crawl_plan, crawl_gaps, load_record     stage_date  (null: full crawl)
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import traceback

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from parcelflow import schemas as S
from parcelflow.functions.text import result_total
from parcelflow.operators.checklist import mark_done, mark_pending, pending_keys
from parcelflow.operators.coverage import page_gaps
from parcelflow.operators.integrate import (
    FIRST_RUN_FLAG, JOB_NAME, audit_stamp, carried_counts, choose_main, drop_known, integration_record,
    key_set, purge_record, record_flag, result_message, with_fingerprint,
)
from parcelflow.operators.joins import bounded_broadcast, null_safe_on
from parcelflow.operators.plan import (
    crawl_batches, month_gaps, partitions_for, release, renumber, year_month_calendar,
)
from parcelflow.operators.quality import length_rules, null_rules, split_rejects
from parcelflow.operators.stats import (
    loan_projections, merge_metrics, merge_report, migration_rows, net_mismatch, sheet_slice,
)
from parcelflow.plans import sinks
from parcelflow.session import ensure_checkpoint_dir
from parcelflow.sources.pages import (
    MIN_LISTING_CELLS, district_options, listing_rows, migration_cells,
)

K = S.KEYS
ROWS_PER_RANGE_PARTITION = 1_000_000   # ~300 MB of listing rows per renumbering task


def _ts_lit(ts: dt.datetime):
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def _path(root, name):
    return sinks.table_path(root, name)


def _read(spark, root, name, schema):
    return sinks.read_or_empty(spark, _path(root, name), schema)


def _checks(spark, root, stage_date):
    """The check list of one crawl (the full one when the date is None)."""
    name = "full_check_list" if stage_date is None else "check_list"
    return _read(spark, root, name, S.CHECK_LIST).where(
        F.col("stage_date").eqNullSafe(F.lit(stage_date).cast("date")))


def _of_date(df, stage_date):
    return df.where(F.col("stage_date").eqNullSafe(F.lit(stage_date).cast("date")))


def _put_date(spark, root, name, schema, stage_date, new, keep):
    """Write ``keep(old rows of the date)`` and the new rows as the date's
    partition; no rows at all empty it."""
    day, cols = F.lit(stage_date).cast("date"), [f.name for f in schema.fields]
    old = _of_date(_read(spark, root, name, schema), stage_date)
    had = not old.isEmpty()
    rows = keep(old).select(*cols).unionByName(new.withColumn("stage_date", day).select(*cols)).checkpoint()
    if not rows.isEmpty():
        sinks.overwrite_partitions(rows, _path(root, name), ["stage_date"], cols)
    elif had:
        sinks.clear_partitions(spark, _path(root, name), schema, ["stage_date"], [{"stage_date": stage_date}])


def _without(keys):
    """Old rows but for those of the given (city, district) keys."""
    return lambda old: old.join(keys, null_safe_on(old, keys, K), "left_anti")


def put_rejects(spark, root, bad, stage_date, keep):
    """Rejects of a load, under its date; ``keep`` picks the old ones that stay.
    A load puts its rejects in place of all that an earlier load of the same
    source rows left, also where it has none."""
    _put_date(spark, root, "rejects", S.REJECTS, stage_date, bad, keep)


def _keep_other_sources(source):
    return lambda old: old.where(~F.col("source").eqNullSafe(source))


@dataclasses.dataclass
class IntegrationResult:
    first_run: bool
    result_msg: str
    n_keys: int
    rows_written: int


def _log_error(spark, root, job, ts, text, exc):
    row = [(job, ts, text or "", str(exc), ts, "SYSTEM")]
    sinks.append(spark.createDataFrame(row, S.ERROR_LOG), _path(root, "error_log"))


def _log_run(spark, root, job, ts, msg, n):
    row = [(job, ts, "Y", msg, n, ts, "SYSTEM")]
    sinks.append(spark.createDataFrame(row, S.RUN_LOG), _path(root, "run_log"))


def integrate_job(spark: SparkSession, root: str, run_date: dt.date,
                  run_ts: dt.datetime | None = None, on_rerun: str = "replace",
                  restamp_all: bool = False, dedupe: bool = False, recount: bool = False) -> IntegrationResult:
    """Integrate the stage of ``run_date`` with the ledger.

    First run (empty ledger): full stage + dated stage for the keys of the full
    check list.  Later runs: ledger + dated stage for the keys of that day's
    check list.  The result for every key is the reference's
    ``main UNION ALL sub`` replacing the key, with no dedupe; a second run on
    the same day replaces that stage date's rows instead of appending them
    (``on_rerun="append"`` keeps the old behaviour).  ``dedupe=True`` drops
    incoming rows whose 19 business columns already sit in the ledger under
    another stage date; rows meet by a stored 128-bit fingerprint and are
    confirmed column by column.  Every key of the check list gets a
    reconciliation record; on failure an error-log row is written and the
    exception raised.

    A daily run reads no ledger rows of other dates for its counts: those of a
    key are carried on from its last record (keys without one are counted).
    ``recount=True`` counts them all in the ledger.

    The ledger is partitioned by (city, district, stage_date), so the union
    never has to be rewritten: the main rows of a key already are its other
    partitions, and a run overwrites only the (city, district, run_date)
    partitions with the new stage rows -- write cost grows with the new data,
    not with the ledger.  Only ``restamp_all=True`` (new stamps on every row
    of a processed key) rewrites the keys' partitions.
    """
    run_ts = run_ts or dt.datetime.combine(run_date, dt.time())
    ensure_checkpoint_dir(spark)
    ledger_path = _path(root, "ledger")
    parts = [*K, "stage_date"]
    cols = [f.name for f in S.LEDGER.fields]
    step = "start"
    try:
        ledger = _read(spark, root, "ledger", S.LEDGER)
        full_stage = _read(spark, root, "full_stage", S.STAGE)
        step = "choose main"
        # Records with rows tell that the ledger has some, without a look at it.
        records = _read(spark, root, "ledger_record", S.LEDGER_RECORD)
        first_run = (records.where("total_row_count > 0").isEmpty()
                     and choose_main(ledger, full_stage)[0])
        if first_run:
            ck = _read(spark, root, "full_check_list", S.CHECK_LIST)
            main = audit_stamp(full_stage.withColumn("stage_date", F.lit(None).cast("date")),
                               run_ts, JOB_NAME)
            main_name = "full_stage"
        else:
            ck = _read(spark, root, "check_list", S.CHECK_LIST).where(
                F.col("stage_date") == F.lit(run_date))
            main = ledger
            if on_rerun == "replace":
                main = main.where(~F.col("stage_date").eqNullSafe(F.lit(run_date)))
            main_name = "ledger"
        step = "check list"
        if ck.isEmpty():
            raise ValueError(f"no check list for {'the full crawl' if first_run else run_date}: plan the crawl first")
        sub = audit_stamp(_read(spark, root, "stage", S.STAGE).where(
            F.col("stage_date") == F.lit(run_date)), run_ts, JOB_NAME)
        keys = key_set(ck, K)
        main_k = with_fingerprint(main).join(keys, K, "left_semi").select(*cols)
        sub_k = with_fingerprint(sub).join(keys, K, "left_semi").select(*cols)
        if dedupe and not first_run:
            # Stored rows of the keys that get new rows.  The new rows then
            # depend on the ledger being written: cut that lineage (they are
            # one day's stage, small next to the ledger).
            sub_keys = bounded_broadcast(sub_k.select(*K).distinct())
            sub_k = drop_known(sub_k, main_k.join(sub_keys, K, "left_semi")).checkpoint()

        step = "count"
        counts = None
        if not first_run and not recount and on_rerun == "replace":
            counts = _carried(records, run_date, ck, main_k)

        step = "record"
        record = (integration_record(ck, main_k, sub_k, K, run_date, counts)
                  .select(F.lit(main_name).alias("main_table"),
                          F.col("city_name").alias("main_table_city_name"),
                          F.col("district_name").alias("main_table_district_name"),
                          "main_table_row_count",
                          F.lit(f"stage/{run_date:%Y%m%d}").alias("sub_table"),
                          F.col("city_name").alias("sub_table_city_name"),
                          F.col("district_name").alias("sub_table_district_name"),
                          "sub_table_row_count", "total_row_count",
                          F.lit(FIRST_RUN_FLAG if first_run else record_flag(run_date)).alias("done_yn"),
                          _ts_lit(run_ts).alias("update_time"), F.lit(JOB_NAME).alias("update_by"),
                          _ts_lit(dt.datetime.now()).alias("written_time"),
                          F.lit(run_date).alias("exec_date"))
                  .checkpoint())  # reliable: counts must not be recomputed after the write

        step = "write ledger"
        stale = []
        if not first_run and on_rerun == "replace":
            # Keys that got rows from an earlier run of this date but have no
            # stage rows now: their run_date partition must go.  Read from the
            # partition columns of one date before anything is written; the
            # list is bounded by the number of districts.
            earlier = ledger.where(F.col("stage_date") == F.lit(run_date)).select(*K).distinct()
            gone = earlier.join(keys, K, "left_semi").join(
                sub_k.select(*K).distinct(), K, "left_anti")
            stale = [dict(r.asDict(), stage_date=run_date) for r in gone.collect()]
        if first_run:
            # Main is the full stage, not the ledger: nothing read is overwritten.
            sinks.overwrite_partitions(main_k.unionByName(sub_k), ledger_path, parts, cols)
        elif restamp_all:
            # Every processed key with rows gets new stamps, new rows or not.
            changed = bounded_broadcast(record.where(F.col("total_row_count") > 0).select(
                F.col("main_table_city_name").alias("city_name"),
                F.col("main_table_district_name").alias("district_name")))
            merged = audit_stamp(main_k, run_ts, JOB_NAME).unionByName(sub_k).join(
                changed, K, "left_semi")
            # Cut the lineage to the ledger files this write replaces.
            sinks.overwrite_partitions(merged.checkpoint(), ledger_path, parts, cols)
        elif on_rerun == "append":
            sinks.append(sub_k, ledger_path, parts)
        else:
            sinks.overwrite_partitions(sub_k, ledger_path, parts, cols)
        sinks.clear_partitions(spark, ledger_path, S.LEDGER, parts, stale)

        step = "write record"
        rec_path = _path(root, "ledger_record")
        old = _read(spark, root, "ledger_record", S.LEDGER_RECORD).where(
            F.col("exec_date") == F.lit(run_date))
        kept = purge_record(old, run_date).checkpoint()
        sinks.overwrite_partitions(kept.unionByName(record), rec_path, ["exec_date"],
                                   [f.name for f in S.LEDGER_RECORD.fields])
        written_col = "total_row_count" if (first_run or restamp_all) else "sub_table_row_count"
        n_keys, written = record.agg(F.count(F.lit(1)), F.sum(written_col)).first()
        written = written or 0
        msg = result_message(first_run, run_date)
        _log_run(spark, root, JOB_NAME, run_ts, msg, n_keys)
        return IntegrationResult(first_run, msg, n_keys, int(written))
    except Exception as exc:
        _log_error(spark, root, JOB_NAME, run_ts, f"step: {step}",
                   f"{type(exc).__name__}: {exc}\n{traceback.format_exc()}")
        raise


def _carried(records, run_date, ck, main):
    """Counts of the check list's keys in the ledger: carried, or counted for
    keys whose records cannot tell."""
    carried = carried_counts(records, run_date, K).checkpoint()
    new = _without(carried)(ck.select(*K).distinct()).checkpoint()
    if new.isEmpty():
        return carried
    counted = main.join(bounded_broadcast(new), K, "left_semi").groupBy(*K).agg(F.count(F.lit(1)).alias("n"))
    return carried.unionByName(counted)


def write_check_list(spark: SparkSession, root: str, options: DataFrame,
                     stage_date: dt.date | None, established: dt.datetime) -> DataFrame:
    """Seed the check list of a crawl if it has no rows; otherwise keep it
    (the crawl resumes).  ``options`` holds record_id, city_name, district_name."""
    name = "full_check_list" if stage_date is None else "check_list"
    current = _read(spark, root, name, S.CHECK_LIST)
    if stage_date is not None:
        current = current.where(F.col("stage_date") == F.lit(stage_date))
    if not current.isEmpty():
        return current
    seed = options.select(
        F.col("record_id").cast("int"), *K, _ts_lit(established).alias("establish_time"),
        F.lit(None).cast("timestamp_ntz").alias("scraped_time"),
        F.lit(None).cast("long").alias("total_row_count"), F.lit(None).cast("string").alias("done_yn"),
        F.lit(stage_date).cast("date").alias("stage_date"))
    cols = [f.name for f in S.CHECK_LIST.fields]
    if stage_date is None:
        sinks.append(seed.select(*cols), _path(root, name))
    else:
        sinks.overwrite_partitions(seed, _path(root, name), ["stage_date"], cols)
    return _read(spark, root, name, S.CHECK_LIST).where(
        F.col("stage_date").eqNullSafe(F.lit(stage_date).cast("date")))


def _logged(job: str):
    """Run log on success, error log (then re-raise) on failure."""
    def wrap(fn):
        def run(spark, root, *args, **kwargs):
            ts = dt.datetime.now().replace(microsecond=0)
            try:
                out = fn(spark, root, *args, **kwargs)
            except Exception as exc:
                _log_error(spark, root, job, ts, "", f"{type(exc).__name__}: {exc}")
                raise
            _log_run(spark, root, job, ts, f"{job.upper()}_DONE", None)
            return out
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        return run
    return wrap


@_logged("plan_crawl")
def plan_crawl(spark: SparkSession, root: str, city_page: DataFrame, town_pages: DataFrame,
               stage_date: dt.date | None, established: dt.datetime,
               result_lines: DataFrame | None = None) -> dict[str, int]:
    """Stored dropdown pages -> the crawl's check list (kept if it has rows, so
    an interrupted crawl resumes).  With ``result_lines`` (city_name,
    district_name, text) the page batches of the districts still pending
    replace theirs in the crawl's ``crawl_plan``; loads are held against it."""
    ensure_checkpoint_dir(spark)
    checks = write_check_list(spark, root, district_options(city_page, town_pages), stage_date, established)
    pending = pending_keys(checks).select(*K)
    out = {"districts": checks.count(), "pending": pending.count()}
    if result_lines is not None:
        lines = result_lines.select(*K, "text").join(bounded_broadcast(pending), K, "left_semi")
        batches = crawl_batches(lines).checkpoint()
        _put_date(spark, root, "crawl_plan", S.CRAWL_PLAN, stage_date, batches, _without(pending))
        out["batches"] = batches.count()
    return out


@_logged("load_listings")
def load_listings(spark: SparkSession, root: str, pages: DataFrame,
                  stage_date: dt.date | None, scraped_ts: dt.datetime,
                  result_lines: DataFrame | None = None, resume: bool = False) -> dict[str, int]:
    """Stored listing pages of a crawl -> stage rows.

    Rows are extracted and cleaned, renumbered 1..n per district in batch,
    page, row order, checked (short rows, over-long text and NULL keys go to
    ``rejects``, before numbering), and the crawled districts are
    replaced in the stage with one dynamic overwrite.  ``result_lines``
    (city_name, district_name, text) carries each district's result line: a
    district whose line says 0 records is emptied in the stage.

    A district is done (count, time and flag on the check list) when it has
    good rows, or its line says 0, and every page that ``crawl_plan`` names for
    it gave rows.  Any other district of this load is pending again: one whose
    rows were all rejected keeps its old stage rows, and missing pages are
    listed in ``crawl_gaps``.  ``load_record`` has good, rejected and missing
    counts per district.  All three, and the rejects, take the place of what
    earlier loads of the date left for the same districts.
    With ``resume`` only pages (and result lines) of districts still pending
    on the check list are read; the others keep their stage rows.
    """
    ensure_checkpoint_dir(spark)
    if resume:
        # Checkpointed: the check list is rewritten at the end of the load.
        todo = bounded_broadcast(pending_keys(_checks(spark, root, stage_date)).select(*K).checkpoint())
        pages = pages.join(todo, K, "left_semi")
        if result_lines is not None:
            result_lines = result_lines.join(todo, K, "left_semi")
    # Parse once: good rows and rejects are both read from this cache (a lost
    # block is parsed again from the pages; the parse is deterministic).
    rows = listing_rows(pages).withColumns({"scraped_time": _ts_lit(scraped_ts),
                                            "stage_date": F.lit(stage_date).cast("date")}).persist(
        StorageLevel.MEMORY_AND_DISK)
    try:
        return _load_listing_rows(spark, root, pages, rows, stage_date, scraped_ts, result_lines)
    finally:
        rows.unpersist()


def _load_listing_rows(spark, root, pages, rows, stage_date, scraped_ts, result_lines):
    rules = {"SHORT_ROW": F.col("n_cells") < MIN_LISTING_CELLS, **null_rules(K + ["address"]),
             **length_rules(rows.columns)}
    good, bad = split_rejects(rows, rules, "listing", K + ["batch_id", "page", "pos"])
    # Rejected rows take no number: good rows are numbered 1..n per district.
    # The primary key (city_district_id, city, district, address, scraped_time)
    # then cannot repeat.
    # Size the range exchange from the (cached) row count: AQE does not
    # coalesce an exchange with a fixed partition count.
    n_parts = partitions_for(good.count(), ROWS_PER_RANGE_PARTITION,
                             int(spark.conf.get("spark.sql.shuffle.partitions")))
    good = renumber(good, K, ["batch_id", "page", "pos"], "city_district_id", n_parts)
    stage_cols = [f.name for f in S.STAGE.fields]
    name = "full_stage" if stage_date is None else "stage"
    parts = K if stage_date is None else ["stage_date", *K]
    sinks.overwrite_partitions(good, _path(root, name), parts, stage_cols)
    offered = pages.select(*K).distinct().checkpoint()
    in_json = [F.get_json_object("row_json", f"$.{k}").alias(k) for k in K]
    def keep(old):
        listing = old.where(F.col("source") == "listing").withColumns(dict(zip(K, in_json)))
        return _keep_other_sources("listing")(old).unionByName(_without(offered)(listing).drop(*K))
    put_rejects(spark, root, bad, stage_date, keep)
    n_bad = bad.count()
    gaps = _put_gaps(spark, root, rows, offered, stage_date)

    arrived = good.select(*K).distinct()
    empty_keys = []
    if result_lines is not None:
        totals = result_lines.select(*K, result_total("text").alias("total"))
        zero = totals.where(F.col("total") == 0).select(*K).distinct()
        # A district confirmed empty is done (with 0 rows); one whose line has
        # no total stays pending.
        arrived = arrived.unionByName(zero).distinct()
        # A short control list (districts reporting no result), bounded by #districts.
        empty_keys = [dict(r.asDict(), **({"stage_date": stage_date} if stage_date else {}))
                      for r in zero.collect()]
        sinks.clear_partitions(spark, _path(root, name), S.STAGE, parts, empty_keys)
    done_keys = _without(gaps)(arrived).checkpoint()
    release(good)
    failed = _without(done_keys)(offered)
    _put_load_record(spark, root, rows, rules, offered, gaps, stage_date, scraped_ts)
    # Mark whole districts done with the row count now in the stage.
    ck_name = "full_check_list" if stage_date is None else "check_list"
    ck = _checks(spark, root, stage_date)
    stage_now = _read(spark, root, name, S.STAGE)
    if stage_date is not None:
        stage_now = stage_now.where(F.col("stage_date") == F.lit(stage_date))
    done = mark_done(mark_pending(ck, failed, K), stage_now.select(*K), K, done_keys=done_keys,
                     scraped_time=scraped_ts.strftime("%Y-%m-%d %H:%M:%S.%f")).checkpoint()
    cols = [f.name for f in S.CHECK_LIST.fields]
    if stage_date is None:
        sinks.replace_table(spark, done.select(*cols), _path(root, ck_name))
    else:
        sinks.overwrite_partitions(done, _path(root, ck_name), ["stage_date"], cols)
    missing = gaps.agg(F.sum("n_pages")).first()[0]
    return {"rejects": n_bad, "emptied": len(empty_keys)} | ({"missing_pages": int(missing)} if missing else {})


def _put_gaps(spark, root, rows, offered, stage_date) -> DataFrame:
    """Planned pages of the offered districts that gave no row."""
    plan = _of_date(_read(spark, root, "crawl_plan", S.CRAWL_PLAN), stage_date)
    plan = plan.join(bounded_broadcast(offered), K, "left_semi")
    gaps = page_gaps(plan, rows.select(*K, "page"), K).checkpoint()
    _put_date(spark, root, "crawl_gaps", S.CRAWL_GAPS, stage_date, gaps, _without(offered))
    return gaps


def _put_load_record(spark, root, rows, rules, offered, gaps, stage_date, scraped_ts) -> None:
    """Good and rejected rows and missing pages of each offered district."""
    bad = F.lit(False)
    for rule in rules.values():
        bad = bad | F.coalesce(rule, F.lit(False))
    counts = rows.select(*K, bad.alias("bad")).groupBy(*K).agg(
        F.count_if(~F.col("bad")).alias("good_rows"), F.count_if("bad").alias("bad_rows"))
    missing = gaps.groupBy(*K).agg(F.sum("n_pages").alias("missing_pages"))
    out = offered
    for part in (counts, missing):
        out = out.join(part, null_safe_on(out, part, K), "left").drop(*[part[k] for k in K])
    record = out.select(*K, *[F.coalesce(c, F.lit(0)).cast("long").alias(c)
                              for c in ("good_rows", "bad_rows", "missing_pages")],
                        _ts_lit(scraped_ts).alias("scraped_time"))
    _put_date(spark, root, "load_record", S.LOAD_RECORD, stage_date, record, _without(offered))


@_logged("plan_migration")
def plan_migration(spark: SparkSession, root: str, months_offered: DataFrame, begin_roc_year: int,
                   run_date: dt.date) -> dict[str, int]:
    """Months offered by the site (roc_year, roc_month) -> the ``calendar`` to
    load, and the ranges of it that the migration table lacks
    (``migration_gaps``, which every migration load brings up to date)."""
    ensure_checkpoint_dir(spark)
    calendar = year_month_calendar(months_offered, begin_roc_year, run_date)
    out = {"months": sinks.full_replace(spark, calendar, _path(root, "calendar"))["inserted_rows"]}
    return out | _put_month_gaps(spark, root)


def _put_month_gaps(spark, root) -> dict[str, int]:
    calendar = _read(spark, root, "calendar", S.CALENDAR)
    gaps = month_gaps(calendar, _read(spark, root, "migration", S.MIGRATION).select("roc_year", "roc_month"))
    path = _path(root, "migration_gaps")
    ranges = sinks.full_replace(spark, gaps, path)["inserted_rows"]
    missing = _read(spark, root, "migration_gaps", S.MIGRATION_GAPS).agg(F.sum("n_months")).first()[0]
    return {"missing_ranges": ranges, "missing_months": int(missing or 0)}


@_logged("load_migration")
def load_migration(spark: SparkSession, root: str, pages: DataFrame,
                   run_ts: dt.datetime, job: str = "migration") -> tuple[DataFrame, DataFrame]:
    """Migration pages (metric in move_in/move_out/net, roc_year, roc_month,
    html) -> one row per (year, month, city) with six counts; the months
    present replace theirs in the table, and ``migration_gaps`` then lists the
    months of the calendar still missing (see ``plan_migration``).  Returns two reports over the loaded
    rows: keys missing or duplicated in some metric, and rows whose net
    migration is not move-in minus move-out (loaded all the same)."""
    cells = migration_rows(migration_cells(pages))
    # Running id over the data rows (>= 3 cells) of a month's move-in table,
    # across its pages; a month lists a few dozen cities, so the window is small.
    order = [F.col("page"), F.col("pos")] if "page" in pages.columns else [F.col("pos")]
    w = Window.partitionBy("metric", "roc_year", "roc_month").orderBy(*order)
    long = cells.select("roc_year", "roc_month", "city_district_name", "metric", "male", "female",
                        F.row_number().over(w).alias("row_id"))
    metrics = {"move_in": {"male": "m_move_in", "female": "f_move_in", "row_id": "id"},
               "move_out": {"male": "m_move_out", "female": "f_move_out"},
               "net": {"male": "m_net_migration", "female": "f_net_migration"}}
    keys = ["roc_year", "roc_month", "city_district_name"]
    merged = merge_metrics(long, keys, "metric", metrics, order="row_id").checkpoint()
    # Rows beyond the first of a key and metric are rejected whole.
    place = Window.partitionBy(*keys, "metric").orderBy("row_id")
    repeats = long.withColumn("place", F.row_number().over(place))
    out = merged.select(
        F.col("id").cast("int").alias("id"), "city_district_name", *S.MIGRATION_VALUES,
        _ts_lit(run_ts).alias("create_time"), F.lit(job).alias("create_by"),
        # A load creates the month's rows; the update columns stay empty.
        F.lit(None).cast("timestamp_ntz").alias("update_time"),
        F.lit(None).cast("string").alias("update_by"),
        "roc_year", "roc_month")
    good, bad = split_rejects(out, {**null_rules(keys),
                                    **{f"TOO_LONG:{c}": F.length(c) > S.MIGRATION_MAX_LEN
                                       for c in S.MIGRATION_VALUES + keys}},
                              "migration", keys)
    _, doubled = split_rejects(repeats.where("place > 1").drop("place"), {"DUPLICATE_KEY": F.lit(True)},
                               "migration", [*keys, "metric"])
    bad = bad.unionByName(doubled)
    sinks.overwrite_partitions(good, _path(root, "migration"), ["roc_year", "roc_month"],
                               [f.name for f in S.MIGRATION.fields])
    months = long.select("roc_year", "roc_month").distinct()
    loaded = F.concat_ws("/", F.coalesce("roc_year", F.lit("")), F.coalesce("roc_month", F.lit(""))).alias("month")
    in_key = F.concat_ws("/", F.split_part("key", F.lit("/"), F.lit(1)), F.split_part("key", F.lit("/"), F.lit(2)))

    def keep(old):
        own = old.where(F.col("source") == "migration").withColumn("month", in_key)
        return _keep_other_sources("migration")(old).unionByName(
            own.join(bounded_broadcast(months.select(loaded)), "month", "left_anti").drop("month"))
    put_rejects(spark, root, bad, run_ts.date(), keep)
    if sinks.exists(spark, _path(root, "calendar")):
        _put_month_gaps(spark, root)
    return merge_report(merged, keys, list(metrics)), net_mismatch(out)


@_logged("load_loans")
def load_loans(spark: SparkSession, root: str, sheet: DataFrame, run_ts: dt.datetime,
               marker: str = "10901", job: str = "loans") -> dict[str, dict[str, int]]:
    """Loan sheet rows (row_no, c0..c8) -> the consumer and construction loan
    tables, each fully replaced.  Rows from the marker row on are data; rows
    whose year-month is not a number go to rejects."""
    data = sheet_slice(sheet, marker).checkpoint()
    consumer, construction = loan_projections(data)
    out = {}
    for name, df, schema in (("consumer_loans", consumer, S.CONSUMER_LOANS),
                             ("construction_loans", construction, S.CONSTRUCTION_LOANS)):
        stamped = df.withColumns({"update_by": F.lit(job), "update_time": _ts_lit(run_ts)})
        good, bad = split_rejects(stamped, {"BAD_YEAR_MONTH": F.col("roc_year").isNull()
                                            | F.col("roc_month").isNull()}, name, ["row_no"])
        out[name] = sinks.full_replace(spark, good.select(*[f.name for f in schema.fields]),
                                       _path(root, name))
        put_rejects(spark, root, bad, run_ts.date(), _keep_other_sources(name))
    return out


@_logged("import_database")
def import_database(spark: SparkSession, root: str, read, full_stage: str | None = None,
                    dated_stages: list[str] = (), full_check_list: str | None = None,
                    dated_check_lists: list[str] = (), ledger: str | None = None,
                    migration: str | None = None, record: str | None = None, run_log: str | None = None,
                    error_log: str | None = None, consumer_loans: str | None = None,
                    construction_loans: str | None = None) -> dict[str, int]:
    """Bring the tables of an existing database into the layout.  ``read``
    maps a table name to a DataFrame (``sources.jdbc.read_table`` with the
    connection bound); dated tables take their ``stage_date`` from the
    ``yyyyMMdd`` in their name.  Each table is one parallel read and one
    write, which also counts its rows; an imported table takes the place of what
    is there.  Returns the rows written per target."""
    from parcelflow.sources import jdbc

    out: dict[str, int] = {}

    def put(name, df, parts, schema):
        seen = Observation(name)  # the source is read once: for the count and the write
        sinks.overwrite_partitions(df.observe(seen, F.count(F.lit(1)).alias("rows")), _path(root, name), parts,
                                   [f.name for f in schema.fields])
        out[name] = out.get(name, 0) + int(seen.get["rows"])

    def whole(name, df):
        out[name] = sinks.full_replace(spark, df, _path(root, name))["inserted_rows"]

    if full_stage:
        put("full_stage", jdbc.stage_rows(read(full_stage), None), K, S.STAGE)
    for t in dated_stages:
        put("stage", jdbc.stage_rows(read(t), jdbc.dated_table_date(t)), ["stage_date", *K], S.STAGE)
    if full_check_list:
        whole("full_check_list", jdbc.check_list_rows(read(full_check_list), None))
    for t in dated_check_lists:
        put("check_list", jdbc.check_list_rows(read(t), jdbc.dated_table_date(t)), ["stage_date"],
            S.CHECK_LIST)
    if ledger:
        put("ledger", jdbc.ledger_rows(read(ledger)), [*K, "stage_date"], S.LEDGER)
    if migration:
        put("migration", jdbc.migration_rows(read(migration)), ["roc_year", "roc_month"], S.MIGRATION)
    if record:
        put("ledger_record", jdbc.record_rows(read(record)), ["exec_date"], S.LEDGER_RECORD)
    for name, table, schema in (("run_log", run_log, S.RUN_LOG), ("error_log", error_log, S.ERROR_LOG)):
        if table:
            whole(name, jdbc.log_rows(read(table), schema))
    for name, table, schema in (("consumer_loans", consumer_loans, S.CONSUMER_LOANS),
                                ("construction_loans", construction_loans, S.CONSTRUCTION_LOANS)):
        if table:
            whole(name, jdbc.loan_rows(read(table), schema))
    return out
