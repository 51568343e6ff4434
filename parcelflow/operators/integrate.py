"""Integration of a dated stage with the ledger: union and key-wise replacement.

One plan replaces the per-district loop: a semi join with the check list
selects the keys, one union merges main and sub rows, two grouped counts feed
the reconciliation record, and one anti join replaces the keys (in the job,
a dynamic partition overwrite of only the new stage-date partitions does).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.operators.checklist import key_counts
from parcelflow.operators.joins import bounded_broadcast
from parcelflow.schemas import LEDGER_COLUMNS

# --- fixed values ------------------------------------------------------------
JOB_NAME = "integrate"
FIRST_RUN_FLAG = "Y_FIRST_TIME_RUN"
RECORD_FLAG_FORMAT = "Y_{date}_D_OF_MONTH_RUN"
FIRST_RUN_MESSAGE_FORMAT = "FIRST_TIME_RUN_{date}_DONE"
DAILY_RUN_MESSAGE_FORMAT = "DAILY_BY_MONTH_{date}_DONE"
# -----------------------------------------------------------------------------


def record_flag(run_date: dt.date) -> str:
    return RECORD_FLAG_FORMAT.format(date=f"{run_date:%Y%m%d}")


def result_message(first_run: bool, run_date: dt.date) -> str:
    fmt = FIRST_RUN_MESSAGE_FORMAT if first_run else DAILY_RUN_MESSAGE_FORMAT
    return fmt.format(date=f"{run_date:%Y%m%d}")


def choose_main(ledger: DataFrame, full_stage: DataFrame,
                main_when_loaded: DataFrame | None = None) -> tuple[bool, DataFrame]:
    """(first_run, main): an empty ledger means the full stage is the main
    table of this run; otherwise ``main_when_loaded`` (the ledger itself by
    default) is.  One-row probe on the driver; only a boolean comes back."""
    first = ledger.isEmpty()
    if first:
        return True, full_stage
    return False, (ledger if main_when_loaded is None else main_when_loaded)


def audit_stamp(df: DataFrame, run_ts, job: str = JOB_NAME,
                time_col: str = "update_time", by_col: str = "update_by") -> DataFrame:
    """Stamp rows with the run's time and job name.  ``run_ts`` is passed in
    (not ``current_timestamp()``) so that a retried task writes the same value."""
    ts = run_ts if isinstance(run_ts, Column) else F.lit(
        run_ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    return df.withColumns({time_col: ts, by_col: F.lit(job)})


def key_set(check_list: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of a check list, broadcast behind a size check."""
    return bounded_broadcast(check_list.select(*keys).distinct())


def union_main_sub(main: DataFrame, sub: DataFrame, check_list: DataFrame,
                   keys: list[str]) -> DataFrame:
    """UNION ALL of main and sub rows whose key is in the check list; no
    dedupe.  The semi join sits on top of the union and Catalyst pushes it
    into both branches, next to their scans."""
    ks = key_set(check_list, keys)
    return main.unionByName(sub, allowMissingColumns=True).join(ks, keys, "left_semi")


def distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys).distinct()


def replace_by_key(target: DataFrame, source: DataFrame, keys: list[str],
                   source_keys: DataFrame | None = None) -> DataFrame:
    """Target rows of keys absent from ``source`` plus all source rows: the
    delete-by-join-then-insert, as one anti join and one union.  The source's
    key set (districts, months) is broadcast behind a size check, so the big
    target is never shuffled for it.  An empty source changes nothing.  NULL keys never match (as SQL ``=``), so target
    rows with a NULL key are kept."""
    ks = source_keys if source_keys is not None else bounded_broadcast(distinct_keys(source, keys))
    kept = target.join(ks, keys, "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def integration_record(check_list: DataFrame, main: DataFrame, sub: DataFrame,
                       keys: list[str], run_date: dt.date, main_counts: DataFrame | None = None) -> DataFrame:
    """One row per check-list key: main, sub and total row counts (0 when the
    key has no rows) and the run flag.  Each side is one grouped count, but for
    ``main_counts`` (keys, n) where the main rows are counted already."""
    m = key_counts(main, keys, "_m") if main_counts is None else main_counts.select(*keys, F.col("n").alias("_m"))
    s = key_counts(sub, keys, "_s")
    ck = check_list.select(*keys)
    rec = ck.join(m, keys, "left").join(s, keys, "left")
    mc = F.coalesce(F.col("_m"), F.lit(0)).cast("long")
    sc = F.coalesce(F.col("_s"), F.lit(0)).cast("long")
    return rec.select(*keys, mc.alias("main_table_row_count"),
                      sc.alias("sub_table_row_count"), (mc + sc).alias("total_row_count"),
                      F.lit(record_flag(run_date)).alias("done_yn"))


def purge_record(records: DataFrame, exec_date, date_col: str = "exec_date",
                 flag_col: str = "done_yn", keep_flag: str = FIRST_RUN_FLAG) -> DataFrame:
    """Records that survive a re-run on ``exec_date``: that day's records are
    removed unless they are first-run ones; other days are untouched."""
    d = exec_date if isinstance(exec_date, Column) else F.lit(exec_date)
    drop = (F.col(date_col) == d) & (F.col(flag_col) != F.lit(keep_flag))
    return records.where(~drop)


def fingerprint(cols: list[str] = LEDGER_COLUMNS) -> Column:
    """128 bits over the columns: equal rows have equal ones.  Lengths stand in
    front of the values and null has its own mark, so no two different rows are
    hashed as one text."""
    text = [F.col(c).cast("string") for c in cols]
    parts = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in text]
    return F.unhex(F.md5(F.concat_ws(",", *parts)))


def with_fingerprint(df: DataFrame) -> DataFrame:
    """Rows with their ``fingerprint``; one that is stored is kept."""
    own = fingerprint()
    return df.withColumn("fingerprint", F.coalesce("fingerprint", own) if "fingerprint" in df.columns else own)


def drop_known(new: DataFrame, stored: DataFrame, cols: list[str] = LEDGER_COLUMNS) -> DataFrame:
    """``new`` without the rows whose ``cols`` are in ``stored``; both have a
    ``fingerprint``.  Only fingerprints are shuffled: distinct ones of the stored
    rows first (a sale stored a million times is one row per task), and the
    columns of the few stored rows whose fingerprint a new row has, to confirm
    that the rows are equal."""
    row = F.struct(*cols)
    seen = stored.select("fingerprint").distinct()
    hits = bounded_broadcast(new.select("fingerprint").join(seen, "fingerprint", "left_semi").distinct())
    known = (stored.join(hits, "fingerprint", "left_semi").groupBy("fingerprint")
             .agg(F.collect_set(row).alias("_known")))
    return (new.join(known, "fingerprint", "left")
            .where(F.col("_known").isNull() | ~F.array_contains("_known", row)).select(*new.columns))


def carried_counts(records: DataFrame, run_date: dt.date, keys: list[str]) -> DataFrame:
    """Rows of each key in the ledger before ``run_date`` (keys, n), from the
    total of its last record.  Left out, as their records cannot tell, are keys
    with a record of a later date, keys of which an earlier date was run after a
    later one (by ``written_time``), and records without that time, as imported
    ones are."""
    written = F.col("written_time")
    own = [F.col(f"main_table_{k}").alias(k) for k in keys]
    before = F.col("exec_date") < F.lit(run_date)
    return (records.select(*own, "total_row_count", "exec_date", written.alias("written")).groupBy(*keys)
            .agg(F.max_by("total_row_count", F.when(before, F.col("exec_date"))).alias("n"),
                 F.max(F.when(before, F.col("exec_date"))).alias("last"),
                 F.max("exec_date").alias("latest"),
                 F.max_by("written", F.when(before, F.col("exec_date"))).alias("at"),
                 F.max_by("exec_date", F.when(before, F.struct("written", "exec_date"))).alias("last_written"))
            .where((F.col("latest") <= F.lit(run_date)) & (F.col("last") == F.col("last_written"))
                   & F.col("at").isNotNull())
            .select(*keys, "n"))


def replace_counts(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row: rows a full replace deletes and inserts.  Both sides are
    counted in one aggregation over a tagged union (no join of two scalars)."""
    tagged = old.select(F.lit(True).alias("_old")).unionByName(new.select(F.lit(False).alias("_old")))
    return tagged.agg(F.count_if(F.col("_old")).alias("deleted_rows"),
                      F.count_if(~F.col("_old")).alias("inserted_rows"))


def run_log_row(check_list: DataFrame, result_msg: str, job: str = JOB_NAME,
                done_yn: str = "Y") -> DataFrame:
    """The run-log row of an integration: job, result message, number of
    check-list keys covered, done flag."""
    return check_list.agg(F.count(F.lit(1)).alias("n_districts")).select(
        F.lit(job).alias("job"), F.lit(result_msg).alias("result_msg"), "n_districts",
        F.lit(done_yn).alias("done_yn"))
