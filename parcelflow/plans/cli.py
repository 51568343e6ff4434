"""Command line for the jobs, for ``spark-submit`` from a scheduler.

  spark-submit --py-files parcelflow.zip parcelflow/plans/cli.py integrate \\
      --root hdfs:///data/ledger --run-date 2025-08-12
  ... plan-crawl --root R --city-page PATH --town-pages PATH [--stage-date D] [--result-lines PATH]
  ... load-listings --root R --pages PATH --stage-date 2025-08-12 [--result-lines PATH] [--resume]
  ... plan-migration --root R --months PATH [--begin-roc-year 110] [--run-date D]
  ... load-migration --root R --pages PATH
  ... load-loans --root R --sheet PATH [--marker 10901]
  ... stage-feed --root R --landing PATH
  ... import-db --root R --url jdbc:mysql://host/db --user U --full-stage T --dated-stage T ...

Inputs are Parquet tables in the layouts of FIXTURES.md section 1.  A failed
job exits non-zero (the integration also writes its error log first).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from parcelflow import schemas as S
from parcelflow.plans import jobs, sinks
from parcelflow.session import build_session


def _date(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="parcelflow")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("integrate")
    a.add_argument("--root", required=True)
    a.add_argument("--run-date", type=_date, default=dt.date.today())
    a.add_argument("--on-rerun", choices=["replace", "append"], default="replace")
    a.add_argument("--restamp-all", action="store_true")
    a.add_argument("--dedupe", action="store_true")
    a.add_argument("--recount", action="store_true", help="count the ledger instead of carrying counts on")
    b = sub.add_parser("load-listings")
    b.add_argument("--root", required=True)
    b.add_argument("--pages", required=True)
    b.add_argument("--stage-date", type=_date, default=None, help="omit for the full crawl")
    b.add_argument("--result-lines", default=None)
    b.add_argument("--resume", action="store_true", help="load only districts still pending")
    h = sub.add_parser("plan-crawl", help="seed a crawl's check list and plan its page batches")
    h.add_argument("--root", required=True)
    h.add_argument("--city-page", required=True)
    h.add_argument("--town-pages", required=True)
    h.add_argument("--stage-date", type=_date, default=None, help="omit for the full crawl")
    h.add_argument("--result-lines", default=None)
    m = sub.add_parser("plan-migration", help="write the calendar of months to load and what is missing of it")
    m.add_argument("--root", required=True)
    m.add_argument("--months", required=True)
    m.add_argument("--begin-roc-year", type=int, default=110)
    m.add_argument("--run-date", type=_date, default=dt.date.today())
    c = sub.add_parser("load-migration")
    c.add_argument("--root", required=True)
    c.add_argument("--pages", required=True)
    d = sub.add_parser("load-loans")
    d.add_argument("--root", required=True)
    d.add_argument("--sheet", required=True)
    d.add_argument("--marker", default="10901")
    g = sub.add_parser("import-db", help="bring existing database tables into the layout")
    g.add_argument("--root", required=True)
    g.add_argument("--url", required=True, help="JDBC url")
    g.add_argument("--user", required=True)
    g.add_argument("--password-env", default="DB_PASSWORD",
                   help="name of the environment variable holding the password")
    g.add_argument("--full-stage")
    g.add_argument("--dated-stage", action="append", default=[])
    g.add_argument("--full-check-list")
    g.add_argument("--dated-check-list", action="append", default=[])
    g.add_argument("--ledger")
    g.add_argument("--migration")
    for name in ("record", "run-log", "error-log", "consumer-loans", "construction-loans"):
        g.add_argument(f"--{name}")
    g.add_argument("--partitions", type=int, default=64)
    e = sub.add_parser("stage-feed")
    e.add_argument("--root", required=True)
    e.add_argument("--landing", required=True)
    e.add_argument("--checkpoint-location", default=None)
    e.add_argument("--continuous", action="store_true", help="keep watching instead of stopping")
    args = p.parse_args(argv)

    spark = build_session(app=f"parcelflow-{args.cmd}")
    now = dt.datetime.now().replace(microsecond=0)
    if args.cmd == "integrate":
        r = jobs.integrate_job(spark, args.root, args.run_date, now, args.on_rerun,
                               args.restamp_all, args.dedupe, args.recount)
        out = {"result_msg": r.result_msg, "first_run": r.first_run, "keys": r.n_keys,
               "rows_written": r.rows_written}
    elif args.cmd == "load-listings":
        lines = spark.read.parquet(args.result_lines) if args.result_lines else None
        out = jobs.load_listings(spark, args.root, spark.read.parquet(args.pages),
                                 args.stage_date, now, lines, args.resume)
    elif args.cmd == "plan-crawl":
        lines = spark.read.parquet(args.result_lines) if args.result_lines else None
        out = jobs.plan_crawl(spark, args.root, spark.read.parquet(args.city_page),
                              spark.read.parquet(args.town_pages), args.stage_date, now, lines)
    elif args.cmd == "plan-migration":
        out = jobs.plan_migration(spark, args.root, spark.read.parquet(args.months), args.begin_roc_year, args.run_date)
    elif args.cmd == "load-migration":
        report, net = jobs.load_migration(spark, args.root, spark.read.parquet(args.pages), now)
        out = {"mismatched_keys": report.count(), "net_mismatch_rows": net.count()}
        gaps = sinks.read_or_empty(spark, sinks.table_path(args.root, "migration_gaps"), S.MIGRATION_GAPS)
        missing = [f"{g.from_year}/{g.from_month}-{g.to_year}/{g.to_month}"
                   for g in gaps.orderBy("from_year", "from_month").collect()]  # ranges of a calendar: few
        out |= {"missing": missing} if missing else {}
    elif args.cmd == "load-loans":
        out = jobs.load_loans(spark, args.root, spark.read.parquet(args.sheet), now, args.marker)
    elif args.cmd == "import-db":
        import os

        from parcelflow.sources.jdbc import read_table
        password = os.environ.get(args.password_env, "")
        # Columns of many values: numbers of a stage begin anew in each district,
        # and a city alone would fill one bucket.
        rows = "CITY_NAME,DISTRICT_NAME,ADDRESS,"
        hashed = {args.full_stage: rows + "SCRAPED_TIME", args.ledger: rows + "UPDATE_TIME",
                  **{t: rows + "SCRAPED_TIME" for t in args.dated_stage},
                  args.migration: "CITY_DISTRICT_NAME,ROC_YEAR,ROC_MONTH",
                  args.record: "EXEC_DATE,MAIN_TABLE_CITY_NAME,MAIN_TABLE_DISTRICT_NAME"}

        def read(table):
            return read_table(spark, args.url, table, args.user, password, num_partitions=args.partitions,
                              hash_column=hashed.get(table))
        out = jobs.import_database(spark, args.root, read, args.full_stage, args.dated_stage,
                                   args.full_check_list, args.dated_check_list, args.ledger,
                                   args.migration, args.record, args.run_log, args.error_log,
                                   args.consumer_loans, args.construction_loans)
    else:
        from parcelflow.streaming.stage_feed import start_stage_feed
        q = start_stage_feed(spark, args.root, args.landing, args.checkpoint_location,
                             available_now=not args.continuous)
        q.awaitTermination()
        out = {"stream": q.name}
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
