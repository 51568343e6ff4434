"""The registered queries: each operator of the inventory run on the test
tables (``tx`` plays the listing rows, ``ck`` the check list; see
``parcelflow.sources.testdata``).  Every callable takes (spark, sf_dir) and
returns a lazy DataFrame whose column names match ``oracle.ORACLE_SQL``.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelflow.functions.html import html_rows
from parcelflow.functions.text import (
    city_squeeze, clean_cell, half_width, page_count, parking_mark,
    result_total, roc_split, stage_suffix, type_map,
)
from parcelflow.operators.checklist import (
    mark_done, pending_keys, pending_range, seed_if_empty,
)
from parcelflow.operators.coverage import page_gaps
from parcelflow.operators.crawls import last_crawl
from parcelflow.operators.integrate import (
    JOB_NAME, audit_stamp, carried_counts, choose_main, distinct_keys, drop_known, fingerprint,
    integration_record, purge_record, replace_by_key, result_message,
)
from parcelflow.operators.keys import key_filter, stored_duplicates
from parcelflow.operators.plan import month_gaps, page_batches, period_filter, renumber, year_month_calendar
from parcelflow.operators.quality import keep_first_by_key, pk_violations, with_reject_reason
from parcelflow.operators.stats import (
    CONSUMER_COLUMNS, loan_projections, merge_metrics, merge_report, migration_rows, sheet_slice,
)
from parcelflow import schemas as S
from parcelflow.plans import jobs, sinks
from parcelflow.session import ensure_checkpoint_dir
from parcelflow.sources.pages import (
    PRICE_CELL, TARGET_CELL, TYPE_CELL, listing_columns, option_labels,
)
from parcelflow.sources.testdata import ck, table, tx

KEYS = ["city", "district"]


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _before(df: DataFrame, day: str) -> DataFrame:
    return df.where(F.col("tx_date") < _ts(day))


def _from(df: DataFrame, day: str) -> DataFrame:
    return df.where(F.col("tx_date") >= _ts(day))


# -- 2.1 sources and row extraction ------------------------------------------

def li_items_from_html(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "html")
    items = option_labels(pages, "li")
    return items.where(F.col("href").isNotNull()).select("page_id", "href")


def option_list(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "html")
    labels = option_labels(pages, "li")
    return (labels.where(~F.col("label").isin("para", "no."))
                  .groupBy("page_id").agg(F.count(F.lit(1)).alias("n_items")))


def visible_text(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "html")
    text = F.array_join(F.transform(html_rows("html", "h1", None), lambda r: F.get(r.cells, 0)), "\n")
    return pages.select("page_id", clean_cell(text).alias("h1"))


def min_cells(spark: SparkSession, sf: str) -> DataFrame:
    # The migration load's own rows: a document's words are the cells.
    docs = table(spark, sf, "documents").select("doc_id", F.split("text", " ").alias("cells"))
    return migration_rows(docs).select("doc_id", "city_district_name", "male", "female")


def sheet_slice_q(spark: SparkSession, sf: str) -> DataFrame:
    # The "sheet": one row per month of orders; a row's position is its month
    # count (year * 12 + month), which orders rows exactly as the sheet does.
    d = F.col("o_orderdate")
    sheet = (table(spark, sf, "orders")
             .groupBy(F.date_format(d, "yyyyMM").alias("ym"),
                      (F.year(d) * 12 + F.month(d)).cast("long").alias("row_no"))
             .agg(F.count(F.lit(1)).alias("n")))
    return sheet_slice(sheet, marker="199701", marker_col="ym").select("ym", "n")


def stage_date(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderdate")
    return o.groupBy(stage_suffix("o_orderdate").alias("stage_date")).agg(
        F.count(F.lit(1)).alias("n"))


# -- 2.2 filters --------------------------------------------------------------

def period_filter_q(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return period_filter(o, "o_orderdate", 199701, 200010, "o_orderstatus", ["F", "O"]).select(
        "o_orderkey")


def pending_keys_q(spark: SparkSession, sf: str) -> DataFrame:
    # A check list on which a load has filled all three status columns of the done districts.
    todo = ck(spark, sf)
    marked = mark_done(todo, tx(spark, sf), KEYS, done_keys=todo.where("done_yn = 'Y'"),
                       scraped_time="2000-01-01 00:00:00")
    return pending_keys(marked).select("record_id", "city", "district")


# -- 2.3 scalar functions ------------------------------------------------------

def half_width_q(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    wide = F.translate("p_brand", "Brand#0123456789", "Ｂｒａｎｄ＃０１２３４５６７８９")
    return part.select("p_partkey", half_width(wide).alias("brand"))


def clean_cell_q(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    raw = F.when(F.col("p_size") % 5 == 0, F.lit("  ")).otherwise(
        F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")))
    return part.select("p_partkey", clean_cell(raw).alias("community"))


def parking_mark_q(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    price = F.floor("o_totalprice").cast("long").cast("string")
    return o.select("o_orderkey",
                    parking_mark(price, F.col("o_orderstatus") == "P").alias("total_price_10k"))


def type_map_q(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    pr = F.col("o_orderpriority")
    # Priorities 1, 2 and 5 carry the icons bt01, bt02, bt05; the rest have none
    # and an empty cell.
    icon = F.when(pr.isin("1-URGENT", "2-HIGH", "5-LOW"),
                  F.concat(F.lit("bt0"), F.substring(pr, 1, 1), F.lit("_br")))
    return o.select("o_orderkey", clean_cell(type_map(icon, F.lit(""))).alias("type"))


def result_total_q(spark: SparkSession, sf: str) -> DataFrame:
    counts = tx(spark, sf).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
    line = F.concat(F.lit("查詢結果 : "), F.format_number("n", 0), F.lit(" 筆"))
    return counts.select(*KEYS, result_total(line).alias("total_records"))


def page_batches_q(spark: SparkSession, sf: str) -> DataFrame:
    counts = tx(spark, sf).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
    pages = counts.select(*KEYS, page_count("n").alias("pages"))
    # Tiers scaled down to the test data: 5 pages per batch from 20 pages, 3 from 10.
    return page_batches(pages, "pages", tiers=((20, 5), (10, 3)), default=1)


def page_gaps_q(spark: SparkSession, sf: str) -> DataFrame:
    # Each urgent, partly shipped order stands for one row of a loaded page of its district.
    t = tx(spark, sf)
    plan = page_batches(t.groupBy(*KEYS).agg(page_count(F.count(F.lit(1))).alias("pages")), "pages",
                        tiers=((20, 5), (10, 3)), default=1)
    pages = plan.groupBy(*KEYS).agg(F.max("end_page_num").alias("pages"))
    status = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority").where(
        "o_orderstatus = 'P' and o_orderpriority = '1-URGENT'")
    loaded = t.join(status.select("o_orderkey"), "o_orderkey").join(pages, KEYS).select(
        *KEYS, (F.col("o_orderkey") % F.col("pages") + 1).alias("page"))
    return page_gaps(plan, loaded, KEYS)


def last_crawl_q(spark: SparkSession, sf: str) -> DataFrame:
    # A user's events are rows of one place; six hours without any end a crawl.
    ev = table(spark, sf, "events").select(
        "event_id", "user_id", F.col("ts").cast("timestamp_ntz").alias("scraped_time"),
        F.lit(None).cast("string").alias("crawl_id"), F.lit("landed").alias("arrival"), F.lit(1).alias("landed"))
    return last_crawl(ev, ["user_id"], "6 hours").select("user_id", "event_id")


def city_squeeze_q(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    text = F.concat(F.col("c_mktsegment"), F.lit(" "), F.col("c_name"), F.lit(" "))
    return c.select("c_custkey", city_squeeze(text).alias("city"))


def roc_split_q(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    d = F.col("o_orderdate")
    ym = F.concat(F.lpad((F.year(d) - 1911).cast("string"), 3, "0"),
                  F.lpad(F.month(d).cast("string"), 2, "0"))
    r = roc_split(ym)
    return o.select("o_orderkey", r.roc_year.alias("roc_year"), r.roc_month.alias("roc_month"),
                    r.ad_year.alias("ad_year"))


def year_month_calendar_q(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "orders").select("o_orderdate")
    # Months offered = months present in orders, plus a whole-year entry per year.
    ym = d.select((F.year("o_orderdate") - 1911).cast("string").alias("roc_year"),
                  F.month("o_orderdate").cast("string").alias("roc_month")).distinct()
    offered = ym.select("roc_year", F.explode(F.array("roc_month", F.lit("全年"))).alias("roc_month"))
    return year_month_calendar(offered, begin_roc_year=84, run_date=dt.date(2000, 12, 31))


def cells_to_columns_q(spark: SparkSession, sf: str) -> DataFrame:
    # The listing load's own columns, from 19 cells and icons a part.
    size, brand = F.col("p_size"), F.translate("p_brand", "Brand#0123456789", "Ｂｒａｎｄ＃０１２３４５６７８９")
    cells = [F.concat(F.lit("　 "), brand, F.lit(f"－{i} ")) for i in range(19)]
    cells[PRICE_CELL] = F.floor("p_retailprice").cast("string")
    cells[TARGET_CELL] = F.concat(F.lit(" "), F.col("p_name"), F.lit("　"))
    cells[9] = F.when(size % 5 == 0, F.lit("　")).otherwise(cells[9])
    icons = [F.array().cast("array<string>")] * 19
    icons[PRICE_CELL] = F.when(size % 2 == 0, F.array(F.lit("x"), F.lit("btP_br"))).otherwise(icons[0])
    icons[TYPE_CELL] = F.when(size % 3 == 0, F.array(F.lit("bt01_br"))).otherwise(icons[0])
    rows = table(spark, sf, "part").select("p_partkey", F.array(*cells).alias("cells"), F.array(*icons).alias("spans"))
    return listing_columns(rows)


def two_projections(spark: SparkSession, sf: str) -> DataFrame:
    # The loan load's own projections, of a sheet with a row per month of orders.
    d = F.col("o_orderdate")
    ym = F.concat(F.lpad((F.year(d) - 1911).cast("string"), 3, "0"), F.lpad(F.month(d).cast("string"), 2, "0"))
    sheet = (table(spark, sf, "orders").groupBy(ym.alias("c0")).agg(F.count(F.lit(1)).alias("n"))
             .select("c0", F.col("c0").cast("long").alias("row_no"),
                     *[(F.col("n") * i).cast("string").alias(f"c{i}") for i in range(1, 9)]))
    consumer, construction = loan_projections(sheet)
    head = ["roc_year", "roc_month", "ad_year", "ad_month"]
    return (consumer.select(F.lit("consumer").alias("sheet"), *head, F.concat_ws("|", *CONSUMER_COLUMNS[1:]).alias("amounts"))
            .unionByName(construction.select(F.lit("construction").alias("sheet"), *head,
                                             F.col("construction_loan").alias("amounts"))))


def audit_stamp_q(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").select("s_suppkey")
    return audit_stamp(s, dt.datetime(2025, 8, 14), "integrate")


# -- 2.4 set operations and joins ----------------------------------------------

def choose_main_q(spark: SparkSession, sf: str) -> DataFrame:
    # Listings of districts outside the check list: none, so the first run's empty ledger.
    t = tx(spark, sf)
    none = t.join(ck(spark, sf), KEYS, "left_anti")
    _, first = choose_main(ledger=none, full_stage=t)
    _, daily = choose_main(ledger=t, full_stage=none)
    cols = ["city", "district", "o_orderkey"]
    return (first.select(F.lit("first").alias("run"), *cols)
            .unionByName(daily.select(F.lit("daily").alias("run"), *cols)))


def union_main_sub_q(spark: SparkSession, sf: str) -> DataFrame:
    # The integration job itself on a fresh root: the ledger it writes is the union.
    t, todo = tx(spark, sf), ck(spark, sf).where("done_yn is null")
    root = _scratch(spark, "integrate")
    day = dt.date(2000, 1, 1)

    def put(rows, name, date, parts):
        own = {"city_name": "city", "district_name": "district", "address": F.col("o_orderkey").cast("string"),
               "scraped_time": "tx_date", "stage_date": F.lit(date)}
        cols = [F.col(own.get(f.name)) if isinstance(own.get(f.name), str) else own.get(f.name, F.lit(None))
                for f in S.STAGE.fields]
        rows = rows.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(cols, S.STAGE.fields)])
        sinks.overwrite_partitions(rows, f"{root}/{name}", parts, S.STAGE.names)

    put(_before(t, "2000-01-01"), "full_stage", None, S.KEYS)
    put(_from(t, "1999-12-01"), "stage", day, ["stage_date", *S.KEYS])
    options = todo.select("record_id", F.col("city").alias("city_name"), F.col("district").alias("district_name"))
    jobs.write_check_list(spark, root, options, None, dt.datetime(2000, 1, 1))
    jobs.integrate_job(spark, root, day)
    ledger = sinks.read_or_empty(spark, f"{root}/ledger", S.LEDGER)
    return ledger.select(F.col("city_name").alias("city"), F.col("district_name").alias("district"),
                         F.col("address").cast("long").alias("o_orderkey"),
                         F.when(F.col("stage_date").isNull(), "main").otherwise("sub").alias("src"))


def distinct_keys_q(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_keys(tx(spark, sf), KEYS)


def replace_by_key_q(spark: SparkSession, sf: str) -> DataFrame:
    t = tx(spark, sf).select("city", "district", "o_orderkey", "tx_date")
    src = _from(t.where(F.col("city") == "ASIA"), "2000-01-01")
    tgt = _before(t, "2000-01-01")
    return replace_by_key(tgt, src, KEYS).select("city", "district", "o_orderkey")


def renumber_q(spark: SparkSession, sf: str) -> DataFrame:
    t = tx(spark, sf).select("city", "district", "o_orderkey", "tx_date")
    return renumber(t, KEYS, ["tx_date", "o_orderkey"], "city_district_id").select(
        "o_orderkey", "city_district_id")


def metric_merge(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").select(F.to_date("ts").alias("day"), "event_type")
    daily = (ev.where(F.col("event_type").isin("signup", "error", "click"))
               .groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("n")))
    merged = merge_metrics(daily, ["day"], "event_type",
                           {"signup": {"n": "n_in"}, "error": {"n": "n_out"},
                            "click": {"n": "n_net"}})
    return merged.select("day", "n_in", "n_out", "n_net")


def metric_merge_report(spark: SparkSession, sf: str) -> DataFrame:
    """Op 27's report: hours where a metric is missing (or duplicated)."""
    ev = table(spark, sf, "events").select(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), "event_type")
    hourly = (ev.where(F.col("event_type").isin("signup", "error", "click"))
                .groupBy("hour", "event_type").agg(F.count(F.lit(1)).alias("n")))
    metrics = {"signup": {"n": "n_in"}, "error": {"n": "n_out"}, "click": {"n": "n_net"}}
    merged = merge_metrics(hourly, ["hour"], "event_type", metrics)
    return merge_report(merged, ["hour"], list(metrics))


# -- 2.5 aggregations ------------------------------------------------------------

def seed_if_empty_q(spark: SparkSession, sf: str) -> DataFrame:
    # Two crawls: one whose list has the done districts (it resumes), one whose list
    # has the districts without listings (none as a rule, so it is seeded).
    c, cols = ck(spark, sf), ["record_id", "city", "district"]
    resumed = seed_if_empty(c.where("done_yn = 'Y'").select(*cols), c.where("done_yn is null").select(*cols))
    fresh = seed_if_empty(c.join(distinct_keys(tx(spark, sf), KEYS), KEYS, "left_anti").select(*cols),
                          c.select(*cols))
    return (resumed.withColumn("crawl", F.lit("resumed"))
            .unionByName(fresh.withColumn("crawl", F.lit("fresh"))))


def pending_range_q(spark: SparkSession, sf: str) -> DataFrame:
    # A check list with a key per customer; those with orders are done.
    done = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), F.lit("Y").alias("done_yn")).distinct()
    checks = table(spark, sf, "customer").join(done, "c_custkey", "left").select(
        F.col("c_custkey").cast("int").alias("record_id"), F.col("c_name").alias("district"), "done_yn")
    return pending_range(checks, key_col="district", status_cols=("done_yn",))


def carried_counts_q(spark: SparkSession, sf: str) -> DataFrame:
    # A record per district and month, as monthly runs would have left them.
    month = F.trunc("tx_date", "month").alias("exec_date")
    counts = _before(tx(spark, sf), "2000-01-01").groupBy(*KEYS, month).agg(F.count(F.lit(1)).alias("sub"))
    so_far = F.sum("sub").over(Window.partitionBy(*KEYS).orderBy("exec_date"))
    at = F.col("exec_date").cast("timestamp_ntz")
    records = counts.select(*[F.col(k).alias(f"main_table_{k}") for k in KEYS], "exec_date",
                            so_far.alias("total_row_count"), at.alias("update_time"), at.alias("written_time"))
    return carried_counts(records, dt.date(2000, 1, 1), KEYS)


def stored_keys(spark: SparkSession, sf: str) -> DataFrame:
    # Orders from 1999 on whose customer and priority an earlier order had.
    o, pk = table(spark, sf, "orders"), ["o_custkey", "o_orderpriority"]
    stored = o.where(F.col("o_orderdate") < _ts("1999-01-01")).select(*pk)
    new = o.where(F.col("o_orderdate") >= _ts("1999-01-01")).select("o_orderkey", *pk)
    return stored_duplicates(new, stored, pk, key_filter(stored, pk)).select("o_orderkey")


def drop_known_q(spark: SparkSession, sf: str) -> DataFrame:
    # Line items from 1999 on whose part, supplier and quantity are new.
    cols = ["l_partkey", "l_suppkey", "l_returnflag"]
    li = table(spark, sf, "lineitem").withColumn("fingerprint", fingerprint(cols))
    new = li.where(F.col("l_shipdate") >= _ts("1999-01-01"))
    stored = li.where(F.col("l_shipdate") < _ts("1999-01-01")).select(*cols, "fingerprint")
    return drop_known(new.select("l_orderkey", "l_linenumber", *cols, "fingerprint"), stored, cols).select(
        "l_orderkey", "l_linenumber")


def month_gaps_q(spark: SparkSession, sf: str) -> DataFrame:
    # Months with orders are offered, months with a large urgent one are loaded.
    def months(df):
        return df.select((F.year("o_orderdate") - 1911).alias("roc_year"), F.month("o_orderdate").alias("roc_month"))
    o = table(spark, sf, "orders")
    big = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 490_000)
    return month_gaps(months(o), months(o.where(big)))


def integration_record_q(spark: SparkSession, sf: str) -> DataFrame:
    t = tx(spark, sf).select("city", "district", "tx_date")
    return integration_record(ck(spark, sf), _before(t, "2000-01-01"), _from(t, "2000-01-01"),
                              KEYS, dt.date(2000, 1, 1))


def pk_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    """Op 36's dedupe: the first row per key in load order (key = customer,
    order = order key); the other rows are the duplicates sent to rejects."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    kept, _ = keep_first_by_key(o, ["o_custkey"], "o_orderkey")
    return kept


def pk_violations_q(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return pk_violations(li, ["l_orderkey", "l_linenumber"])


# -- 2.6 sinks (their DataFrame side) --------------------------------------------

def mark_done_q(spark: SparkSession, sf: str) -> DataFrame:
    # The stage holds rows of the pending districts; the others get a count of 0.
    c = ck(spark, sf)
    target = tx(spark, sf).select(*KEYS).join(c.where("done_yn is null"), KEYS, "left_semi")
    return mark_done(c, target, KEYS).select(
        "record_id", "city", "district", "total_row_count", "done_yn")


def replace_by_month(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    tgt = o.select(F.year("o_orderdate").cast("long").alias("y"),
                   F.month("o_orderdate").cast("long").alias("m"), "o_orderkey",
                   F.lit("old").alias("src"))
    src = tgt.where((F.col("y") == 1998) & (F.col("m") == 10)).withColumn("src", F.lit("new"))
    out = replace_by_key(tgt, src, ["y", "m"])
    return out.groupBy("y", "m", "src").agg(F.count(F.lit(1)).alias("n"))


def load_rejects(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    tagged = with_reject_reason(part, {"TOO_LONG": F.length("p_name") > 10})
    return tagged.select("p_partkey", F.length("p_name").cast("long").alias("len"),
                         F.coalesce(F.col("reject_reason"), F.lit("OK")).alias("verdict"))


def purge_record_q(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    rec = o.select(F.to_date("o_orderdate").alias("exec_date"),
                   F.when(F.col("o_orderstatus") == "F", F.lit("Y_FIRST_TIME_RUN"))
                    .otherwise(F.lit("Y_D_OF_MONTH_RUN")).alias("done_yn"), "o_orderkey")
    return purge_record(rec, dt.date(1998, 10, 3)).select("o_orderkey", "done_yn")


def full_replace(spark: SparkSession, sf: str) -> DataFrame:
    # The sink itself, twice: the second write replaces the first one's version.
    o = table(spark, sf, "orders")
    path = _scratch(spark, "full-replace")
    sinks.full_replace(spark, o.where(F.col("o_orderstatus") == "F"), path)
    counts = sinks.full_replace(spark, o.where(F.col("o_orderstatus") == "O"), path)
    left = sinks.read_or_empty(spark, path, o.schema).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("rows_now"))
    return left.select(F.lit(counts["deleted_rows"]).cast("long").alias("deleted_rows"),
                       F.lit(counts["inserted_rows"]).cast("long").alias("inserted_rows"),
                       "o_orderstatus", "rows_now")


def run_log(spark: SparkSession, sf: str) -> DataFrame:
    # The jobs' own log row of a run over one key per customer.
    root = _scratch(spark, "run-log")
    message = result_message(False, dt.date(2000, 1, 1))
    jobs._log_run(spark, root, JOB_NAME, dt.datetime(2000, 1, 1), message, table(spark, sf, "customer").count())
    return sinks.read_or_empty(spark, f"{root}/run_log", S.RUN_LOG).select(
        "job", "result_msg", F.col("n_keys").alias("n_districts"), "done_yn")


QUERIES = {
    "li_items_from_html": li_items_from_html,
    "visible_text": visible_text,
    "min_cells": min_cells,
    "option_list": option_list,
    "sheet_slice": sheet_slice_q,
    "stage_date": stage_date,
    "period_filter": period_filter_q,
    "union_main_sub": union_main_sub_q,
    "pending_keys": pending_keys_q,
    "half_width": half_width_q,
    "clean_cell": clean_cell_q,
    "parking_mark": parking_mark_q,
    "type_map": type_map_q,
    "cells_to_columns": cells_to_columns_q,
    "result_total": result_total_q,
    "page_batches": page_batches_q,
    "page_gaps": page_gaps_q,
    "last_crawl": last_crawl_q,
    "city_squeeze": city_squeeze_q,
    "roc_split": roc_split_q,
    "year_month_calendar": year_month_calendar_q,
    "two_projections": two_projections,
    "audit_stamp": audit_stamp_q,
    "choose_main": choose_main_q,
    "distinct_keys": distinct_keys_q,
    "replace_by_key": replace_by_key_q,
    "metric_merge": metric_merge,
    "metric_merge_report": metric_merge_report,
    "renumber": renumber_q,
    "seed_if_empty": seed_if_empty_q,
    "integration_record": integration_record_q,
    "pending_range": pending_range_q,
    "carried_counts": carried_counts_q,
    "stored_keys": stored_keys,
    "drop_known": drop_known_q,
    "month_gaps": month_gaps_q,
    "replace_by_month": replace_by_month,
    "load_rejects": load_rejects,
    "pk_violations": pk_violations_q,
    "pk_keep_first": pk_keep_first,
    "mark_done": mark_done_q,
    "purge_record": purge_record_q,
    "full_replace": full_replace,
    "run_log": run_log,
}
