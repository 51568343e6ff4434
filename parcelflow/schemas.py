"""Declared schemas of the ledger tables (no inference anywhere)."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L = T.StringType(), T.IntegerType(), T.LongType()
TS, D, B = T.TimestampNTZType(), T.DateType(), T.BooleanType()

KEYS = ["city_name", "district_name"]

# The 17 business columns of a listing row, in page order (cells 0-15 and 18).
BUSINESS = [
    "address", "community", "total_price_10k", "transaction_date", "unit_price",
    "total_tsubo", "real_space_percent", "type", "house_age", "level",
    "main_purpose", "transaction_target", "building_structure",
    "car_parking_price_10k", "manage_unit_yn", "elevator_yn", "note",
]
# Cell index for each business column (fixed values: position 16 and 17 are unused).
CELL_INDEX = dict(zip(BUSINESS, list(range(16)) + [18]))

# Maximum text lengths of the target tables (fixed values).
MAX_LEN = {"city_name": 100, "district_name": 100, "address": 100,
           **{c: 500 for c in BUSINESS if c != "address"}}
MIGRATION_MAX_LEN = 10

LEDGER_COLUMNS = KEYS + BUSINESS  # the 19 integrated columns

def _fields(*pairs, nullable=True):
    return [T.StructField(n, t, nullable) for n, t in pairs]

STAGE = T.StructType(_fields(
    ("city_district_id", I), ("batch_id", I), ("page", I),
    *[(k, S) for k in KEYS], *[(c, S) for c in BUSINESS],
    ("scraped_time", TS), ("stage_date", D)))

# Landed stage rows; a crawl spread over several files names itself in crawl_id.
FEED = T.StructType([*STAGE.fields, T.StructField("crawl_id", S)])
FEED_ROWS = T.StructType([*FEED.fields, *_fields(("landed", TS), ("feed", S), ("feed_batch", L))])

# Page ranges of a crawl, and those of them that its loads did not bring.
CRAWL_PLAN = T.StructType(_fields(
    *[(k, S) for k in KEYS], ("total_records", I), ("batch_id", I),
    ("begin_page_num", L), ("end_page_num", L), ("stage_date", D)))
CRAWL_GAPS = T.StructType(_fields(
    *[(k, S) for k in KEYS], ("batch_id", I), ("gap_begin", L), ("gap_end", L),
    ("n_pages", L), ("stage_date", D)))

LOAD_RECORD = T.StructType(_fields(
    *[(k, S) for k in KEYS], ("good_rows", L), ("bad_rows", L), ("missing_pages", L),
    ("scraped_time", TS), ("stage_date", D)))

# Bloom filters of landed keys (parcelflow.operators.keys).
KEY_FILTER = T.StructType(_fields(("blocks", L), ("block", L), ("bits", T.BinaryType()),
                                  ("stage_date", D), ("feed", S), ("feed_batch", L)))
STAGE_PK = ["city_district_id", *KEYS, "address", "scraped_time"]

CHECK_LIST = T.StructType(_fields(
    ("record_id", I), ("city_name", S), ("district_name", S),
    ("establish_time", TS), ("scraped_time", TS), ("total_row_count", L),
    ("done_yn", S), ("stage_date", D)))

LEDGER = T.StructType(_fields(
    *[(c, S) for c in BUSINESS], ("update_time", TS), ("update_by", S),
    ("fingerprint", T.BinaryType()), *[(k, S) for k in KEYS], ("stage_date", D)))

LEDGER_RECORD = T.StructType(_fields(
    ("main_table", S), ("main_table_city_name", S), ("main_table_district_name", S),
    ("main_table_row_count", L), ("sub_table", S), ("sub_table_city_name", S),
    ("sub_table_district_name", S), ("sub_table_row_count", L),
    ("total_row_count", L), ("done_yn", S), ("update_time", TS), ("update_by", S),
    ("written_time", TS), ("exec_date", D)))

RUN_LOG = T.StructType(_fields(
    ("job", S), ("data_dt", TS), ("done_yn", S), ("result_msg", S),
    ("n_keys", L), ("create_dt", TS), ("create_by", S)))

ERROR_LOG = T.StructType(_fields(
    ("job", S), ("data_dt", TS), ("text", S), ("err_msg", S),
    ("create_dt", TS), ("create_by", S)))

MIGRATION_VALUES = ["m_move_in", "f_move_in", "m_move_out", "f_move_out",
                    "m_net_migration", "f_net_migration"]
MIGRATION = T.StructType(_fields(
    ("id", I), ("city_district_name", S), *[(c, S) for c in MIGRATION_VALUES],
    ("create_time", TS), ("create_by", S), ("update_time", TS), ("update_by", S),
    ("roc_year", S), ("roc_month", S)))

CALENDAR = T.StructType(_fields(("id", I), ("roc_year", S), ("roc_month", S)))
MIGRATION_GAPS = T.StructType(_fields(
    ("from_year", I), ("from_month", I), ("to_year", I), ("to_month", I), ("n_months", I)))

CONSUMER_LOAN_VALUES = ["consumer_total_sum", "house_loan", "house_repair_loan",
                        "car_loan", "employee_welfare_loan",
                        "individual_consumption_loan", "credit_card_loan"]
CONSUMER_LOANS = T.StructType(_fields(
    ("roc_year", I), ("roc_month", I), ("ad_year", I), ("ad_month", I),
    *[(c, S) for c in CONSUMER_LOAN_VALUES], ("update_by", S), ("update_time", TS)))
CONSTRUCTION_LOANS = T.StructType(_fields(
    ("roc_year", I), ("roc_month", I), ("ad_year", I), ("ad_month", I),
    ("construction_loan", S), ("update_by", S), ("update_time", TS)))

REJECTS = T.StructType(_fields(
    ("source", S), ("key", S), ("reason", S), ("row_json", S), ("stage_date", D)))

# Input fixtures (FIXTURES.md section 1).
LISTING_PAGES = T.StructType(_fields(
    ("page_id", L), ("city_name", S), ("district_name", S), ("batch_id", I),
    ("page", I), ("html", S)))
REGION_OPTIONS = T.StructType(_fields(
    ("city_pos", I), ("district_pos", I), ("city", S), ("district", S)))
LOAN_SHEET = T.StructType(_fields(("row_no", L), *[(f"c{i}", S) for i in range(9)]))
MONTHS_OFFERED = T.StructType(_fields(("roc_year", S), ("roc_month", S)))
