"""DuckDB oracle SQL for every registered query (tables are views named
after the parquet files).  ``BASE`` defines the two stand-ins: ``tx`` (listing
rows) and ``ck`` (check list).  Texts that start with WITH continue BASE's
WITH list; the others follow it."""

from __future__ import annotations

BASE = (
    "WITH tx AS (SELECT r_name AS city, n_name AS district, o_orderkey, o_totalprice, "
    "o_orderdate AS tx_date FROM orders JOIN customer ON o_custkey = c_custkey "
    "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey), "
    "ck AS (SELECT n_nationkey + 1 AS record_id, r_name AS city, n_name AS district, "
    "CASE WHEN n_nationkey < 10 THEN 'Y' END AS done_yn "
    "FROM nation JOIN region ON n_regionkey = r_regionkey)"
)

BODIES = {
    'metric_merge_report': (
        "WITH t AS (SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n FROM events "
        "WHERE event_type IN ('signup', 'error', 'click') GROUP BY 1, 2) "
        "SELECT hour, count(*) FILTER (WHERE event_type = 'signup') AS n_signup, "
        "count(*) FILTER (WHERE event_type = 'error') AS n_error, "
        "count(*) FILTER (WHERE event_type = 'click') AS n_click FROM t GROUP BY hour "
        "HAVING n_signup <> 1 OR n_error <> 1 OR n_click <> 1"
    ),
    'pk_keep_first': (
        "SELECT o_custkey, o_orderkey, o_totalprice FROM orders "
        "WHERE (o_custkey, o_orderkey) IN (SELECT o_custkey, min(o_orderkey) FROM orders GROUP BY 1)"
    ),
    'li_items_from_html': (
        'SELECT page_id, unnest(regexp_extract_all(html, \'<li><a href="([^"]*)">\', 1)) AS href '
        'FROM pages'
    ),
    'option_list': (
        'SELECT page_id, CAST(count(*) AS BIGINT) AS n_items FROM (SELECT page_id, '
        'unnest(regexp_extract_all(html, \'<li><a href="[^"]*">([^<]*)</a>\', 1)) AS label FROM '
        "pages) t WHERE label NOT IN ('para', 'no.') GROUP BY page_id"
    ),
    'result_total': (
        "SELECT city, district, CAST(replace(regexp_extract('查詢結果 : ' || format('{:,}', count(*)) "
        "|| ' 筆', '查詢結果\\s*[:：]\\s*([\\d,]+)\\s*筆', 1), ',', '') AS INTEGER) AS total_records FROM tx "
        'GROUP BY city, district'
    ),
    'half_width': (
        'SELECT p_partkey, p_brand AS brand FROM part'
    ),
    'clean_cell': (
        "SELECT p_partkey, coalesce(nullif(trim(CASE WHEN p_size % 5 = 0 THEN '  ' ELSE '  ' || "
        "p_name || ' ' END), ''), '無') AS community FROM part"
    ),
    'parking_mark': (
        'SELECT o_orderkey, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) || CASE WHEN '
        "o_orderstatus = 'P' THEN '車' ELSE '' END AS total_price_10k FROM orders"
    ),
    'type_map': (
        "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN '寓' WHEN '2-HIGH' THEN '透' "
        "WHEN '5-LOW' THEN '樓' ELSE '無' END AS type FROM orders"
    ),
    'roc_split': (
        'SELECT o_orderkey, CAST(substr(ym, 1, 3) AS INTEGER) AS roc_year, CAST(substr(ym, 4) AS '
        'INTEGER) AS roc_month, CAST(substr(ym, 1, 3) AS INTEGER) + 1911 AS ad_year FROM (SELECT '
        "o_orderkey, lpad(CAST(year(o_orderdate) - 1911 AS VARCHAR), 3, '0') || "
        "lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS ym FROM orders) t"
    ),
    'year_month_calendar': (
        'SELECT CAST(row_number() OVER (ORDER BY y, m) AS INTEGER) AS id, CAST(y AS VARCHAR) AS '
        'roc_year, CAST(m AS VARCHAR) AS roc_month FROM (SELECT DISTINCT year(o_orderdate) - 1911 '
        'AS y, month(o_orderdate) AS m FROM orders) o WHERE y BETWEEN 84 AND 89'
    ),
    'sheet_slice': (
        "WITH sheet AS (SELECT strftime(o_orderdate, '%Y%m') AS ym, CAST(count(*) AS BIGINT) AS n "
        "FROM orders GROUP BY 1) SELECT ym, n FROM sheet WHERE ym >= '199701'"
    ),
    'page_batches': (
        'SELECT city, district, CAST(row_number() OVER (PARTITION BY city, district ORDER BY b) '
        'AS INTEGER) AS batch_id, b AS begin_page_num, least(b + sz - 1, pages) AS end_page_num '
        'FROM (SELECT *, unnest(range(1, pages + 1, sz)) AS b FROM (SELECT *, CASE WHEN pages >= '
        '20 THEN 5 WHEN pages >= 10 THEN 3 ELSE 1 END AS sz FROM (SELECT city, district, '
        'CAST(ceil(count(*) / 15.0) AS BIGINT) AS pages FROM tx GROUP BY 1, 2) p) q) r'
    ),
    'page_gaps': (
        'WITH p AS (SELECT city, district, CAST(ceil(count(*) / 15.0) AS BIGINT) AS pages FROM tx '
        'GROUP BY 1, 2), z AS (SELECT *, CASE WHEN pages >= 20 THEN 5 WHEN pages >= 10 THEN 3 ELSE 1 '
        'END AS sz FROM p), have AS (SELECT DISTINCT t.city, t.district, o.o_orderkey % p.pages + 1 AS page '
        "FROM orders o JOIN tx t USING (o_orderkey) JOIN p USING (city, district) WHERE o.o_orderstatus = 'P' AND o.o_orderpriority = '1-URGENT'), "
        'miss AS (SELECT city, district, page, CAST((page - 1) // sz + 1 AS INTEGER) AS batch_id FROM '
        '(SELECT *, unnest(range(1, pages + 1)) AS page FROM z) a ANTI JOIN have USING (city, district, page)) '
        'SELECT city, district, batch_id, min(page) AS gap_begin, max(page) AS gap_end, count(*) AS n_pages '
        'FROM (SELECT *, page - row_number() OVER (PARTITION BY city, district, batch_id ORDER BY page) AS g '
        'FROM miss) m GROUP BY city, district, batch_id, g'
    ),
    'last_crawl': (
        'WITH s AS (SELECT user_id, event_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) '
        '>= INTERVAL 6 HOUR THEN 1 ELSE 0 END AS pause FROM events), '
        'n AS (SELECT *, sum(pause) OVER (PARTITION BY user_id ORDER BY ts) AS crawl, '
        'sum(pause) OVER (PARTITION BY user_id) AS last FROM s) '
        'SELECT user_id, event_id FROM n WHERE crawl = last'
    ),
    'carried_counts': (
        "SELECT city, district, count(*) AS n FROM tx WHERE tx_date < TIMESTAMP '2000-01-01' GROUP BY 1, 2"
    ),
    'stored_keys': (
        "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01' AND (o_custkey, o_orderpriority) IN "
        "(SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01')"
    ),
    'drop_known': (
        "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01' AND "
        "(l_partkey, l_suppkey, l_returnflag) NOT IN (SELECT l_partkey, l_suppkey, l_returnflag FROM lineitem "
        "WHERE l_shipdate < TIMESTAMP '1999-01-01')"
    ),
    'month_gaps': (
        "WITH o AS (SELECT DISTINCT (year(o_orderdate) - 1911) * 12 + month(o_orderdate) - 1 AS k FROM orders), "
        "l AS (SELECT DISTINCT (year(o_orderdate) - 1911) * 12 + month(o_orderdate) - 1 AS k FROM orders "
        "WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 490000), "
        "g AS (SELECT min(k) AS lo, max(k) AS hi FROM (SELECT k, k - row_number() OVER (ORDER BY k) AS i FROM o "
        "ANTI JOIN l USING (k)) m GROUP BY i) SELECT CAST(lo // 12 AS INTEGER) AS from_year, "
        "CAST(lo % 12 + 1 AS INTEGER) AS from_month, CAST(hi // 12 AS INTEGER) AS to_year, "
        "CAST(hi % 12 + 1 AS INTEGER) AS to_month, CAST(hi - lo + 1 AS INTEGER) AS n_months FROM g"
    ),
    'renumber': (
        'SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY city, district ORDER BY tx_date, '
        'o_orderkey) AS INTEGER) AS city_district_id FROM tx'
    ),
    'seed_if_empty': (
        "SELECT 'resumed' AS crawl, record_id, city, district FROM ck WHERE CASE WHEN (SELECT "
        "count(*) FROM ck WHERE done_yn = 'Y') = 0 THEN done_yn IS NULL ELSE done_yn = 'Y' END "
        "UNION ALL SELECT 'fresh', record_id, city, district FROM ck WHERE (SELECT count(*) FROM "
        'ck ANTI JOIN tx USING (city, district)) = 0 OR (city, district) NOT IN (SELECT city, '
        'district FROM tx)'
    ),
    'pending_keys': (
        'SELECT c.record_id, c.city, c.district FROM ck c WHERE c.done_yn IS NULL ORDER BY '
        'c.record_id'
    ),
    'pending_range': (
        "SELECT CAST(min(c_custkey) AS INTEGER) AS min_record_id, CAST(max(c_custkey) AS INTEGER) AS max_record_id, "
        "min_by(c_name, c_custkey) AS min_district, max_by(c_name, c_custkey) AS max_district FROM customer "
        "WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)"
    ),
    'mark_done': (
        "SELECT c.record_id, c.city, c.district, coalesce(n.cnt, 0) AS total_row_count, 'Y' AS "
        'done_yn FROM ck c LEFT JOIN (SELECT city, district, count(*) AS cnt FROM tx SEMI JOIN '
        '(SELECT * FROM ck WHERE done_yn IS NULL) p USING (city, district) GROUP BY 1, 2) n '
        'USING (city, district)'
    ),
    'union_main_sub': (
        "SELECT t.city, t.district, t.o_orderkey, t.src FROM (SELECT *, 'main' AS src FROM tx "
        "WHERE tx_date < TIMESTAMP '2000-01-01' UNION ALL SELECT *, 'sub' AS src FROM tx WHERE "
        "tx_date >= TIMESTAMP '1999-12-01') t SEMI JOIN (SELECT * FROM ck WHERE done_yn IS NULL) "
        'p USING (city, district)'
    ),
    'replace_by_key': (
        "WITH src AS (SELECT * FROM tx WHERE city = 'ASIA' AND tx_date >= TIMESTAMP "
        "'2000-01-01'), tgt AS (SELECT * FROM tx WHERE tx_date < TIMESTAMP '2000-01-01') SELECT "
        'city, district, o_orderkey FROM tgt ANTI JOIN (SELECT DISTINCT city, district FROM src) '
        'k USING (city, district) UNION ALL SELECT city, district, o_orderkey FROM src'
    ),
    'integration_record': (
        'SELECT c.city, c.district, coalesce(m.n, 0) AS main_table_row_count, coalesce(s.n, 0) AS '
        'sub_table_row_count, coalesce(m.n, 0) + coalesce(s.n, 0) AS total_row_count, '
        "'Y_20000101_D_OF_MONTH_RUN' AS done_yn FROM ck c LEFT JOIN (SELECT city, district, "
        "count(*) AS n FROM tx WHERE tx_date < TIMESTAMP '2000-01-01' GROUP BY 1, 2) m USING "
        '(city, district) LEFT JOIN (SELECT city, district, count(*) AS n FROM tx WHERE tx_date '
        ">= TIMESTAMP '2000-01-01' GROUP BY 1, 2) s USING (city, district)"
    ),
    'purge_record': (
        'WITH rec AS (SELECT CAST(o_orderdate AS DATE) AS exec_date, CASE WHEN o_orderstatus = '
        "'F' THEN 'Y_FIRST_TIME_RUN' ELSE 'Y_D_OF_MONTH_RUN' END AS done_yn, o_orderkey FROM "
        "orders) SELECT o_orderkey, done_yn FROM rec WHERE NOT (exec_date = DATE '1998-10-03' AND "
        "done_yn <> 'Y_FIRST_TIME_RUN')"
    ),
    'metric_merge': (
        'WITH d AS (SELECT CAST(ts AS DATE) AS day, event_type, value FROM events), a AS (SELECT '
        "day, count(*) AS n_in FROM d WHERE event_type = 'signup' GROUP BY 1), b AS (SELECT day, "
        "count(*) AS n_out FROM d WHERE event_type = 'error' GROUP BY 1), c AS (SELECT day, "
        "count(*) AS n_net FROM d WHERE event_type = 'click' GROUP BY 1) SELECT day, n_in, n_out, "
        'n_net FROM a FULL JOIN b USING (day) FULL JOIN c USING (day)'
    ),
    'replace_by_month': (
        "WITH tgt AS (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, o_orderkey, 'old' "
        "AS src FROM orders), src AS (SELECT * REPLACE ('new' AS src) FROM tgt WHERE y = 1998 AND "
        'm = 10) SELECT y, m, src, count(*) AS n FROM (SELECT * FROM tgt ANTI JOIN (SELECT '
        'DISTINCT y, m FROM src) k USING (y, m) UNION ALL SELECT * FROM src) t GROUP BY 1, 2, 3'
    ),
    'load_rejects': (
        "SELECT p_partkey, length(p_name) AS len, CASE WHEN length(p_name) > 10 THEN 'TOO_LONG' "
        "ELSE 'OK' END AS verdict FROM part"
    ),
    'pk_violations': (
        'SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING '
        'count(*) > 1'
    ),
    'period_filter': (
        'SELECT o_orderkey FROM orders WHERE year(o_orderdate) * 100 + month(o_orderdate) BETWEEN '
        "199701 AND 200010 AND o_orderstatus IN ('F', 'O')"
    ),
    'stage_date': (
        "SELECT strftime(o_orderdate, '%Y%m%d') AS stage_date, count(*) AS n FROM orders GROUP BY "
        '1'
    ),
    'visible_text': (
        "SELECT page_id, coalesce(nullif(trim(replace(array_to_string(regexp_extract_all(html, "
        "'<h1>([^<]*)</h1>', 1), chr(10)), '&amp;', '&')), ''), '無') AS h1 FROM pages"
    ),
    'min_cells': (
        "SELECT doc_id, replace(regexp_replace(w[1], '^\\s+|\\s+$', '', 'g'), ' ', '') AS city_district_name, coalesce(nullif(regexp_replace(w[2], '^\\s+|\\s+$', '', 'g'), ''), '無') AS male, "
        "coalesce(nullif(regexp_replace(w[3], '^\\s+|\\s+$', '', 'g'), ''), '無') AS female FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents) d "
        "WHERE len(w) >= 3"
    ),
    'cells_to_columns': (
        "SELECT p_partkey, 19 AS n_cells, "
        "p_brand || '-0' AS address, "
        "p_brand || '-1' AS community, "
        "CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) || CASE WHEN p_size % 2 = 0 THEN '車' ELSE '' END AS total_price_10k, "
        "p_brand || '-3' AS transaction_date, "
        "p_brand || '-4' AS unit_price, "
        "p_brand || '-5' AS total_tsubo, "
        "p_brand || '-6' AS real_space_percent, "
        "CASE WHEN p_size % 3 = 0 THEN '寓' ELSE p_brand || '-7' END AS type, "
        "p_brand || '-8' AS house_age, "
        "CASE WHEN p_size % 5 = 0 THEN '無' ELSE p_brand || '-9' END AS level, "
        "p_brand || '-10' AS main_purpose, "
        "replace(p_name, ' ', '') AS transaction_target, "
        "p_brand || '-12' AS building_structure, "
        "p_brand || '-13' AS car_parking_price_10k, "
        "p_brand || '-14' AS manage_unit_yn, "
        "p_brand || '-15' AS elevator_yn, "
        "p_brand || '-18' AS note FROM part"
    ),
    'city_squeeze': (
        "SELECT c_custkey, replace(trim(c_mktsegment || ' ' || c_name || ' '), ' ', '') AS city "
        'FROM customer'
    ),
    'two_projections': (
        "WITH m AS (SELECT year(o_orderdate) - 1911 AS y, month(o_orderdate) AS mo, count(*) AS n FROM orders GROUP BY 1, 2) "
        "SELECT 'consumer' AS sheet, CAST(y AS INTEGER) AS roc_year, CAST(mo AS INTEGER) AS roc_month, "
        "CAST(y + 1911 AS INTEGER) AS ad_year, CAST(mo AS INTEGER) AS ad_month, "
        "concat_ws('|', n, n * 2, n * 3, n * 4, n * 5, n * 6, n * 7) AS amounts FROM m UNION ALL "
        "SELECT 'construction', CAST(y AS INTEGER), CAST(mo AS INTEGER), CAST(y + 1911 AS INTEGER), CAST(mo AS INTEGER), "
        "CAST(n * 8 AS VARCHAR) FROM m"
    ),
    'audit_stamp': (
        "SELECT s_suppkey, TIMESTAMP '2025-08-14 00:00:00' AS update_time, 'integrate' AS "
        'update_by FROM supplier'
    ),
    'distinct_keys': (
        'SELECT DISTINCT city, district FROM tx'
    ),
    'choose_main': (
        "SELECT 'first' AS run, city, district, o_orderkey FROM tx UNION ALL SELECT 'daily', city, "
        'district, o_orderkey FROM tx'
    ),
    'full_replace': (
        "SELECT (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS deleted_rows, count(*) AS "
        "inserted_rows, o_orderstatus, count(*) AS rows_now FROM orders WHERE o_orderstatus = 'O' GROUP BY 3"
    ),
    'run_log': (
        "SELECT 'integrate' AS job, 'DAILY_BY_MONTH_20000101_DONE' AS result_msg, count(*) AS "
        "n_districts, 'Y' AS done_yn FROM customer"
    ),
}


def full_sql(name: str) -> str:
    body = BODIES[name]
    if body.upper().startswith("WITH "):
        return BASE + ", " + body[5:]
    return BASE + " " + body


ORACLE_SQL = {name: full_sql(name) for name in BODIES}
