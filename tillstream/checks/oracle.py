"""What each registered query must return, as SQL over the raw test tables."""

from __future__ import annotations

from tillstream.checks.fixtures import AS_OF, BATCH_FROM, DAY
from tillstream.checks.queries import GROUP, POINT_ID, TERM

LOGS = """
logs AS (
  SELECT event_id, CAST(event_id % 3 AS INTEGER) AS "partition", event_id // 3 AS "offset",
         'mid_' || user_id AS mid, CAST(user_id AS VARCHAR) AS uid, 'ar_' || (user_id % 34) AS ar,
         'ch_' || (event_id % 4) AS ch, 'v1.' || (user_id % 3) AS vc,
         epoch_us(ts) // 1000 AS ts, strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr,
         event_type = 'view' AS is_start
  FROM events),
lines AS (
  SELECT *, '{"ts":' || ts || ',"common":{"mid":"' || mid || '","uid":"' || uid || '","ar":"' || ar ||
            '","ch":"' || ch || '","vc":"' || vc || '"}' ||
            CASE WHEN is_start THEN ',"start":{"entry":"icon"}' ELSE '' END || '}' AS value
  FROM logs)"""

FIRST_OPENS = LOGS + """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY is_start, dt, mid ORDER BY ts, "partition", "offset") AS nth FROM logs),
opens AS (SELECT mid, uid, ar, ch, vc, dt, hr, '00' AS mi, ts FROM ranked WHERE is_start AND nth = 1)"""

ORDERS = f"""
facts AS (
  SELECT o_orderkey AS id, o_custkey % 25 AS province_id, o_orderstatus AS order_status, o_custkey AS user_id,
         o_totalprice AS final_total_amount, CAST(0 AS DOUBLE) AS benefit_reduce_amount,
         o_totalprice AS original_total_amount, CAST(0 AS DOUBLE) AS feight_fee,
         CAST(NULL AS VARCHAR) AS expire_time,
         strftime(o_orderdate, '%Y-%m-%d') || ' ' || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':00:00' AS create_time,
         CAST(NULL AS VARCHAR) AS operate_time,
         strftime(o_orderdate, '%Y-%m-%d') AS create_date, lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') AS create_hour,
         o_orderdate >= DATE '{BATCH_FROM}' AS in_batch
  FROM orders),
batch AS (SELECT * FROM facts WHERE in_batch),
status AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id, '1' AS if_consumed, min(id) AS first_order_id
  FROM facts WHERE NOT in_batch GROUP BY 1),
flagged AS (
  SELECT b.*,
         CASE WHEN s.user_id IS NULL
               AND row_number() OVER (PARTITION BY b.user_id ORDER BY b.create_time, b.id) = 1
              THEN '1' ELSE '0' END AS if_first_order
  FROM batch b LEFT JOIN status s ON s.user_id = CAST(b.user_id AS VARCHAR)),
provinces AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, CAST(n_regionkey AS VARCHAR) AS area_code,
         'CN-' || n_nationkey AS iso_code
  FROM nation WHERE n_regionkey <> 3)"""

USERS = f"""
born AS (
  SELECT c_custkey, c_mktsegment, DATE '1965-01-01' + CAST((c_custkey * 137) % 16000 AS INTEGER) AS birthday
  FROM customer),
aged AS (
  SELECT *, (epoch_us(TIMESTAMP '{AS_OF}') // 1000 - epoch_us(CAST(birthday AS TIMESTAMP)) // 1000) // 31536000000 AS age
  FROM born),
users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS user_level, strftime(birthday, '%Y-%m-%d') AS birthday,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender, age,
         CASE WHEN age < 20 THEN '20岁及以下' WHEN age > 30 THEN '30岁及以上' ELSE '在20岁和30岁之间' END AS age_group,
         CASE WHEN c_custkey % 2 = 0 THEN '男' ELSE '女' END AS gender_name
  FROM aged)"""

DOCS = """
docs AS (
  SELECT p_partkey AS id, p_name AS name, p_retailprice AS "doubanScore",
         [p_brand, p_type] AS actors, regexp_extract_all(lower(p_name), '[a-z0-9]+') AS words
  FROM part)"""

RANGES = """
ranges AS (
  SELECT 'app_log' AS topic, "partition", min("offset") AS from_offset, max("offset") + 1 AS until_offset
  FROM logs GROUP BY 2),
ledger AS (
  SELECT "partition", max("offset") + 1 AS until_offset FROM logs WHERE dt < '%s' GROUP BY 1)""" % DAY

ORDER_COLUMNS = """id, province_id, order_status, user_id, final_total_amount, benefit_reduce_amount,
 original_total_amount, feight_fee, expire_time, create_time, operate_time"""

PROVINCE_JOIN = f"""WITH {ORDERS}
SELECT b.id, b.province_id, p.name AS province_name, p.area_code AS province_area_code, p.iso_code AS province_iso_code
FROM facts b LEFT JOIN provinces p ON p.id = CAST(b.province_id AS VARCHAR)"""

ORDER_WIDE = f"""WITH {ORDERS}, {USERS}
SELECT f.id, f.province_id, f.order_status, f.user_id, f.final_total_amount, f.benefit_reduce_amount,
       f.original_total_amount, f.feight_fee, f.expire_time, f.create_time, f.operate_time,
       f.create_date, f.create_hour, f.if_first_order,
       p.name AS province_name, p.area_code AS province_area_code, p.iso_code AS province_iso_code,
       u.age_group AS user_age_group, u.gender_name AS user_gender
FROM flagged f
LEFT JOIN provinces p ON p.id = CAST(f.province_id AS VARCHAR)
LEFT JOIN users u ON u.id = CAST(f.user_id AS VARCHAR)"""

CANAL = f"""WITH {ORDERS}
SELECT 'ods_order_info' AS topic, id * 4 + i AS id, user_id, final_total_amount, create_time
FROM facts, LATERAL (SELECT unnest(range(0, id % 3 + 1)) AS i) WHERE order_status = 'F'"""


MAXWELL = """
SELECT 'ods_order_info' AS topic, CAST(o_orderkey AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS name,
       CAST(NULL AS VARCHAR) AS user_level, o_totalprice AS final_total_amount
FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'
UNION ALL SELECT 'ods_user_info', CAST(c_custkey AS VARCHAR), NULL, c_mktsegment, NULL FROM customer WHERE c_acctbal >= 0
UNION ALL SELECT 'ods_base_province', CAST(n_nationkey AS VARCHAR), n_name, NULL, NULL FROM nation WHERE n_regionkey <> 4
UNION ALL SELECT 'ods_sku_info', CAST(p_partkey AS VARCHAR), p_name, NULL, NULL FROM part WHERE p_size <= 45"""

DAY_OVER_DAY = f"""WITH {FIRST_OPENS},
today AS (SELECT hr, count(*) AS n FROM opens WHERE dt = '{DAY}' GROUP BY hr),
yesterday AS (SELECT hr, count(*) AS n FROM opens WHERE dt = strftime(DATE '{DAY}' - 1, '%Y-%m-%d') GROUP BY hr)
SELECT coalesce(t.hr, y.hr) AS hr, t.n AS today, y.n AS yesterday FROM today t FULL OUTER JOIN yesterday y ON t.hr = y.hr"""

HIGHLIGHT = r"regexp_replace(name, '\b(red|widget)\b', '<em>\1</em>', 'gi') AS highlight"

ORACLE: dict[str, str] = {
    "source_topic": f"""WITH {LOGS} SELECT 'app_log' AS topic, "partition", "offset", value FROM lines""",
    "source_lookup_sql": f"""WITH {ORDERS}
        SELECT '{{"user_id":"' || user_id || '","if_consumed":"' || if_consumed || '"}}' AS row_json
        FROM status WHERE user_id IN (SELECT CAST(user_id AS VARCHAR) FROM batch)""",
    "source_point_get": f"""WITH {DOCS} SELECT id, name, "doubanScore" FROM docs WHERE id = {POINT_ID}""",
    "sink_topic": f"""WITH {LOGS}
        SELECT CASE WHEN is_start THEN 'log_start' ELSE 'log_event' END AS topic, "partition", "offset", value FROM lines""",
    "sink_upsert_table": """
        SELECT CAST(c_custkey AS VARCHAR) AS id,
               CASE WHEN c_acctbal > 5000 THEN c_mktsegment || '_2' ELSE c_mktsegment END AS user_level
        FROM customer""",
    "sink_index_bulk": f"""WITH {FIRST_OPENS},
        written AS (SELECT *, row_number() OVER (PARTITION BY dt, mid ORDER BY is_start) AS pick FROM ranked WHERE nth = 1)
        SELECT mid, uid, ar, ch, vc, dt, hr, '00' AS mi, ts FROM written WHERE pick = 1""",
    "sink_write_count": "SELECT count(*) AS n_written FROM events",
    "sink_log_landing": f"WITH {LOGS} SELECT dt, value FROM lines",
    "offsets_range": f"""WITH {LOGS}, {RANGES} SELECT topic, "partition", from_offset, until_offset FROM ranges""",
    "offsets_save": f"""WITH {LOGS}, {RANGES}
        SELECT 'app_log' AS topic, '{GROUP}' AS "group", r."partition", r.until_offset FROM ranges r
        UNION ALL SELECT 'app_log', 'other', "partition", until_offset FROM ledger""",
    "offsets_read": f"""WITH {LOGS}, {RANGES}
        SELECT l."partition", l."offset", l.value
        FROM lines l LEFT JOIN ledger g ON g."partition" = l."partition"
        WHERE l."offset" >= coalesce(g.until_offset, 0)""",
    "parse_json_dynamic": f"""WITH {LOGS}
        SELECT "partition", "offset", ts, mid, uid, ar, ch, vc, is_start FROM logs""",
    "parse_json_typed": f"WITH {ORDERS} SELECT {ORDER_COLUMNS} FROM facts",
    "derive_dt_hr": f"""WITH {LOGS} SELECT "partition", "offset", ts, dt, hr FROM logs""",
    "derive_create_date_hour": f"WITH {ORDERS} SELECT id, create_date, create_hour FROM facts",
    "dau_record": f"WITH {LOGS} SELECT mid, uid, ar, ch, vc, dt, hr, '00' AS mi, ts FROM logs WHERE is_start",
    "user_age": f"WITH {USERS} SELECT id, age FROM users",
    "user_age_group": f"WITH {USERS} SELECT id, age_group FROM users",
    "user_gender_name": f"WITH {USERS} SELECT id, gender_name FROM users",
    "previous_day": """
        SELECT event_id, strftime(ts, '%Y-%m-%d') AS dt, strftime(CAST(ts AS DATE) - 1, '%Y-%m-%d') AS previous_dt
        FROM events""",
    "route_app_log": f"""WITH {LOGS}
        SELECT CASE WHEN is_start THEN 'log_start' ELSE 'log_event' END AS topic, "partition", "offset", value FROM lines""",
    "cdc_canal_route": CANAL,
    "cdc_maxwell_route": MAXWELL,
    "in_list_lookup": f"""WITH {ORDERS}
        SELECT user_id, if_consumed, first_order_id FROM status
        WHERE user_id IN (SELECT CAST(user_id AS VARCHAR) FROM batch)""",
    "filter_first_orders": f"""WITH {ORDERS}
        SELECT CAST(user_id AS VARCHAR) AS user_id, '1' AS if_consumed, id AS first_order_id
        FROM flagged WHERE if_first_order = '1'""",
    "doc_match": f"WITH {DOCS} SELECT id, name FROM docs WHERE list_has_any(words, ['red', 'widget'])",
    "doc_match_indexed": f"WITH {DOCS} SELECT id, name FROM docs WHERE list_has_any(words, ['red', 'widget'])",
    "doc_term_nested": f"WITH {DOCS} SELECT id, name FROM docs WHERE list_contains(actors, '{TERM}')",
    "join_order_user_status": f"""WITH {ORDERS}
        SELECT b.id, b.user_id, CASE WHEN s.user_id IS NULL THEN '1' ELSE '0' END AS if_first_order
        FROM batch b LEFT JOIN status s ON s.user_id = CAST(b.user_id AS VARCHAR)""",
    "join_order_province": PROVINCE_JOIN,
    "join_order_province_bcast": PROVINCE_JOIN,
    "join_order_user": f"""WITH {ORDERS}, {USERS}
        SELECT b.id, b.user_id, u.age_group AS user_age_group, u.gender_name AS user_gender
        FROM facts b LEFT JOIN users u ON u.id = CAST(b.user_id AS VARCHAR)""",
    "join_day_over_day": DAY_OVER_DAY,
    "dau_total": f"WITH {FIRST_OPENS} SELECT count(*) AS total FROM opens WHERE dt = '{DAY}'",
    "dau_by_hour": f"WITH {FIRST_OPENS} SELECT dt, hr, count(*) AS n FROM opens GROUP BY dt, hr",
    "realtime_totals": f"""WITH {FIRST_OPENS},
        seen AS (SELECT mid, min(dt) AS first_dt FROM opens GROUP BY mid)
        SELECT 'dau' AS id, '新增日活' AS name, count(*) AS value FROM opens WHERE dt = '{DAY}'
        UNION ALL SELECT 'new_mid', '新增设备', count(*) FROM seen WHERE first_dt = '{DAY}'""",
    "group_orders_by_user": f"""WITH {ORDERS}
        SELECT user_id, 0 AS part, count(*) AS n_orders,
               string_agg(CAST(id AS VARCHAR), ',' ORDER BY create_time, id) AS order_ids
        FROM facts GROUP BY user_id""",
    "sink_preview": f"""WITH {ORDERS}
        SELECT {ORDER_COLUMNS}, create_date, create_hour FROM facts ORDER BY create_time, id LIMIT 1000""",
    "doc_top_n": f"""WITH {DOCS} SELECT id, name, "doubanScore" FROM docs ORDER BY "doubanScore" DESC, id LIMIT 10""",
    "doc_highlight": f"WITH {DOCS} SELECT id, name, {HIGHLIGHT} FROM docs WHERE list_has_any(words, ['red', 'widget'])",
    "doc_search": f"""WITH {DOCS} SELECT id, name, "doubanScore", {HIGHLIGHT} FROM docs
        WHERE list_has_any(words, ['red', 'widget']) AND list_contains(actors, '{TERM}')
        ORDER BY "doubanScore" DESC, id LIMIT 10""",
    "dau_first_open": f"WITH {FIRST_OPENS} SELECT * FROM opens",
    "order_first_flag": f"WITH {ORDERS} SELECT id, user_id, create_time, if_first_order FROM flagged",
    "pipeline_order_wide": ORDER_WIDE,
    "start_dau": f"""WITH {FIRST_OPENS}
        SELECT *, min(dt) OVER (PARTITION BY mid) AS first_dt FROM opens""",
    "start_offsets": f"""WITH {LOGS}, {RANGES}
        SELECT topic, '{GROUP}' AS "group", "partition", until_offset FROM ranges""",
    "start_hourly": f"WITH {FIRST_OPENS} SELECT dt, hr, count(*) AS n FROM opens GROUP BY dt, hr",
    "start_cdc_canal": CANAL,
    "start_cdc_maxwell": MAXWELL,
    "start_dim_province": f"WITH {ORDERS} SELECT * FROM provinces",
    "start_dim_user": f"WITH {USERS} SELECT id, user_level, birthday, gender, age_group, gender_name FROM users",
    "start_order_wide": ORDER_WIDE,
}
