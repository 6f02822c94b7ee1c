"""The registered queries as plain SQL over the same tables.

Written independently of the operators: window functions and direct joins
instead of the operators' aggregates, slots and prepared lookups.
"""

from __future__ import annotations

import re

from tidemart.sources.driver_tables import HAN, LATIN

VIEWS = {
    "base_log": """
        SELECT 'mid_' || user_id AS mid, CAST(user_id % 3 AS VARCHAR) AS vc, CAST(user_id % 5 AS VARCHAR) AS ch,
               CAST(user_id % 34 AS VARCHAR) AS ar, CASE WHEN event_type = 'signup' THEN '1' ELSE '0' END AS is_new,
               CAST(user_id % 7 AS VARCHAR) AS area_code,
               CASE WHEN event_type = 'purchase' THEN 'good_detail' WHEN event_type <> 'error' THEN event_type END AS page_id,
               CASE WHEN event_type = 'click' THEN 'search' WHEN event_type NOT IN ('view', 'error') THEN 'home' END AS last_page_id,
               CASE WHEN event_type <> 'error' THEN CAST(k + 1 AS VARCHAR) END AS item,
               CASE WHEN event_type <> 'error' THEN 'sku_id' END AS item_type,
               CASE WHEN event_type <> 'error' THEN CAST(floor(value * 1000) AS BIGINT) END AS during_time,
               event_type = 'error' AS is_start, k, ts
        FROM (SELECT user_id, event_type, value, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k,
                     epoch_us(ts) // 1000 AS ts FROM events)""",
    "page_log": "SELECT * FROM base_log WHERE NOT is_start",
    "fixed_log": """
        SELECT * EXCLUDE (is_new), CAST(substr(mid, 5) AS BIGINT) AS user_id, CAST(ts % 1000 AS VARCHAR) AS action,
               CASE WHEN ts % 5 = 0 THEN CAST(ts % 7 AS VARCHAR) END AS err,
               CASE WHEN is_new = '1' AND row_number() OVER (PARTITION BY mid, is_new ORDER BY ts) > 1 THEN '0' ELSE is_new END AS is_new
        FROM base_log WHERE ts % 97 <> 0""",
    "display_log": """
        SELECT CAST(k + 1 + i AS VARCHAR) AS item, CASE WHEN i % 2 = 0 THEN 'sku_id' ELSE 'activity_id' END AS item_type,
               mid, page_id, ts FROM page_log, (VALUES (0), (1), (2)) AS n(i) WHERE i < k % 4""",
    "uv": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mid, ts // 86400000 ORDER BY ts) AS rn
                       FROM page_log WHERE last_page_id IS NULL) WHERE rn = 1""",
    "next_page": """
        SELECT *, lead(ts) OVER w AS next_ts, lead(last_page_id) OVER w IS NULL AS next_entry
        FROM page_log WINDOW w AS (PARTITION BY mid ORDER BY ts)""",
    "jump_10s": """
        SELECT * FROM next_page WHERE last_page_id IS NULL
        AND (next_ts IS NULL OR next_ts - ts >= 10000 OR next_entry)""",
    "jump_6h": """
        SELECT *, CASE WHEN next_ts - ts < 21600000 THEN 'matched' ELSE 'timeout' END AS kind
        FROM next_page WHERE last_page_id IS NULL AND (next_ts IS NULL OR next_ts - ts >= 21600000 OR next_entry)""",
    "visitor_rows_10s": """
        SELECT ar, ch, is_new, vc, 0 AS uv_ct, 1 AS pv_ct, CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END AS sv_ct,
               0 AS uj_ct, during_time AS dur_sum, ts FROM page_log
        UNION ALL SELECT ar, ch, is_new, vc, 1, 0, 0, 0, 0, ts FROM uv
        UNION ALL SELECT ar, ch, is_new, vc, 0, 0, 0, 1, 0, ts FROM jump_10s""",
    "visitor_rows_6h": """
        SELECT ar, ch, is_new, vc, 0 AS uv_ct, 1 AS pv_ct, CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END AS sv_ct,
               0 AS uj_ct, during_time AS dur_sum, ts FROM page_log
        UNION ALL SELECT ar, ch, is_new, vc, 1, 0, 0, 0, 0, ts FROM uv
        UNION ALL SELECT ar, ch, is_new, vc, 0, 0, 0, 1, 0, ts FROM jump_6h""",
    "order_info": """
        SELECT o_orderkey AS id, CAST(o_totalprice AS DECIMAL(16,2)) AS total_amount, o_orderstatus AS order_status,
               o_custkey AS user_id, CAST(c_nationkey AS BIGINT) AS province_id,
               epoch_us(o_orderdate) // 1000 + (o_orderkey % 86400) * 1000 AS create_time
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "order_detail": """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS sku_id,
               CAST(l_extendedprice AS DECIMAL(16,2)) AS order_price, CAST(l_quantity AS BIGINT) AS sku_num,
               CAST(l_extendedprice AS DECIMAL(16,2)) AS split_total_amount,
               CAST(l_discount AS DECIMAL(16,2)) AS split_activity_amount, CAST(l_tax AS DECIMAL(16,2)) AS split_coupon_amount,
               l_returnflag AS source_type, epoch_us(l_shipdate) // 1000 AS create_time
        FROM lineitem""",
    "payment_info": """
        SELECT o_orderkey + 1000000 AS id, o_orderkey AS order_id, o_orderpriority AS payment_type,
               'order ' || o_orderkey AS subject,
               epoch_us(o_orderdate) // 1000 + (o_orderkey % 86400) * 1000 + (o_orderkey % 1200) * 1000 AS create_time
        FROM orders WHERE o_orderstatus = 'F'""",
    "order_wide": """
        SELECT d.order_id, d.id AS detail_id, d.sku_id, o.user_id, o.province_id, o.order_status, o.total_amount,
               d.order_price, d.sku_num, d.split_total_amount, d.split_activity_amount, d.split_coupon_amount,
               d.source_type, o.create_time, d.create_time AS detail_time
        FROM order_info o JOIN order_detail d ON o.id = d.order_id
        AND d.create_time BETWEEN o.create_time - 2592000000 AND o.create_time + 2592000000""",
    "dim_user": """
        SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender
        FROM customer WHERE c_custkey % 10 <> 0""",
    "dim_sku": """
        SELECT p_partkey AS id, p_name AS sku_name, CAST(p_retailprice AS DECIMAL(16,2)) AS price,
               CAST('0x' || substr(md5(p_name), 1, 12) AS BIGINT) AS spu_id,
               CAST(regexp_extract(p_brand, '[0-9]+') AS BIGINT) AS tm_id,
               CAST(ascii(p_type) * 100 + length(p_type) AS BIGINT) AS category3_id,
               p_name AS spu_name, p_brand AS tm_name, p_type AS category3_name
        FROM part WHERE p_partkey % 10 <> 0""",
    "dim_province": """
        SELECT n_nationkey AS id, CAST(n_regionkey AS VARCHAR) AS area_code, n_name AS iso_code,
               'N-' || n_nationkey AS iso_3166_2 FROM nation""",
    "order_wide_full": """
        SELECT w.*, p.area_code AS province_area_code, p.iso_code AS province_iso_code,
               p.iso_3166_2 AS province_3166_2_code, u.gender AS user_gender, s.spu_id, s.tm_id, s.category3_id,
               s.spu_name, s.tm_name, s.category3_name
        FROM order_wide w LEFT JOIN dim_user u ON w.user_id = u.id LEFT JOIN dim_sku s ON w.sku_id = s.id
        LEFT JOIN dim_province p ON w.province_id = p.id""",
    "payment_wide": """
        SELECT p.id AS payment_id, p.subject, p.payment_type, p.create_time AS payment_create_time, w.detail_id,
               w.order_id, w.sku_id, w.user_id, w.total_amount, w.split_total_amount,
               w.create_time AS order_create_time, w.user_gender, w.tm_name
        FROM payment_info p JOIN order_wide_full w ON p.order_id = w.order_id
        AND w.create_time BETWEEN p.create_time - 900000 AND p.create_time + 5000""",
    "product_rows": """
        SELECT CAST(item AS BIGINT) AS sku_id, 0 AS display_ct, 1 AS click_ct, 0 AS favor_ct, 0 AS cart_ct,
               0 AS order_sku_num, 0 AS comment_ct, 0 AS good_comment_ct, CAST(0 AS DECIMAL(16,2)) AS order_amount,
               CAST(0 AS DECIMAL(16,2)) AS payment_amount, CAST(0 AS DECIMAL(16,2)) AS refund_amount,
               CAST(NULL AS VARCHAR) AS order_kind, CAST(NULL AS BIGINT) AS order_id, ts
        FROM page_log WHERE page_id = 'good_detail' AND item_type = 'sku_id'
        UNION ALL SELECT CAST(item AS BIGINT), 1, 0, 0, 0, 0, 0, 0, 0, 0, 0, NULL, NULL, ts
        FROM display_log WHERE item_type = 'sku_id'
        UNION ALL SELECT k + 1, 0, 0, 1, 0, 0, 0, 0, 0, 0, 0, NULL, NULL, ts FROM page_log WHERE page_id = 'click'
        UNION ALL SELECT k + 1, 0, 0, 0, 1, 0, 0, 0, 0, 0, 0, NULL, NULL, ts FROM page_log WHERE page_id = 'good_detail'
        UNION ALL SELECT sku_id, 0, 0, 0, 0, sku_num, 0, 0, split_total_amount, 0, 0, 'order', order_id, create_time
        FROM order_wide
        UNION ALL SELECT sku_id, 0, 0, 0, 0, 0, 0, 0, 0, split_total_amount, 0, 'paid', order_id, order_create_time
        FROM payment_wide
        UNION ALL SELECT sku_id, 0, 0, 0, 0, 0, 0, 0, 0, 0, split_total_amount, 'refund', order_id, create_time
        FROM order_detail WHERE source_type = 'R'
        UNION ALL SELECT k + 1, 0, 0, 0, 0, 0, 1, CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END, 0, 0, 0, NULL, NULL, ts
        FROM page_log WHERE page_id = 'signup'""",
    "words": r"""
        SELECT doc_id, lower(unnest(list_concat(regexp_extract_all(text, '\p{Han}+'),
               regexp_extract_all(regexp_replace(text, '\p{Han}+', ' ', 'g'), '[\p{L}\p{M}\p{N}]+')))) AS word FROM documents""",
    "han_documents": f"SELECT doc_id, translate(lower(text), '{LATIN}', '{HAN}') AS text FROM documents",
    "han_words": r"""
        SELECT DISTINCT unnest(list_concat(regexp_extract_all(text, '\p{Han}+'),
               regexp_extract_all(regexp_replace(text, '\p{Han}+', ' ', 'g'), '[\p{L}\p{M}\p{N}]+'))) AS word
        FROM (SELECT translate(lower(text), '""" + f"{LATIN}', '{HAN}" + r"""') AS text FROM benchmark)""",
    "han_tokens": r"""
        SELECT doc_id, unnest(regexp_extract_all(regexp_replace(text, '\p{Han}+', ' ', 'g'), '[\p{L}\p{M}\p{N}]+')) AS word
        FROM han_documents
        UNION ALL
        SELECT doc_id, word FROM (
          SELECT doc_id, substr(run, pos, n) AS word, pos + n - 1 <= length(run) AS inside
          FROM (SELECT doc_id, run, unnest(range(1, length(run) + 1)) AS pos
                FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\p{Han}+')) AS run FROM han_documents)),
               (SELECT DISTINCT unnest([1, length(word)]) AS n FROM han_words)
        ) WHERE inside AND (length(word) = 1 OR word IN (SELECT word FROM han_words))""",
    "searches": """
        SELECT d.doc_id, w.word, 1704067200000 + d.doc_id * 1000 AS ts
        FROM documents d LEFT JOIN words w ON d.doc_id = w.doc_id""",
    "keyword_windows": """
        SELECT word AS keyword, ts - ts % 10000 AS w, CAST(count(*) AS BIGINT) AS ct, min(ts) AS ts
        FROM searches GROUP BY 1, 2""",
    "made": """
        SELECT 'table_' || (o_custkey % 10) AS tab, CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS usr,
               o_orderstatus AS status, o_orderpriority AS note, o_orderkey AS k, epoch_us(o_orderdate) // 1000 AS ms
        FROM orders""",
    "changes": """
        SELECT tab, 'insert' AS type, CAST(ms AS VARCHAR) AS ts_ms, id AS after_id, usr AS after_user,
               status AS after_status, note AS after_note, NULL AS before_id, true AS has_status FROM made
        UNION ALL SELECT tab, 'update', CAST(ms + 1 AS VARCHAR), id, usr, NULL,
               CASE WHEN k % 2 = 1 THEN 'changed' END, id, false FROM made WHERE k % 3 = 0
        UNION ALL SELECT tab, 'delete', CAST(ms + 2 AS VARCHAR), NULL, NULL, NULL, NULL, id, false FROM made WHERE k % 11 = 0
        UNION ALL SELECT tab, 'x', CAST(ms + 2 AS VARCHAR), id, usr, status, note, id, true FROM made WHERE k % 13 = 0""",
    "rule_rows": """
        SELECT 'table_' || (s_nationkey % 8) AS source_table,
               CASE WHEN s_suppkey % 4 < 2 THEN 'insert' ELSE 'update' END AS operate_type,
               CASE WHEN s_suppkey % 5 = 0 THEN 'other' WHEN s_suppkey % 2 = 0 THEN 'hbase' ELSE 'kafka' END AS sink_type,
               'sink_' || s_suppkey AS sink_table,
               CASE WHEN s_suppkey % 3 = 0 THEN 'id,user,note' ELSE 'id,status,note, user' END AS sink_columns,
               CAST(NULL AS VARCHAR) AS sink_pk, CAST(NULL AS VARCHAR) AS sink_extend,
               s_suppkey + 1704067200000 AS arrival
        FROM supplier WHERE s_suppkey % 17 <> 0""",
    "rules": """
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY source_table, operate_type ORDER BY arrival) AS rn
        FROM rule_rows) WHERE rn = 1""",
    "routed": """
        SELECT r.sink_type, r.sink_table, c.tab AS "table", c.type, c.ts_ms, c.after_id AS id,
               CASE WHEN r.sink_columns = 'id,user,note' THEN c.after_user END AS "user",
               CASE WHEN r.sink_columns <> 'id,user,note' THEN c.after_status END AS status, c.after_note AS note,
               CAST(CASE WHEN r.sink_columns = 'id,user,note' THEN 3 WHEN c.has_status THEN 3 ELSE 2 END AS INTEGER) AS n_fields
        FROM changes c JOIN rules r ON c.tab = r.source_table AND c.type = r.operate_type
        WHERE c.type <> 'delete' AND r.sink_type IN ('hbase', 'kafka')""",
}


def _stamp(ms: str) -> str:
    return f"strftime(make_timestamp(({ms}) * 1000), '%Y-%m-%d %H:%M:%S')"


def _stamp_ms(ms: str) -> str:
    return f"{_stamp(ms)} || '.' || lpad(CAST(({ms}) % 1000 AS VARCHAR), 3, '0')"


def _bounds(start: str, width_ms: int) -> str:
    return f"{_stamp(start)} AS stt, {_stamp(f'{start} + {width_ms}')} AS edt"


def _big(*names: str) -> str:
    return ", ".join(f"CAST(sum({n}) AS BIGINT) AS {n}" for n in names)


def _money(*names: str) -> str:
    return ", ".join(f"CAST(sum({n}) AS DECIMAL(18,2)) AS {n}" for n in names)


def _visitor_stats(rows: str, width_ms: int) -> str:
    start = f"(ts - ts % {width_ms})"
    return (
        f"SELECT {_bounds(start, width_ms)}, vc, ch, ar, is_new, {_big('uv_ct', 'pv_ct', 'sv_ct', 'uj_ct', 'dur_sum')}, "
        f"min(ts) AS ts FROM {rows} GROUP BY {start}, vc, ch, ar, is_new"
    )


def _product_stats(width_ms: int) -> str:
    start = f"(ts - ts % {width_ms})"
    counts = _big("display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num", "comment_ct", "good_comment_ct")
    kinds = ", ".join(
        f"count(DISTINCT CASE WHEN order_kind = '{kind}' THEN order_id END) AS {name}"
        for kind, name in (("order", "order_ct"), ("paid", "paid_order_ct"), ("refund", "refund_order_ct"))
    )
    return (
        f"SELECT t.*, CAST(s.price AS DECIMAL(16,2)) AS sku_price, s.sku_name, s.spu_id, s.tm_id, s.category3_id, s.spu_name, "
        f"s.tm_name, s.category3_name FROM (SELECT {_bounds(start, width_ms)}, sku_id, {counts}, "
        f"{_money('order_amount', 'payment_amount', 'refund_amount')}, {kinds}, min(ts) AS ts FROM product_rows "
        f"GROUP BY {start}, sku_id) t LEFT JOIN dim_sku s ON t.sku_id = s.id"
    )


def _province_stats(count: str, width_ms: int, extra: str = ", min(create_time) AS ts") -> str:
    start = f"(create_time - create_time % {width_ms})"
    return (
        f"SELECT province_id, {_bounds(start, width_ms)}, CAST(sum(split_total_amount) AS DECIMAL(18,2)) AS order_amount, "
        f"{count} AS order_count{extra} FROM order_wide GROUP BY {start}, province_id"
    )


def _behaviour_join(bound_ms: int, shifts: str = "") -> str:
    side = (
        "SELECT user_id, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) + 1 AS item_id, event_type AS behavior, "
        "epoch_us(ts) // 1000 AS ms FROM events WHERE event_type = "
    )
    other = f"{side} 'purchase'"
    if shifts:
        other = f"SELECT user_id, item_id, behavior, ms + [{shifts}][item_id % {len(shifts.split(','))} + 1] AS ms FROM ({side} 'click')"
    return (
        f"SELECT a.user_id, a.item_id, a.behavior, {_stamp_ms('a.ms')} AS ts, b.user_id AS user_id0, b.item_id AS item_id0, "
        f"b.behavior AS behavior0, {_stamp_ms('b.ms')} AS ts0 FROM ({side} 'click') a JOIN ({other}) b "
        f"ON a.user_id = b.user_id AND a.ms BETWEEN b.ms - {bound_ms} AND b.ms + {bound_ms}"
    )


MONTH = 2_592_000_000
FLAT = "SELECT mid, is_new, page_id, last_page_id, item, ts FROM"
CHANGE = "SELECT 'shop' AS database, tab AS \"table\", type, ts_ms, after_id, after_status, after_note, before_id FROM changes"
ORDER_WIDE = (
    "SELECT order_id, detail_id, sku_id, user_id, province_id, order_status, total_amount, order_price, sku_num, "
    "split_total_amount, split_activity_amount, split_coupon_amount, source_type, create_time FROM order_wide"
)
AREAS = (
    f"SELECT area_code AS province_id, {_bounds('(ts - ts % 10000)', 10000)}, count(*) AS order_count "
    "FROM page_log GROUP BY ts - ts % 10000, area_code"
)
KEYS = (
    f"SELECT key, {_bounds('(ts - ts % 2000)', 2000)}, count(*) AS ct "
    "FROM (SELECT event_type AS key, epoch_us(ts) // 1000 AS ts FROM events) GROUP BY ts - ts % 2000, key"
)
FIXED = """SELECT mid, CASE WHEN is_new = '1' AND rn > 1 THEN '0' ELSE is_new END AS is_new, page_id, ts
    FROM (SELECT *, row_number() OVER (PARTITION BY mid, is_new ORDER BY ts) AS rn FROM base_log)"""

BODIES = {
    "read_topic": f"{FLAT} page_log",
    "topic_table": f"SELECT mid, item AS full_word, {_stamp('ts')} AS rt FROM page_log WHERE last_page_id = 'search' AND item IS NOT NULL",
    "cdc_normalize": CHANGE,
    "cdc_snapshot_rules": "SELECT * FROM rule_rows",
    "scan_jdbc_table": "SELECT c_custkey || ',' || c_name || ',' || c_nationkey || ',' || CAST(c_acctbal AS DECIMAL(16,2)) || ',' || c_mktsegment AS value FROM customer",
    "scan_dim": "SELECT CAST(id AS VARCHAR) AS id, sku_name, CAST(price AS VARCHAR) AS price, CAST(spu_id AS VARCHAR) AS spu_id, CAST(tm_id AS VARCHAR) AS tm_id, CAST(category3_id AS VARCHAR) AS category3_id FROM dim_sku WHERE tm_id = 7 AND category3_id = 6907",
    "scan_jdbc_dim_sql": "SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, CAST(n_regionkey AS VARCHAR) AS area_code, n_name AS iso_code FROM nation",
    "parse_csv_event": "SELECT event_type AS key, CAST(1 AS BIGINT) AS n, epoch_us(ts) // 1000 AS ts FROM events",
    "write_topic": f"{FLAT} page_log",
    "write_topic_dynamic": """SELECT sink_table AS topic, '{"id":"' || id || '"' || COALESCE(',"user":"' || "user" || '"', '')
        || COALESCE(',"status":"' || status || '"', '') || ',"note":' || COALESCE('"' || note || '"', 'null') || '}' AS value
        FROM routed WHERE sink_type = 'kafka'""",
    "ensure_dim_table": """SELECT sink_table, CAST(position AS INTEGER) AS position, "column", "column" = 'id' AS is_key FROM
        (SELECT sink_table, unnest(string_split(sink_columns, ',')) AS "column",
                unnest(range(len(string_split(sink_columns, ',')))) AS position FROM rules WHERE sink_type = 'hbase')""",
    "upsert_dim": """SELECT id, usr AS "user", status, CASE WHEN k % 13 = 0 THEN note WHEN k % 3 = 0 THEN
        CASE WHEN k % 2 = 1 THEN 'changed' END ELSE note END AS note FROM made""",
    "write_stats": _visitor_stats("visitor_rows_6h", 3_600_000),
    "parse_json": "SELECT mid, vc, ch, ar, is_new, page_id, during_time, CASE WHEN is_start THEN CAST(k AS VARCHAR) END AS loading_time, CAST(CASE WHEN is_start THEN -1 ELSE k % 4 END AS INTEGER) AS n_displays, ts FROM base_log",
    "drop_deletes": f"{CHANGE} WHERE type <> 'delete'",
    "rules_first_wins": "SELECT * FROM rules",
    "route_by_rules": "SELECT * FROM routed",
    "rules_broadcast_join": "SELECT c.tab AS \"table\", c.type, c.ts_ms, c.after_id AS id, r.sink_table, r.sink_type FROM changes c JOIN rules r ON c.tab = r.source_table AND c.type = r.operate_type WHERE c.type <> 'delete'",
    "prune_columns": "SELECT tab AS \"table\", type, ts_ms, after_id AS id, after_note AS note, CAST(NULL AS VARCHAR) AS \"user\", CAST(NULL AS VARCHAR) AS status FROM changes",
    "split_log": """SELECT 'dwd_start_log' AS topic, mid, NULL AS page_id, CAST(k AS VARCHAR) AS item, ts FROM base_log WHERE is_start
        UNION ALL SELECT 'dwd_page_log', mid, page_id, item, ts FROM page_log
        UNION ALL SELECT 'dwd_display_log', mid, page_id, item, ts FROM display_log""",
    "log_topics_whole": """
        SELECT 'dwd_start_log' AS topic, CAST(user_id AS VARCHAR) AS uid, is_new, mid, NULL AS shown_mid, NULL AS source_type,
               NULL AS pos_id, NULL AS shown, action, err, 'icon' AS entry, NULL AS broken FROM fixed_log WHERE is_start
        UNION ALL SELECT 'dwd_page_log', CAST(user_id AS VARCHAR), is_new, mid, NULL, 'from ' || page_id, NULL, NULL,
               action, err, NULL, NULL FROM fixed_log WHERE NOT is_start
        UNION ALL SELECT 'dwd_display_log', NULL, NULL, NULL, mid, NULL, CAST(length(CAST(k + 1 + i AS VARCHAR)) AS VARCHAR),
               CAST(k + 1 + i AS VARCHAR), NULL, NULL, NULL, NULL
        FROM fixed_log, (VALUES (0), (1), (2)) AS n(i) WHERE NOT is_start AND i < k % 4
        UNION ALL SELECT 'dwd_unreadable_log', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, '{"cut":' || ts
        FROM base_log WHERE ts % 97 = 0""",
    "log_topics_odd": """SELECT 'dwd_page_log' AS topic, mid, NULL AS shown_mid, NULL AS shown, CAST(ts AS VARCHAR) AS ts, NULL AS broken FROM page_log
        UNION ALL SELECT 'dwd_display_log', NULL, mid, item, CAST(ts AS VARCHAR), NULL FROM page_log
        UNION ALL SELECT 'dwd_unreadable_log', NULL, NULL, NULL, NULL, odd FROM page_log, (VALUES ('"a"'), ('7'), ('null'), ('[1]')) AS t(odd)""",
    "unreadable_lines": """SELECT 'captured' AS topic, CAST(NULL AS VARCHAR) AS line, count(*) AS n FROM changes
        UNION ALL SELECT 'rules', NULL, count(*) FROM supplier
        UNION ALL SELECT 'dwd_order_info', NULL, count(*) FROM order_info
        UNION ALL SELECT 'dwd_payment_info', NULL, count(*) FROM payment_info
        UNION ALL SELECT topic, '{"cut":' || o_orderkey, 1 FROM orders, (VALUES ('captured'), ('dwd_order_info'), ('dwd_payment_info')) AS t(topic) WHERE o_orderkey % 97 = 0
        UNION ALL SELECT 'rules', '{"cut":' || s_suppkey, 1 FROM supplier WHERE s_suppkey % 10 = 0""",
    "new_checkpoint": f"{FLAT} page_log",
    "retried_batch": f"{FLAT} page_log",
    "display_enrich": "SELECT item, item_type, mid, page_id, ts FROM display_log",
    "display_whole_record": "SELECT p.mid, p.is_new, p.page_id, p.last_page_id, p.item, p.ts FROM page_log p JOIN display_log d ON p.mid = d.mid AND p.ts = d.ts",
    "entry_pages": f"{FLAT} page_log WHERE last_page_id IS NULL",
    "search_rows": f"SELECT item AS full_word, ts, {_stamp_ms('ts')} AS rt FROM page_log WHERE last_page_id = 'search' AND item IS NOT NULL",
    "order_wide_interval_join": "SELECT order_id, detail_id, create_time AS order_time, detail_time, split_total_amount FROM order_wide",
    "order_wide_interval_join_5s": f"{ORDER_WIDE} WHERE abs(detail_time - create_time) <= 5000",
    "order_wide_project": ORDER_WIDE,
    "order_wide_dims": "SELECT order_id, detail_id, sku_id, user_id, province_area_code, province_iso_code, province_3166_2_code, user_gender, spu_id, tm_id, category3_id, spu_name, tm_name, category3_name FROM order_wide_full",
    "payment_wide_interval_join": "SELECT payment_id, order_id, detail_id, payment_create_time AS payment_time, order_create_time AS order_time FROM payment_wide",
    "payment_wide_project": "SELECT *, CAST(NULL AS VARCHAR) AS province_name, CAST(NULL AS INTEGER) AS user_age FROM payment_wide",
    "visitor_facts": "SELECT ar, ch, is_new, vc, CAST(0 AS BIGINT) AS uv_ct, CAST(1 AS BIGINT) AS pv_ct, CAST(CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END AS BIGINT) AS sv_ct, CAST(0 AS BIGINT) AS uj_ct, during_time AS dur_sum, ts FROM page_log",
    "visitor_union": "SELECT ar, ch, is_new, vc, CAST(uv_ct AS BIGINT) AS uv_ct, CAST(pv_ct AS BIGINT) AS pv_ct, CAST(sv_ct AS BIGINT) AS sv_ct, CAST(uj_ct AS BIGINT) AS uj_ct, dur_sum, ts FROM visitor_rows_6h",
    "product_facts": """SELECT CAST(item AS BIGINT) AS sku_id, CAST(1 AS BIGINT) AS click_ct, CAST(0 AS BIGINT) AS display_ct, ts
        FROM page_log WHERE page_id = 'good_detail' UNION ALL
        SELECT CAST(item AS BIGINT), CAST(0 AS BIGINT), CAST(1 AS BIGINT), ts FROM display_log WHERE item_type = 'sku_id'""",
    "product_union": "SELECT sku_id, CAST(display_ct AS BIGINT) AS display_ct, CAST(click_ct AS BIGINT) AS click_ct, CAST(favor_ct AS BIGINT) AS favor_ct, CAST(cart_ct AS BIGINT) AS cart_ct, CAST(order_sku_num AS BIGINT) AS order_sku_num, CAST(comment_ct AS BIGINT) AS comment_ct, CAST(good_comment_ct AS BIGINT) AS good_comment_ct, CAST(order_amount AS DECIMAL(16,2)) AS order_amount, CAST(payment_amount AS DECIMAL(16,2)) AS payment_amount, CAST(refund_amount AS DECIMAL(16,2)) AS refund_amount, order_kind, order_id, ts FROM product_rows",
    "dim_lookup_join": "SELECT d.id, d.order_id, d.sku_id, d.split_total_amount, s.sku_name, CAST(s.price AS VARCHAR) AS sku_price FROM order_detail d LEFT JOIN dim_sku s ON d.sku_id = s.id",
    "product_dims": """SELECT t.*, CAST(s.price AS DECIMAL(16,2)) AS sku_price, s.sku_name, s.spu_id, s.tm_id, s.category3_id, s.spu_name,
        s.tm_name, s.category3_name FROM (SELECT k + 1 AS sku_id, count(*) AS cart_ct FROM page_log WHERE page_id = 'good_detail' GROUP BY 1) t
        LEFT JOIN dim_sku s ON t.sku_id = s.id""",
    "sql_interval_join": _behaviour_join(20_000),
    "sql_interval_join_ends": _behaviour_join(20_000, "-20001, -20000, 0, 20000, 20001"),
    "order_wide_interval_join_ends": """SELECT d.order_id, d.id AS detail_id, CAST([-5001, -5000, 0, 5000, 5001][d.id % 5 + 1] AS BIGINT) AS apart
        FROM order_detail d JOIN order_info o ON o.id = d.order_id WHERE d.id % 5 BETWEEN 1 AND 3""",
    "sql_interval_join_hourly": _behaviour_join(3_600_000),
    "window_stats_join": "SELECT a.*, b.row_count FROM ("
        + _province_stats("count(DISTINCT order_id)", MONTH, "")
        + ") a JOIN (" + _province_stats("count(*)", MONTH, ", count(*) AS row_count")
        + ") b ON a.province_id = b.province_id AND a.stt = b.stt AND a.edt = b.edt",
    "lateral_table_join": "SELECT word, ts FROM searches",
    "jump_union": "SELECT mid, ts, kind FROM jump_6h",
    "visitor_stats": _visitor_stats("visitor_rows_10s", 10_000),
    "visitor_stats_hourly": _visitor_stats("visitor_rows_6h", 3_600_000),
    "product_stats": _product_stats(10_000),
    "product_stats_hourly": _product_stats(3_600_000),
    "province_stats": _province_stats("count(DISTINCT order_id)", 10_000),
    "province_stats_monthly": _province_stats("count(DISTINCT order_id)", MONTH),
    "province_stats_rows": _province_stats("count(*)", MONTH),
    "keyword_stats": f"SELECT keyword, ct, 'search' AS source, {_bounds('w', 10_000)}, ts FROM keyword_windows",
    "page_area_counts": AREAS,
    "key_count_2s": KEYS,
    "window_bounds": f"SELECT mid, ts, {_bounds('(ts - ts % 10000)', 10_000)} FROM page_log",
    "daily_gmv": f"SELECT CAST(sum(order_amount) AS DECIMAL(18,2)) AS order_amount FROM product_rows WHERE strftime(make_timestamp((ts - ts % 3600000) * 1000), '%Y%m%d') = '19980310'",
    "keyword_topn": "SELECT keyword, CAST(sum(ct) AS BIGINT) AS ct FROM keyword_windows WHERE strftime(make_timestamp(w * 1000), '%Y%m%d') = '20240101' GROUP BY keyword ORDER BY ct DESC, keyword NULLS FIRST LIMIT 5",
    "channel_topn": "SELECT ch, CAST(sum(pv_ct) AS BIGINT) AS pv_ct FROM visitor_rows_10s WHERE strftime(make_timestamp((ts - ts % 10000) * 1000), '%Y%m%d') = '20240110' GROUP BY ch ORDER BY pv_ct DESC, ch LIMIT 5",
    "fix_is_new": FIXED,
    "unique_visit": f"{FLAT} uv",
    "user_jump": f"{FLAT} jump_10s",
    "user_jump_hourly": f"{FLAT} jump_6h",
    "fix_is_new_stream": FIXED,
    "unique_visit_stream": f"{FLAT} uv",
    "user_jump_stream": "SELECT mid, ts, kind FROM jump_6h",
    "visitor_stats_stream": _visitor_stats("visitor_rows_6h", 3_600_000),
    "product_stats_stream": _product_stats(3_600_000),
    "order_wide_stream": ORDER_WIDE,
    "key_count_2s_stream": KEYS,
    "bounded_watermark": AREAS,
    "late_drop": AREAS,
    "late_rows": "SELECT count(*) AS lost FROM page_log",
    "passthrough": f"{FLAT} page_log",
    "checkpointed_run": f"{FLAT} page_log",
    "time_functions": f"""SELECT event_id, strftime(make_timestamp(ms * 1000), '%Y-%m-%d') AS ymd, {_stamp('ms')} AS ymd_hms,
        regexp_replace({_stamp_ms('ms')}, '[.]?0+$', '') AS utc_text, {_stamp_ms('ms')} AS event_time,
        CAST(strftime(make_timestamp(ms * 1000), '%Y%m%d') AS INTEGER) AS yyyymmdd
        FROM (SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events)""",
    "text_functions": """SELECT event_id, event_type AS lowered, v AS map_value, v AS json_value, CAST(3 AS INTEGER) AS n_parts,
        event_type || ', b,' || v AS joined, CAST(v AS BIGINT) AS as_long, CAST(NULL AS BIGINT) AS not_a_number,
        CAST(v || '.50' AS DECIMAL(16,2)) AS as_money, '(' || event_type || ',' || user_id || ',' || event_id || ')' AS tuple
        FROM (SELECT *, regexp_extract(props, '[0-9]+') AS v FROM events)""",
    "split_words": """SELECT d.doc_id, w.word, count(*) AS n FROM documents d LEFT JOIN words w ON d.doc_id = w.doc_id GROUP BY 1, 2""",
    "keyword_tokens_han": "SELECT word, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM han_tokens GROUP BY word",
    "keyword_tokens": "SELECT word, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM words GROUP BY word",
}


def _needed(text: str, found: dict[str, str]) -> dict[str, str]:
    for name, body in VIEWS.items():
        if name not in found and re.search(rf"\b{name}\b", text):
            _needed(body, found)
            found[name] = body
    return found


def oracle(name: str) -> str:
    views = _needed(BODIES[name], {})
    if not views:
        return BODIES[name]
    return "WITH " + ",\n".join(f"{n} AS ({b})" for n, b in views.items()) + "\n" + BODIES[name]


BODIES["log_topics"] = BODIES["split_log"]
ORACLES = {name: oracle(name) for name in BODIES}
