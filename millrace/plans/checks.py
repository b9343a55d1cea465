"""The same results as plain SQL, for comparison with another engine.

A query that is missing here has no SQL form. Append-mode streams hold back what
may still change, so their SQL keeps only what the final watermark has passed.
"""

from __future__ import annotations

_INTERVAL_SIDES = """
WITH c AS (SELECT event_id AS click_id, user_id AS c_user, ts AS c_ts FROM events WHERE event_type = 'click'),
b AS (SELECT event_id AS buy_id, user_id AS b_user, ts AS b_ts FROM events WHERE event_type = 'purchase'),
wm AS (SELECT least((SELECT max(c_ts) FROM c), (SELECT max(b_ts) FROM b)) - INTERVAL 10 MINUTE AS closed),
pairs AS (SELECT * FROM c JOIN b ON c_user = b_user AND b_ts >= c_ts AND b_ts <= c_ts + INTERVAL 2 HOUR),
lone_c AS (SELECT * FROM c WHERE click_id NOT IN (SELECT click_id FROM pairs)
           AND c_ts + INTERVAL 2 HOUR < (SELECT closed FROM wm)),
lone_b AS (SELECT * FROM b WHERE buy_id NOT IN (SELECT buy_id FROM pairs) AND b_ts < (SELECT closed FROM wm))
"""
_EVERY_LONE_C = "c WHERE click_id NOT IN (SELECT click_id FROM pairs)"
_EVERY_LONE_B = "b WHERE buy_id NOT IN (SELECT buy_id FROM pairs)"
_LONE_C = """SELECT click_id, c_user, c_ts, CAST(NULL AS BIGINT) AS buy_id, CAST(NULL AS BIGINT) AS b_user,
CAST(NULL AS TIMESTAMP) AS b_ts FROM lone_c"""
_LONE_B = """SELECT CAST(NULL AS BIGINT) AS click_id, CAST(NULL AS BIGINT) AS c_user,
CAST(NULL AS TIMESTAMP) AS c_ts, buy_id, b_user, b_ts FROM lone_b"""

_DAY_ITEM = """SELECT date_trunc('day', ts) AS "start", date_trunc('day', ts) + INTERVAL 1 DAY AS "end",
event_type AS item, sum(value) AS total FROM events GROUP BY ALL"""
_SLIDING = """SELECT w AS "start", w + INTERVAL 1 DAY AS "end", event_type AS item, sum(value) AS total
FROM (SELECT event_type, value, unnest(generate_series(date_trunc('hour', ts) - INTERVAL 23 HOUR,
date_trunc('hour', ts), INTERVAL 1 HOUR)) AS w FROM events) GROUP BY ALL"""


def _top(totals: str) -> str:
    return f"""SELECT "start", "end", item, round(total, 4) AS total FROM (
SELECT *, row_number() OVER (PARTITION BY "start" ORDER BY total DESC NULLS LAST, item) AS r FROM ({totals}))
WHERE r = 1"""


_CAR_COLUMNS = """SELECT p_name AS "Name", p_retailprice AS "Miles_per_Gallon",
CAST(p_size AS BIGINT) AS "Weight_in_lbs", p_type AS "Origin" FROM part"""
_WEIGHT = "SELECT p_partkey, round(CAST(p_size AS DOUBLE) / 2.2, {digits}) AS weight_kg FROM part"
_SHORT_NAMES = "SELECT event_type AS value FROM events WHERE length(event_type) <= 5"
_AVERAGE = "SELECT round(avg(p_retailprice), 4) AS average FROM part"
_COUNT_BY = "SELECT p_type, count(*) AS parts FROM part GROUP BY p_type"
_ORDER_CUSTOMER = """SELECT o_orderkey, o_custkey, o_totalprice, c_custkey, c_name, c_nationkey
FROM orders JOIN customer ON o_custkey = c_custkey"""
_DOC_LEFT = """SELECT d.doc_id, lang, n_chars, l.doc_id AS l_doc_id, quality, toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
_DOC_SEMI = "SELECT doc_id, lang, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)"
_DOC_ANTI = "SELECT doc_id, lang, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"

ORACLE: dict[str, str] = {
    "src_text_stream": "SELECT date_trunc('millisecond', ts) AS created, event_type AS color FROM events",
    "src_csv_stream": """SELECT o_orderpriority AS company, CAST(o_orderdate AS DATE) AS date,
        o_totalprice AS value FROM orders""",
    "src_json_stream": _CAR_COLUMNS,
    "src_json_inferred": _CAR_COLUMNS,
    "src_range": """SELECT l_orderkey, unnest(generate_series(CAST(1 AS BIGINT), CAST(l_linenumber AS BIGINT)))
        AS number FROM lineitem""",
    "src_numbers": "SELECT unnest(generate_series(CAST(1 AS BIGINT), (SELECT count(*) FROM lineitem))) AS number",
    "lines_schema_kept": "SELECT c_custkey, c_name, c_nationkey FROM customer",
    "ckpt_edited_file": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 3 <> 1",
    "state_open_windows": """SELECT "start", "end", event_type, "count" FROM (
        SELECT date_trunc('hour', ts) AS "start", date_trunc('hour', ts) + INTERVAL 1 HOUR AS "end",
        event_type, count(*) AS "count" FROM events WHERE ts IS NOT NULL GROUP BY ALL)
        WHERE "end" > (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM events)""",
    "win_top1_closed": f"""SELECT * FROM ({_top(_DAY_ITEM)})
        WHERE "end" <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""",
    "win_top1_sliding_closed": f"""SELECT * FROM ({_top(_SLIDING)})
        WHERE "end" <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""",
    "rdd_double": "SELECT CAST(l_orderkey AS BIGINT) * 2 AS doubled FROM lineitem",
    "src_recursive": "SELECT p_partkey, p_name FROM part",
    "lines_top1": _top(_DAY_ITEM),
    "lines_static_inner": _ORDER_CUSTOMER,
    "lines_stream_inner": _ORDER_CUSTOMER,
    "files_json_messages": """SELECT upper(p_name) AS key, CAST(json_merge_patch('{}', to_json({'Name': p_name,
        'Weight_in_lbs': p_size, 'Origin': p_type})) AS VARCHAR) AS value FROM part""",
    "ckpt_new_run": "SELECT o_orderkey FROM orders UNION ALL SELECT o_orderkey FROM orders",
    "trigger_processing_time": "SELECT p_partkey, p_size FROM part",
    "sink_json": "SELECT p_partkey, p_name, p_size FROM part",
    "sink_csv": "SELECT p_partkey, p_name, p_size FROM part",
    "late_rows": """WITH w AS (SELECT *, date_trunc('hour', ts) AS "start", date_trunc('hour', ts) + INTERVAL 1 HOUR AS "end"
        FROM events WHERE ts IS NOT NULL),
        mark AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE AS closed FROM w WHERE event_id % 2 = 0),
        kept AS (SELECT * FROM w WHERE event_id % 2 = 0 OR "end" > (SELECT closed FROM mark))
        SELECT "start", "end", event_type, count(*) AS "count",
        (SELECT count(*) FROM w) - (SELECT count(*) FROM kept) AS late FROM kept
        WHERE "end" <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM kept) GROUP BY ALL""",
    "batch_wm_count": """SELECT date_trunc('hour', ts) AS "start", date_trunc('hour', ts) + INTERVAL 1 HOUR AS "end",
        event_type, count(*) AS "count" FROM events GROUP BY ALL""",
    "batch_interval_inner": _INTERVAL_SIDES + "SELECT * FROM pairs",
    "batch_interval_right": _INTERVAL_SIDES
    + "SELECT * FROM pairs UNION ALL "
    + _LONE_B.replace("lone_b", _EVERY_LONE_B),
    "batch_interval_semi": _INTERVAL_SIDES + "SELECT * FROM c WHERE click_id IN (SELECT click_id FROM pairs)",
    "proj_columns": "SELECT p_name, p_brand FROM part",
    "proj_arith": _WEIGHT.format(digits=6),
    "proj_expr": _WEIGHT.format(digits=4),
    "proj_select_expr": _WEIGHT.format(digits=4),
    "proj_typed": """SELECT p_name AS name, p_partkey AS hp, CAST(p_size AS DOUBLE) AS weight,
        p_type AS origin FROM part""",
    "json_expand": "SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "json_fields": "SELECT event_id AS id, CAST(json_extract(props, '$.k') AS BIGINT) AS amount FROM events",
    "struct_pick": "SELECT c_custkey AS id, c_name AS name FROM customer",
    "kafka_decode": """SELECT event_type AS topic, props AS "stringValue", ts AS "timestamp",
        CAST(0 AS INTEGER) AS "timestampType" FROM events""",
    "kafka_kv": "SELECT upper(p_name) AS key, p_name AS value FROM part",
    "json_build": """SELECT upper(p_name) AS key,
        CAST(json_merge_patch('{}', to_json({'p_name': p_name, 'p_size': p_size, 'p_type': p_type})) AS VARCHAR)
        AS value FROM part""",
    "msg_default_key": """SELECT CASE WHEN event_type <> 'error' THEN event_type ELSE 'undefined' END AS key,
        props AS value FROM events""",
    "filter_length": _SHORT_NAMES,
    "filter_ne": "SELECT p_partkey, p_type FROM part WHERE p_type <> 'PROMO'",
    "filter_default": """SELECT p_partkey, p_name, p_retailprice FROM part
        WHERE coalesce(p_retailprice, 0) > 950""",
    "sql_where": """SELECT p_name AS "Name" FROM part WHERE p_type = 'PROMO'""",
    "agg_avg": _AVERAGE,
    "agg_stats": """SELECT round(sum(p_retailprice), 4) AS total, round(avg(p_retailprice), 4) AS mean,
        round(stddev_samp(p_retailprice), 4) AS stddev, round(min(p_retailprice), 4) AS least,
        round(max(p_retailprice), 4) AS greatest FROM part""",
    "agg_count_by": _COUNT_BY,
    "stream_count_powerful": "SELECT count(*) AS powerful FROM part WHERE coalesce(p_retailprice, 0) > 950",
    "stream_avg": _AVERAGE,
    "stream_count_by": _COUNT_BY,
    "mode_append_rows": "SELECT event_id, event_type, value FROM events WHERE value > 100",
    "mode_update_agg": "SELECT user_id, count(*) AS actions FROM events GROUP BY user_id",
    "mode_complete_agg": "SELECT user_id, round(sum(value), 4) AS total FROM events GROUP BY user_id",
    "ckpt_no_reread": "SELECT o_orderkey, o_totalprice FROM orders",
    "progress_event_time": """SELECT count(*) AS input_rows, CAST(0 AS BIGINT) AS late_rows,
        date_trunc('millisecond', min(ts)) AS min_time, date_trunc('millisecond', max(ts)) AS max_time,
        date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE AS watermark FROM events""",
    "sink_upsert": """SELECT p_name, arg_max_null(p_size, p_partkey) AS p_size, max(p_partkey) AS p_partkey
        FROM part GROUP BY p_name""",
    "sink_row_writer": "SELECT p_name, p_size FROM part",
    "sink_row_writer_repeated": "SELECT p_name, p_size FROM part",
    "sink_upsert_compacted": """SELECT p_name, arg_max_null(p_size, p_partkey) AS p_size, max(p_partkey) AS p_partkey
        FROM part GROUP BY p_name""",
    "join_inner": _ORDER_CUSTOMER,
    "join_left": _DOC_LEFT,
    "join_right": _DOC_LEFT,
    "join_full": """SELECT p_partkey, p_size, n_nationkey, n_name
        FROM part FULL JOIN nation ON p_size = n_nationkey""",
    "join_semi": _DOC_SEMI,
    "join_anti": _DOC_ANTI,
    "ss_static_inner": _ORDER_CUSTOMER,
    "static_ss_right": _DOC_LEFT,
    "ss_static_left": _DOC_LEFT,
    "ss_static_semi": _DOC_SEMI,
    "ss_static_anti": _DOC_ANTI,
    "stream_stream_inner": _ORDER_CUSTOMER,
    "stream_interval_inner": _INTERVAL_SIDES + "SELECT * FROM pairs",
    "stream_interval_left": _INTERVAL_SIDES + "SELECT * FROM pairs UNION ALL " + _LONE_C,
    "stream_interval_right": _INTERVAL_SIDES + "SELECT * FROM pairs UNION ALL " + _LONE_B,
    "stream_interval_full": _INTERVAL_SIDES + f"SELECT * FROM pairs UNION ALL {_LONE_C} UNION ALL {_LONE_B}",
    "stream_interval_semi": _INTERVAL_SIDES + "SELECT * FROM c WHERE click_id IN (SELECT click_id FROM pairs)",
    "win_tumbling_sum": """SELECT date_trunc('day', ts) AS "start", date_trunc('day', ts) + INTERVAL 1 DAY AS "end",
        round(sum(value), 4) AS total FROM events GROUP BY ALL""",
    "win_best_seller": f"SELECT * REPLACE (round(total, 4) AS total) FROM ({_DAY_ITEM})",
    "win_top1_per_day": _top(_DAY_ITEM),
    "win_sliding_sum": f"SELECT * REPLACE (round(total, 4) AS total) FROM ({_SLIDING})",
    "win_top1_sliding": _top(_SLIDING),
    "proc_time_chars": """SELECT props AS value, CAST(sum(length(props)) AS BIGINT) AS length
        FROM events GROUP BY props""",
    "wm_count": """SELECT "start", "end", event_type, "count" FROM (
        SELECT date_trunc('hour', ts) AS "start", date_trunc('hour', ts) + INTERVAL 1 HOUR AS "end",
        event_type, count(*) AS "count" FROM events GROUP BY ALL)
        WHERE "end" <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""",
    "win_sliding_append": f"""SELECT "start", "end", item AS event_type, round(total, 4) AS total FROM ({_SLIDING})
        WHERE "end" <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""",
    "batch_best_seller": f"SELECT * REPLACE (round(total, 4) AS total) FROM ({_DAY_ITEM})",
    "batch_top1_per_day": _top(_DAY_ITEM),
    "batch_sliding_sum": f"SELECT * REPLACE (round(total, 4) AS total) FROM ({_SLIDING})",
    "batch_top1_sliding": _top(_SLIDING),
    "batch_interval_left": _INTERVAL_SIDES
    + "SELECT * FROM pairs UNION ALL "
    + _LONE_C.replace("lone_c", _EVERY_LONE_C),
    "batch_interval_full": _INTERVAL_SIDES
    + "SELECT * FROM pairs UNION ALL "
    + _LONE_C.replace("lone_c", _EVERY_LONE_C)
    + " UNION ALL "
    + _LONE_B.replace("lone_b", _EVERY_LONE_B),
}
