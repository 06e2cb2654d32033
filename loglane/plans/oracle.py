"""Expected results in plain SQL (DuckDB dialect), computed from the table
columns by the rendering rules of ``sources.fixtures`` -- never by parsing a
line. Keys match ``plans.queries.REGISTRY``."""

from __future__ import annotations

# One row per event with the rendered pieces as columns.
EV = """
ev AS (
  SELECT event_id, user_id, event_type, ts,
         CAST(ts AS DATE) AS log_date,
         'trading_' || strftime(CAST(ts AS DATE), '%Y%m%d') || '.log' AS file_name,
         strftime(ts, '%H:%M:%S.%g') AS log_time,
         '10.0.0.' || CAST(user_id // 3 AS VARCHAR) AS ip,
         CASE WHEN event_type IN ('click', 'view') AND event_id % 60 = 21 THEN ''
              ELSE CAST(user_id + 11000000 AS VARCHAR) END AS login,
         (event_type = 'purchase' AND event_id % 16 NOT IN (3, 9, 10, 11, 12, 15))
           OR (event_type IN ('click', 'view') AND event_id % 4 = 1 AND event_id % 70 <> 31) AS is_trade,
         (event_type = 'purchase' AND event_id % 16 NOT IN (3, 9, 10, 11, 12, 15) AND event_id % 48 <> 22)
           OR (event_type IN ('click', 'view') AND event_id % 4 = 1 AND event_id % 70 <> 31) AS is_usable,
         event_type IN ('click', 'view') AS is_login,
         event_id % 70 = 31 AS short,
         event_id % 500 = 250 AS long_device
  FROM events)"""

TRADE_IPS = """
trade_ips AS (SELECT DISTINCT log_date, ip FROM ev WHERE is_usable)"""

ACC = """
acc AS (
  SELECT file_name, log_date, log_time, ip, login,
         CASE WHEN event_id % 12 = 0 THEN 'unknown' ELSE md5(CAST(event_id AS VARCHAR)) END AS cid,
         CASE WHEN long_device THEN 'Terminal ' || repeat('Q', 120)
              WHEN event_id % 3 = 0 THEN 'Terminal Alpha'
              WHEN event_id % 3 = 1 THEN 'Terminal Beta'
              ELSE 'Terminal' END AS device,
         CASE WHEN short THEN 'Unknown' WHEN event_id % 12 = 0 THEN 'cid: ' || md5(CAST(event_id AS VARCHAR))
              ELSE 'point: Gate North ' || CAST(event_id % 2 + 1 AS VARCHAR) END AS server,
         'pending' AS flag,
         CASE WHEN event_id % 12 = 0 THEN 'yes' ELSE 'no' END AS investor,
         event_id, long_device
  FROM ev WHERE is_login)"""

FLAGGED = """
flagged AS (
  SELECT a.file_name, a.log_date, a.log_time, a.ip, a.login, a.cid, a.device, a.server,
         CASE WHEN t.ip IS NOT NULL THEN 'trade' ELSE 'lilo' END AS flag, a.investor
  FROM acc a LEFT JOIN trade_ips t ON a.log_date = t.log_date AND a.ip = t.ip
  WHERE NOT a.long_device)"""

ACCESS_COLS = "file_name, log_date, log_time, ip, login, cid, device, server, flag, investor"

# App-log lines: v = event_id % 50 selects the damage (see fixtures).
APP = """
app AS (
  SELECT event_id AS line_no, event_id % 50 AS v, event_type, user_id,
         CASE event_type WHEN 'error' THEN 500 WHEN 'click' THEN 404 WHEN 'signup' THEN 201 ELSE 200 END AS base_status,
         CASE WHEN event_id % 50 = 7 THEN 'not-a-time' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%g') END AS ts_text,
         '10.0.0.' || CAST(user_id // 3 AS VARCHAR) AS ip,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method
  FROM events),
app2 AS (
  SELECT *, CASE WHEN base_status >= 500 THEN 'ERROR' WHEN base_status >= 400 THEN 'WARN' ELSE 'INFO' END AS sev,
         CASE WHEN v = 3 THEN 'abc' ELSE CAST(base_status AS VARCHAR) END AS status_text,
         CASE WHEN v = 6 THEN '' ELSE CAST(line_no % 5000 AS VARCHAR) END AS dur_text,
         CASE WHEN base_status >= 500 THEN 'code=E' || CAST(line_no % 7 AS VARCHAR) END AS err
  FROM app),
app_line AS (
  SELECT *, ts_text || ' | ' || rpad(sev, 5, ' ') || ' | user_id=' || CAST(user_id AS VARCHAR)
            || ' | endpoint=/api/' || event_type || ' | method=' || method
            || ' | status=' || status_text || ' | duration_ms=' || dur_text || ' | ip=' || ip
            || coalesce(' | error=' || err, '')
            || CASE v WHEN 2 THEN ' | status=777' WHEN 4 THEN ' | level=TRACE' WHEN 5 THEN ' | junk' ELSE '' END AS line
  FROM app2 WHERE v NOT IN (1, 8)),
app_parsed AS (
  SELECT line_no, ts_text AS "timestamp",
         CASE WHEN v = 4 THEN 'TRACE' ELSE sev END AS level,
         CAST(user_id AS VARCHAR) AS user_id, '/api/' || event_type AS endpoint, method,
         CASE WHEN v = 2 THEN '777' ELSE status_text END AS status,
         dur_text AS duration_ms, ip, err AS error, v, line
  FROM app_line),
app_typed AS (
  SELECT line_no, CAST("timestamp" AS TIMESTAMP) AS "timestamp", level, user_id, endpoint, method,
         CAST(status AS INTEGER) AS status, CAST(nullif(duration_ms, '') AS INTEGER) AS duration_ms,
         ip, error
  FROM app_parsed WHERE v NOT IN (3, 7))"""

ENV = """
env AS (
  SELECT CASE WHEN event_type = 'signup' THEN '__internal' ELSE event_type END AS topic,
         CAST(user_id % 3 AS INTEGER) AS "partition", event_id
  FROM events),
env_off AS (SELECT *, event_id AS "offset" FROM env),
wm AS (
  SELECT topic, "partition", CAST(min("offset") AS BIGINT) AS low, CAST(max("offset") + 1 AS BIGINT) AS high
  FROM env_off GROUP BY topic, "partition"),
committed AS (
  SELECT topic, "partition", max("offset") + 1 AS committed FROM env_off
  WHERE event_id < (SELECT max(event_id) * 0.9 FROM events)
  GROUP BY topic, "partition"
  HAVING NOT (topic = 'view' AND "partition" = 2)),
lag AS (
  SELECT w.topic, w."partition", w.low, w.high,
         greatest(coalesce(c.committed, 0), 0) AS committed,
         w.high - greatest(coalesce(c.committed, 0), 0) AS lag
  FROM wm w LEFT JOIN committed c ON w.topic = c.topic AND w."partition" = c."partition"
  WHERE NOT starts_with(w.topic, '__'))"""

SQL: dict[str, str] = {}

SQL["eod_flags"] = f"""
WITH {EV}, {TRADE_IPS}, {ACC}, {FLAGGED}
SELECT {ACCESS_COLS} FROM flagged"""

SQL["eod_flag_counts"] = f"""
WITH {EV}, {TRADE_IPS}, {ACC}, {FLAGGED}
SELECT log_date, CAST(count_if(flag = 'trade') AS BIGINT) AS trade_count, CAST(count_if(flag = 'lilo') AS BIGINT) AS lilo_count,
       CAST(count_if(flag = 'pending') AS BIGINT) AS pending_count
FROM flagged GROUP BY log_date"""

SQL["eod_rerun_sticky"] = f"""
WITH {EV}, {ACC},
early_ips AS (SELECT DISTINCT log_date, ip FROM ev WHERE is_usable AND log_time < '18:00:00.000'),
all_ips AS (SELECT DISTINCT log_date, ip FROM ev WHERE is_usable)
SELECT a.file_name, a.log_date, a.log_time, a.ip, a.login, a.cid, a.device, a.server,
       CASE WHEN a.log_time < '18:00:00.000'
            THEN CASE WHEN e.ip IS NOT NULL THEN 'trade' ELSE 'lilo' END
            ELSE CASE WHEN t.ip IS NOT NULL THEN 'trade' ELSE 'lilo' END END AS flag,
       a.investor
FROM acc a
LEFT JOIN early_ips e ON a.log_date = e.log_date AND a.ip = e.ip
LEFT JOIN all_ips t ON a.log_date = t.log_date AND a.ip = t.ip
WHERE NOT a.long_device"""

SQL["trade_line_filter"] = f"""
WITH {EV}
SELECT file_name, event_id AS line_no FROM ev WHERE is_trade"""

SQL["trade_ip_logins"] = f"""
WITH {EV}
SELECT DISTINCT log_date, ip, login FROM ev WHERE is_usable"""

SQL["trade_ip_login_counts"] = f"""
WITH {EV}
SELECT log_date, ip, count(DISTINCT login) AS n_logins FROM ev WHERE is_usable GROUP BY log_date, ip"""

SQL["trade_scan_summary"] = f"""
WITH {EV}
SELECT file_name, count(*) AS lines_scanned, count(DISTINCT CASE WHEN is_usable THEN ip END) AS trade_ips
FROM ev GROUP BY file_name"""

SQL["cid_filter"] = f"""
WITH {EV}
SELECT file_name, event_id AS line_no, CASE WHEN event_id % 7 = 3 THEN 3 ELSE 0 END AS stripped_chars
FROM ev WHERE is_login"""

SQL["access_log_parse_strict"] = f"""
WITH {EV}, {ACC}
SELECT {ACCESS_COLS} FROM acc"""

SQL["access_log_parse_labelled"] = f"""
WITH {EV}
SELECT file_name, log_date, log_time, ip, login, md5(CAST(event_id AS VARCHAR)) AS cid,
       CASE WHEN long_device THEN 'Terminal ' || repeat('Q', 120)
            WHEN event_id % 3 = 0 THEN 'Terminal Alpha'
            WHEN event_id % 3 = 1 THEN 'Terminal Beta'
            ELSE 'Terminal' END AS device,
       CASE WHEN NOT short THEN 'point: Gate North ' || CAST(event_id % 2 + 1 AS VARCHAR) END AS server,
       'pending' AS flag,
       CASE WHEN event_id % 12 = 0 THEN 'yes' ELSE 'no' END AS investor
FROM ev WHERE is_login"""

SQL["access_log_length_rejects"] = f"""
WITH {EV}
SELECT file_name, log_time, ip, login, 'device longer than 100' AS reason
FROM ev WHERE is_login AND long_device"""

SQL["login_key"] = f"""
WITH {EV}
SELECT file_name, nullif(login, '') AS key, count(*) AS messages FROM ev WHERE is_login GROUP BY ALL"""

SQL["login_event_order"] = f"""
WITH {EV}
SELECT nullif(login, '') AS key, event_id AS line_no,
       row_number() OVER (PARTITION BY login ORDER BY event_id) - 1 AS seq
FROM ev WHERE is_login"""

SQL["log_date_from_file"] = f"""
WITH {EV}
SELECT file_name, log_date, count(*) AS lines FROM ev GROUP BY file_name, log_date"""

SQL["ingest_counters"] = f"""
WITH {EV}
SELECT file_name, count(*) AS lines, CAST(count_if(is_login) AS BIGINT) AS sent, CAST(count_if(NOT is_login) AS BIGINT) AS skipped,
       CAST(count_if(is_login AND NOT long_device) AS BIGINT) AS inserted, CAST(count_if(is_login AND long_device) AS BIGINT) AS rejected
FROM ev GROUP BY file_name"""

SQL["app_log_parse"] = f"""
WITH {APP}
SELECT line_no, "timestamp", level, user_id, endpoint, method, status, duration_ms, ip, error
FROM app_parsed"""

SQL["app_log_typed"] = f"""
WITH {APP}
SELECT * FROM app_typed"""

SQL["kv_last_wins"] = f"""
WITH {APP}
SELECT line_no, "timestamp", level, status, 1 AS overrides FROM app_parsed WHERE v IN (2, 4)"""

SQL["app_log_rejects"] = f"""
WITH {APP}
SELECT line_no, 'fewer than 2 fields' AS reason,
       CASE WHEN v = 1 THEN 'malformed line ' || CAST(line_no AS VARCHAR) ELSE '' END AS preview90, preview90 AS raw
FROM app2 WHERE v IN (1, 8)
UNION ALL
SELECT line_no, CASE WHEN v = 3 THEN 'status is not an integer' ELSE 'timestamp is not a timestamp' END AS reason,
       substring(line, 1, 90) AS preview90, line AS raw
FROM app_parsed WHERE v IN (3, 7)"""

SQL["status_severity"] = f"""
WITH {APP}
SELECT status, rpad(CASE WHEN status >= 500 THEN 'ERROR' WHEN status >= 400 THEN 'WARN' ELSE 'INFO' END, 5, ' ') AS severity,
       count(*) AS lines
FROM app_typed WHERE status IS NOT NULL GROUP BY status"""

SQL["orders_json_encode"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS key,
       CAST(json_object('order_id', o_orderkey, 'customer', 'customer_' || CAST(o_custkey AS VARCHAR),
                        'item', 'widget', 'quantity', 2 * (o_orderkey % 50)) AS VARCHAR) AS value
FROM orders"""

SQL["orders_json_decode"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderkey AS order_id,
       'customer_' || CAST(o_custkey AS VARCHAR) AS customer, 'widget' AS item,
       2 * (o_orderkey % 50) AS quantity
FROM orders"""

SQL["topic_catalog"] = f"""
WITH {ENV}
SELECT topic, count(DISTINCT "partition") AS partitions FROM env
WHERE NOT starts_with(topic, '__') GROUP BY topic ORDER BY topic"""

SQL["partition_offsets"] = f"""
WITH {ENV}
SELECT topic, "partition", low, high FROM wm"""

SQL["consumer_lag"] = f"""
WITH {ENV}
SELECT topic, "partition", low, high, committed, lag,
       CASE WHEN lag = 0 THEN 'OK' ELSE 'BEHIND by ' || format('{{:,}}', lag) END AS status
FROM lag"""

SQL["consumer_lag_total"] = f"""
WITH {ENV}
SELECT topic, "partition", CAST(sum(lag) AS BIGINT) AS total_lag FROM lag GROUP BY ROLLUP (topic, "partition")"""

SQL["stream_access_log"] = f"""
WITH {EV}, {ACC}
SELECT {ACCESS_COLS} FROM acc WHERE NOT long_device"""

SQL["stream_app_log"] = f"""
WITH {APP}
SELECT "timestamp", level, user_id, endpoint, method, status, duration_ms, ip, error FROM app_typed"""

# CRC32 of each key (reflected polynomial 0xEDB88320, init and final xor
# 0xFFFFFFFF) by a recursive CTE with one row per byte and bit. Keys are
# decimal logins, so each character is one byte.
SQL["key_partition"] = f"""
WITH RECURSIVE {EV},
keys AS (SELECT login AS key, count(*) AS messages FROM ev WHERE is_login AND login <> '' GROUP BY login),
st(key, pos, bit, crc) AS (
  SELECT key, 0, 8, CAST(4294967295 AS BIGINT) FROM keys
  UNION ALL
  SELECT key,
         CASE WHEN bit = 8 THEN pos + 1 ELSE pos END,
         CASE WHEN bit = 8 THEN 0 ELSE bit + 1 END,
         CASE WHEN bit = 8 THEN xor(crc, CAST(ascii(substr(key, pos + 1, 1)) AS BIGINT))
              WHEN crc & 1 = 1 THEN xor(crc >> 1, CAST(3988292384 AS BIGINT))
              ELSE crc >> 1 END
  FROM st WHERE NOT (pos = length(key) AND bit = 8))
SELECT k.key, CAST(xor(s.crc, CAST(4294967295 AS BIGINT)) % 3 AS INTEGER) AS "partition", k.messages
FROM keys k JOIN st s ON s.key = k.key AND s.pos = length(k.key) AND s.bit = 8
UNION ALL
SELECT NULL, NULL, count(*) FROM ev WHERE is_login AND login = '' HAVING count(*) > 0"""

SQL["orders_json_rejects"] = """
SELECT o_orderkey,
       CASE o_orderkey % 8 WHEN 1 THEN 'missing or mistyped: quantity'
            WHEN 2 THEN 'missing or mistyped: customer, item, quantity'
            WHEN 5 THEN 'value is not UTF-8' WHEN 6 THEN 'value is missing'
            ELSE 'not an order message' END AS reason
FROM orders WHERE o_orderkey % 8 <> 0"""

ONE_DAY = "'trading_20310705.log' AS file_name, DATE '2031-07-05' AS log_date"

SQL["stream_topic_access_log"] = f"""
WITH {EV}, {ACC}
SELECT * REPLACE ({ONE_DAY}) FROM (
SELECT {ACCESS_COLS} FROM acc WHERE NOT long_device
UNION ALL
SELECT file_name, log_date, log_time, ip, login, 'unknown' AS cid,
       CASE event_id % 3 WHEN 0 THEN 'Terminal Alpha)' WHEN 1 THEN 'Terminal Beta)' ELSE 'Terminal)' END AS device,
       'Unknown' AS server, 'pending' AS flag, 'no' AS investor
FROM ev WHERE event_type = 'signup')"""

SQL["stream_counters"] = f"""
WITH {EV}
SELECT count(*) AS lines, CAST(count_if(is_login) AS BIGINT) AS sent, CAST(count_if(NOT is_login) AS BIGINT) AS skipped,
       CAST(count_if(is_login AND NOT long_device) AS BIGINT) AS inserted,
       CAST(count_if(is_login AND long_device) AS BIGINT) AS rejected
FROM ev"""

SQL["undated_rejects"] = f"""
WITH {EV}
SELECT 'no date in the file name' AS reason, 'trading_today.log' AS topic, count(*) AS lines, count(*) AS whole_lines
FROM ev WHERE is_login HAVING count(*) > 0"""

SQL["close_day_two_feeds"] = f"""
WITH {EV}, {ACC}
SELECT * REPLACE ({ONE_DAY}) FROM (
SELECT a.file_name, a.log_date, a.log_time, a.ip, a.login, a.cid, a.device, a.server,
       CASE WHEN a.ip IN (SELECT ip FROM ev WHERE is_usable) THEN 'trade' ELSE 'lilo' END AS flag, a.investor
FROM acc a WHERE NOT a.long_device)"""

SQL["close_day_empty"] = f"""
WITH {EV}
SELECT DATE '2031-07-05' AS log_date, count(*) AS lines_scanned,
       count(DISTINCT CASE WHEN is_usable THEN ip END) AS trade_ips,
       CAST(0 AS BIGINT) AS trade_count, CAST(0 AS BIGINT) AS lilo_count
FROM ev"""

SQL["utf16_day_scan"] = SQL["trade_scan_summary"]

SQL["mixed_encoding_scan"] = f"""
SELECT *, lines_scanned AS whole_lines FROM ({SQL["trade_scan_summary"]})"""

SQL["stream_mixed_encodings"] = SQL["stream_access_log"]

SQL["close_day_late_row"] = f"""
WITH {EV}, {ACC}
SELECT * REPLACE ({ONE_DAY}) FROM (
SELECT a.file_name, a.log_date, a.log_time, a.ip, a.login, a.cid, a.device, a.server,
       CASE WHEN a.ip IN (SELECT ip FROM ev WHERE is_usable) THEN 'trade' ELSE 'lilo' END AS flag, a.investor,
       CASE WHEN a.event_id % 97 = 5 THEN 2 ELSE 1 END AS close_no
FROM acc a WHERE NOT a.long_device)"""

SQL["stream_growing_file"] = SQL["stream_access_log"]

SQL["stream_once_per_record"] = f"""
WITH {EV}, {ACC}
SELECT * REPLACE ({ONE_DAY}) FROM (SELECT {ACCESS_COLS} FROM acc WHERE NOT long_device)"""

SQL["raw_compacted"] = SQL["stream_once_per_record"]

SQL["stream_login_order"] = SQL["login_event_order"]

SQL["trade_ip_logins_by_month"] = f"""
WITH {EV}
SELECT CAST(date_trunc('month', log_date) AS DATE) AS month, ip, count(DISTINCT login) AS n_logins
FROM ev WHERE is_usable GROUP BY ALL"""

SQL["ingest_rate_by_minute"] = """
SELECT CASE WHEN event_type = 'signup' THEN '__internal' ELSE event_type END AS topic,
       date_trunc('minute', ts) AS window_start, count(*) AS records, round(count(*) / 60, 6) AS per_second
FROM events WHERE ts IS NOT NULL GROUP BY ALL"""

PARTS = """
lim AS (SELECT max(event_id) AS last FROM ev WHERE is_login),
rec AS (
  SELECT event_id AS "offset", CAST(event_id % 3 AS INTEGER) AS "partition",
         CASE WHEN event_id <= last // 3 THEN 0 WHEN event_id <= last * 2 // 3 THEN 1 ELSE 2 END AS part
  FROM ev, lim WHERE is_login)"""

SQL["lag_trend"] = f"""
WITH {EV}, {PARTS},
b AS (
  SELECT s.part AS batch_id, 'trading-access-logs' AS topic, r."partition",
         max(CASE WHEN r.part = s.part THEN r."offset" END) + 1 AS committed,
         max(CASE WHEN r.part <= s.part + 1 THEN r."offset" END) + 1 AS high,
         count(CASE WHEN r.part = s.part THEN 1 END) AS records
  FROM rec r, (SELECT DISTINCT part FROM rec) s GROUP BY ALL),
l AS (SELECT *, greatest(high - committed, 0) AS lag FROM b WHERE records > 0)
SELECT CAST(batch_id AS BIGINT) AS batch_id, topic, "partition", committed, high, records, lag,
       lag - lag(lag) OVER (PARTITION BY "partition" ORDER BY batch_id) AS lag_change
FROM l"""

SQL["consumer_lag_recorded"] = f"""
WITH {EV}, {PARTS},
p AS (
  SELECT 'trading-access-logs' AS topic, "partition", min("offset") AS low, max("offset") + 1 AS high,
         coalesce(max(CASE WHEN part < 2 THEN "offset" END) + 1, 0) AS committed
  FROM rec GROUP BY ALL)
SELECT *, high - committed AS lag,
       CASE WHEN high = committed THEN 'OK' ELSE 'BEHIND by ' || format('{{:,}}', high - committed) END AS status
FROM p"""

SQL["pending_after_close"] = f"""
WITH {EV}, {ACC}
SELECT * REPLACE ({ONE_DAY}) FROM (SELECT {ACCESS_COLS} FROM acc WHERE NOT long_device AND event_id % 2 = 1)"""

SQL["close_day_folded"] = SQL["close_day_two_feeds"]
