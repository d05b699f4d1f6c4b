"""SQL with the same result as every query of :mod:`weighline.plans.queries`, for an independent engine."""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def _zone(x: str) -> str:
    return f"({x} AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Madrid')"


def _utc(x: str) -> str:
    return f"({x} AT TIME ZONE 'Europe/Madrid' AT TIME ZONE 'UTC')"


def _stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


SHIFT = f"CASE WHEN hour({_zone('timestamp')}) BETWEEN 6 AND 13 THEN 'Manana' ELSE 'Tarde' END"

EV = """ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"""

W = EV + """,
w AS (SELECT event_id AS identity, ts AS timestamp, 'factory/zone_' || (user_id % 2) AS mqtt_topic,
       'Line_' || lpad(CAST(user_id % 6 AS VARCHAR), 2, '0') AS linea, 'A-10' || ((event_id // 50) % 5) AS article_number,
       event_type AS article_name, value AS net_weight, CASE WHEN k % 10 = 0 THEN 1 ELSE 0 END AS reject_flag,
       'uuid-' || event_id AS record_uuid, 'B/' || (event_id // 500) AS batch_code,
       ts + to_seconds(k * 20) AS server_time FROM ev)"""

M = W + """,
m AS (SELECT w.*, coalesce(a.name, 'UNKNOWN_PRODUCT') AS article,
       CASE linea WHEN 'Line_00' THEN 4 WHEN 'Line_01' THEN 8 WHEN 'Line_02' THEN 100 ELSE 1 END AS active_workers,
       net_weight * 1000.0 AS clean_net_weight_g, CASE WHEN reject_flag <> 0 THEN 'REJECTED' ELSE 'OK' END AS quality_status,
       """ + SHIFT + """ AS shift
      FROM w LEFT JOIN (VALUES ('A-100', 'Alpha Mix'), ('A-101', 'Beta Mix'), ('A-102', 'Gamma (Mix)'),
                               ('A-103', 'Delta/Mix')) a(code, name) ON w.article_number = a.code)"""

_LINE = "PARTITION BY mqtt_topic, linea ORDER BY timestamp, identity, article"

_STEPS = f""",
s1 AS (SELECT *, lag(timestamp) OVER ({_LINE}) AS pt, lag(article) OVER ({_LINE}) AS pa,
        lead(timestamp) OVER ({_LINE}) AS nt FROM m),
s2 AS (SELECT *, CASE WHEN pt IS NULL OR CAST(pt AS DATE) <> CAST(timestamp AS DATE) OR pa <> article THEN 'new_article'
        WHEN epoch_us(timestamp) - epoch_us(pt) > 3600000000
          OR CAST({_zone('timestamp')} AS DATE) > CAST({_zone('pt')} AS DATE) THEN 'timeout' END AS flag FROM s1),
s3 AS (SELECT *, sum(CASE WHEN flag IS NULL THEN 0 ELSE 1 END) OVER ({_LINE} ROWS UNBOUNDED PRECEDING) AS run FROM s2),
b0 AS (SELECT mqtt_topic, linea, run, min(article) AS article, min(flag) AS reason, min(timestamp) AS start_time,
        max(timestamp) AS end_time, min(identity) AS start_identity, count(*) AS packages,
        sum(CASE WHEN quality_status = 'OK' THEN clean_net_weight_g ELSE 0 END) AS net_g,
        CAST(sum(CASE WHEN quality_status = 'OK' THEN 1 ELSE 0 END) AS BIGINT) AS units_ok,
        CAST(sum(CASE WHEN quality_status = 'REJECTED' THEN 1 ELSE 0 END) AS BIGINT) AS units_rejected,
        sum(active_workers) AS workers_sum FROM s3 GROUP BY 1, 2, 3),
b1 AS (SELECT *, row_number() OVER (PARTITION BY mqtt_topic, article ORDER BY start_time, linea, run) AS seq,
        lead(start_time) OVER (PARTITION BY mqtt_topic, linea ORDER BY run) AS closed_at FROM b0),
b AS (SELECT *, regexp_replace(printf('%s_%04d', article, seq), '[^\\p{{L}}\\p{{N}}._-]', '', 'g') AS batch_instance_id,
        CAST(start_time AS DATE) AS utc_date,
        coalesce(CAST(closed_at AS DATE) = CAST(start_time AS DATE), false) AS recorded FROM b1)"""

SEG = M + _STEPS

_CLOSED = """,
c AS (SELECT *, row_number() OVER (PARTITION BY mqtt_topic, utc_date ORDER BY closed_at, linea, run) AS rk
      FROM b WHERE recorded),
n AS (SELECT b.*, (SELECT count(*) FROM c WHERE c.mqtt_topic = b.mqtt_topic AND c.utc_date = b.utc_date
                   AND c.closed_at <= b.start_time) AS before FROM b WHERE reason = 'new_article'),
r0 AS (SELECT n.mqtt_topic, n.article, n.linea, n.batch_instance_id, n.start_time AS curr_start, p.linea AS origin_line,
        p.start_time AS prev_start, p.end_time AS prev_end,
        row_number() OVER (PARTITION BY n.mqtt_topic, n.linea, n.run ORDER BY p.rk) AS pick
       FROM n JOIN c p ON p.mqtt_topic = n.mqtt_topic AND p.utc_date = n.utc_date AND p.article = n.article
        AND p.closed_at <= n.start_time AND p.end_time < n.start_time AND n.before - p.rk < {cap})"""

_RET = """,
ret AS (SELECT mqtt_topic, mqtt_topic || '/' || linea AS topic, 'GLOBAL_RETURN' AS alert_type, article AS product,
        origin_line, linea AS current_line, batch_instance_id, prev_start, prev_end, curr_start,
        (epoch_us(curr_start) - epoch_us(prev_end)) / 1000000.0 AS gap_seconds FROM r0 WHERE pick = 1)"""


def _returns(cap: int = 50) -> str:
    return SEG + _CLOSED.format(cap=cap) + _RET


def _fire(last: str) -> str:
    return (f"greatest({last} + INTERVAL 600 SECOND, "
            + _utc(f"(CAST(CAST({_zone(last)} AS DATE) AS TIMESTAMP) + INTERVAL 6 HOUR)") + ")")


def _watched(last: str, fire: str) -> str:
    tod = lambda x: f"CAST({_zone(x)} AS TIME)"
    return (f"CAST({_zone(last)} AS DATE) = CAST({_zone(fire)} AS DATE) AND "
            f"{tod(fire)} < CASE WHEN {tod(last)} < TIME '15:00:00' THEN TIME '13:30:00' ELSE TIME '19:30:00' END")


STOPS = SEG + f""",
f0 AS (SELECT *, {_fire('timestamp')} AS fire,
        CASE WHEN server_time > timestamp THEN (epoch_us(server_time) - epoch_us(timestamp)) / 1000000.0 ELSE 0 END AS lag
       FROM s3),
f1 AS (SELECT * FROM f0 WHERE (nt IS NULL OR fire < nt) AND {_watched('timestamp', 'fire')}),
stop AS (SELECT f1.mqtt_topic, f1.mqtt_topic || '/' || f1.linea AS topic, 'LINE STOP (>10min)' AS alert_type,
        f1.article AS product, f1.linea AS origin_line, 'UNEXPECTED STOP' AS current_line, b.batch_instance_id,
        b.start_time AS prev_start, f1.timestamp AS prev_end, fire AS curr_start,
        (epoch_us(fire) - epoch_us(f1.timestamp)) / 1000000.0 AS gap_seconds, lag
       FROM f1 JOIN b USING (mqtt_topic, linea, run))"""

_STOP_MSG = ("'STOP DETECTED: ' || origin_line || ' has been inactive for ' || CAST(floor(gap_seconds / 60) AS BIGINT) "
             "|| ' minutes (last product: ' || product || ')'")

RAW = EV + """,
raw AS (SELECT *, event_id AS i,
        CASE WHEN event_id % 13 = 0 THEN 'office/hvac' WHEN event_id % 13 = 1 THEN 'factory'
             ELSE 'factory/zone_' || (user_id % 2) END AS topic, ts + INTERVAL 5 SECOND AS received_at FROM ev)"""

REC = RAW + f""",
one AS (SELECT *, 'Line_' || lpad(CAST(user_id % 6 AS VARCHAR), 2, '0') AS linea, 'A-10' || ((i // 50) % 5) AS article_number,
        printf('%.2f', value) AS wt,
        CASE WHEN i % 11 = 0 THEN '25:99' WHEN i % 5 = 0 THEN strftime(ts, '%H:%M')
             WHEN i % 5 = 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS time_text,
        CASE WHEN i % 11 = 0 THEN received_at
             WHEN i % 5 = 0 THEN {_utc("(CAST(CAST(" + _zone('received_at') + " AS DATE) AS TIMESTAMP) + to_hours(CAST(hour(ts) AS INTEGER)) + to_minutes(CAST(minute(ts) AS INTEGER)))")}
             WHEN i % 5 = 1 THEN ts ELSE date_trunc('second', ts) END AS base
      FROM raw WHERE (topic = 'factory' OR topic LIKE 'factory/%') AND i % 20 NOT IN (3, 8)),
rec AS (SELECT one.* FROM one, (VALUES (1), (2)) copies(c) WHERE c = 1 OR i % 7 = 0),
can AS (SELECT i, CASE WHEN i % 3 = 0 THEN 'factory/own' ELSE topic END AS mqtt_topic, linea, CAST(i AS VARCHAR) AS identity,
        event_type AS article_name, article_number,
        CASE WHEN i % 3 = 0 AND i % 17 = 0 THEN 'sensor_error' WHEN i % 3 = 1 THEN replace(wt, '.', ',')
         WHEN i % 3 = 0 THEN CAST(CAST(wt AS DOUBLE) AS VARCHAR) ELSE wt END AS net_weight,
        time_text, base, CASE WHEN i % 3 = 1 THEN 'uuid-' || i END AS record_uuid,
        CASE WHEN i % 3 = 1 THEN CAST(k % 2 AS VARCHAR) END AS reject_flag,
        CASE WHEN i % 3 = 0 THEN ' ok ' END AS quality_status, received_at, CAST(wt AS DOUBLE) AS number
      FROM rec)"""

ORACLE["ingest_parse"] = f"""WITH {REC} SELECT mqtt_topic, linea, identity, article_name, article_number, net_weight,
 time_text, record_uuid, reject_flag, quality_status, received_at FROM can"""
ORACLE["topic_filter"] = f"""WITH {RAW} SELECT topic, count(*) AS messages FROM raw
 WHERE topic = 'factory' OR topic LIKE 'factory/%' GROUP BY 1"""
ORACLE["dead_letters"] = f"""WITH {RAW} SELECT received_at AS timestamp, topic,
 CASE WHEN i % 20 = 3 THEN 'json_decode_error' ELSE 'not_an_object' END AS reason,
 CASE WHEN i % 20 = 3 THEN substring('{{"identity": 12345, "net', 1, CAST(5 + i % 10 AS INTEGER)) ELSE '[1,2]' END AS data
 FROM raw WHERE (topic = 'factory' OR topic LIKE 'factory/%') AND i % 20 IN (3, 8)"""
ORACLE["retry_split"] = f"""WITH {RAW} SELECT event_id, topic, CAST(i % 4 + 1 AS INTEGER) AS attempts,
 CASE WHEN i % 4 + 1 < 3 THEN 'retry' ELSE 'dead_letter' END AS action,
 CASE WHEN i % 4 + 1 >= 3 THEN 'max_retries_exceeded' END AS reason FROM raw"""
ORACLE["throughput_topic"] = f"""WITH {RAW} SELECT topic, date_trunc('minute', received_at) AS minute, count(*) AS messages
 FROM raw GROUP BY 1, 2"""
ORACLE["backlog_topic"] = f"""WITH {RAW}, m AS (SELECT topic, received_at AS t, 1 AS i, 0 AS o FROM raw UNION ALL
  SELECT topic, received_at + to_seconds(event_id % 300), 0, 1 FROM raw WHERE event_id % 50 <> 0),
 g AS (SELECT topic, date_trunc('minute', t) AS minute, CAST(sum(i) AS BIGINT) AS arrived, CAST(sum(o) AS BIGINT) AS processed FROM m GROUP BY 1, 2)
 SELECT topic, minute, arrived, processed, CAST(sum(arrived - processed) OVER (PARTITION BY topic ORDER BY minute) AS BIGINT) AS waiting FROM g"""
ORACLE["alias_coalesce"] = f"""WITH {REC} SELECT mqtt_topic, linea, article_number, identity, net_weight, record_uuid, reject_flag,
 time_text FROM can"""
ORACLE["clean_weighings"] = f"""WITH {REC} SELECT mqtt_topic, linea, i AS identity, base + to_microseconds(i % 10000000) AS timestamp,
 number AS net_weight, article_name, article_number, record_uuid, CAST(reject_flag AS DOUBLE) AS reject_flag
 FROM can WHERE net_weight <> 'sensor_error'"""
ORACLE["clean_strict"] = f"""WITH {REC} SELECT mqtt_topic, linea, i AS identity,
 CASE WHEN net_weight = 'sensor_error' OR net_weight LIKE '%,%' THEN NULL ELSE number END AS net_weight FROM can"""
ORACLE["parse_hhmm"] = f"""WITH t AS (SELECT event_id, ts, (event_id * 7) % 26 AS h, (event_id * 13) % 62 AS mi FROM events),
 u AS (SELECT *, CASE WHEN h <= 23 AND mi <= 59 THEN
  {_utc("(CAST(CAST(" + _zone('ts') + " AS DATE) AS TIMESTAMP) + to_hours(CAST(h AS INTEGER)) + to_minutes(CAST(mi AS INTEGER)))")} END AS parsed FROM t)
 SELECT event_id, h || ':' || lpad(CAST(mi AS VARCHAR), 2, '0') AS clock, parsed, coalesce(parsed, ts) AS resolved FROM u"""
ORACLE["jitter"] = """SELECT event_id, date_trunc('minute', ts) + to_microseconds((event_id * 1234567) % 10000000) AS jittered
 FROM events"""
ORACLE["jitter_quality"] = f"""WITH {W}, j AS (SELECT mqtt_topic, CASE WHEN identity % 9 <> 0 THEN
  date_trunc('hour', timestamp) + to_microseconds(identity % 40) END AS t FROM w)
 SELECT mqtt_topic, count(*) AS total_rows, count(DISTINCT t) AS unique_times, count(t) - count(DISTINCT t) AS equal_times,
  count(*) - count(t) AS missing_times, min(t) AS first_time, max(t) AS last_time FROM j GROUP BY 1"""
ORACLE["shift_label"] = f"""WITH {W} SELECT identity, linea, {SHIFT} AS shift FROM w"""
ORACLE["display_time"] = f"""WITH t AS (SELECT event_id, ts + to_microseconds(event_id * 5000000000) AS u FROM events)
 SELECT event_id, {_zone('u')} AS local_time FROM t"""
ORACLE["ts_fill"] = """SELECT event_id, TIMESTAMP '2024-02-01 00:00:00' - to_microseconds(10000 *
  (count(*) OVER () - row_number() OVER (ORDER BY event_id))) AS timestamp FROM events"""
ORACLE["ts_invalid"] = """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN TIMESTAMP '2024-02-01 00:00:00'
  ELSE date_trunc('second', ts) END AS timestamp FROM events"""
ORACLE["weight_text"] = """SELECT event_id, round(CASE event_id % 4 WHEN 0 THEN CAST(printf('%.2f', value) AS DOUBLE) * 1000.0
  WHEN 1 THEN CAST(printf('%.2f', value) AS DOUBLE) * 1000.0 WHEN 2 THEN 1000.0 + event_id % 1000 END, 4) AS grams FROM events"""
ORACLE["business_fields"] = f"""WITH {W} SELECT identity,
 round(net_weight * 1000.0 - CASE WHEN identity % 3 = 0 THEN 12.5 ELSE 0.0 END, 4) AS clean_net_weight_g,
 CAST(CASE WHEN identity % 3 = 0 THEN 12.5 ELSE 0.0 END AS DOUBLE) AS tare_g,
 CASE WHEN identity % 5 = 0 THEN 'WARN' WHEN reject_flag <> 0 THEN 'REJECTED' ELSE 'OK' END AS quality_status,
 {SHIFT} AS shift, CAST(CASE WHEN identity % 4 = 0 THEN identity % 7 ELSE 1 END AS INTEGER) AS active_workers FROM w"""
ORACLE["enrich_workers"] = f"""WITH {M} SELECT identity, active_workers FROM m"""
_TARGET = """CASE WHEN article_number = 'A-100' THEN 55.5 WHEN article_number = 'A-101' THEN 0.0
  WHEN article_name = 'view' THEN 120.0 WHEN article_name = 'click' THEN 80.25 ELSE 15.0 END"""
ORACLE["enrich_targets"] = f"""WITH {W} SELECT identity, article_number, article_name,
 CAST({_TARGET} AS DOUBLE) AS target_value FROM w"""
ORACLE["target_for"] = f"""WITH {W}, k AS (SELECT article_number AS key FROM w UNION SELECT article_name FROM w)
 SELECT key, CASE key WHEN 'A-100' THEN '55.5' WHEN 'A-101' THEN 'Not a Number' WHEN 'view' THEN '120.0' WHEN 'click' THEN '80.25' ELSE '15.0' END AS target FROM k"""
ORACLE["flat_columns"] = f"""WITH {W} SELECT identity, net_weight, article_name, article_number, 'unused' AS "ItemCode", linea FROM w"""
ORACLE["map_articles"] = f"""WITH {M} SELECT identity, article_number, article AS number_refactor FROM m"""
ORACLE["giveaway"] = f"""WITH {W} SELECT identity, CAST({_TARGET} AS DOUBLE) AS target_weight_g,
 round(net_weight * 1000.0 - CAST({_TARGET} AS DOUBLE), 4) AS giveaway_g, 0 AS quality_mismatch FROM w"""
_UPD = """up AS (SELECT event_id, ts AS timestamp, CASE WHEN event_id % 10 = 0 THEN 'bad line!' WHEN event_id % 10 = 1 THEN NULL
   ELSE 'Linea_02' || lpad(CAST(user_id % 40 AS VARCHAR), 2, '0') END AS line_id,
  CASE WHEN event_id % 9 = 0 THEN 'many' WHEN event_id % 9 = 1 THEN '-3' ELSE CAST(CAST(floor(value) AS BIGINT) % 120 AS VARCHAR) END AS workers FROM events),
 judged AS (SELECT *, CASE WHEN line_id IS NULL THEN 'missing_field' WHEN line_id = 'bad line!' THEN 'bad_line_id'
   WHEN workers = 'many' THEN 'bad_number' WHEN CAST(workers AS INTEGER) NOT BETWEEN 0 AND 100 THEN 'out_of_range' END AS reason FROM up)"""
ORACLE["worker_updates_valid"] = f"""WITH {_UPD} SELECT event_id, line_id, reason IS NULL AS accepted, reason,
 CASE WHEN reason IS NULL THEN CAST(workers AS INTEGER) END AS new_worker_count FROM judged"""
ORACLE["workers_latest"] = f"""WITH {_UPD}, ok AS (SELECT *, CAST(workers AS INTEGER) AS c FROM judged WHERE reason IS NULL),
 r AS (SELECT *, row_number() OVER (PARTITION BY line_id ORDER BY timestamp DESC, c DESC) AS rn,
  count(*) OVER (PARTITION BY line_id) AS changes FROM ok)
 SELECT line_id, c AS workers, timestamp AS changed_at, changes FROM r WHERE rn = 1"""
_MARK = """mark AS (SELECT mqtt_topic, identity AS last_identity, record_uuid AS last_uuid, timestamp AS last_timestamp, n AS record_count
  FROM (SELECT *, count(*) OVER (PARTITION BY mqtt_topic) AS n,
   row_number() OVER (PARTITION BY mqtt_topic ORDER BY timestamp DESC, identity DESC) AS rn FROM {src}) WHERE rn = 1)"""
ORACLE["ingest_watermark"] = f"""WITH {W}, {_MARK.format(src='w')} SELECT * FROM mark"""
ORACLE["dedup_identity"] = f"""WITH {W}, past AS (SELECT * FROM w WHERE timestamp < TIMESTAMP '2024-01-15' AND mqtt_topic = 'factory/zone_0'),
 {_MARK.format(src='past')} SELECT w.mqtt_topic, linea, identity, timestamp FROM w LEFT JOIN mark USING (mqtt_topic)
 WHERE last_identity IS NULL OR identity > last_identity OR last_identity - identity > 1000"""
ORACLE["rollover"] = f"""WITH {W} SELECT mqtt_topic, linea, timestamp, identity % 4000 AS identity,
 (identity % 4000 > 3500 OR 3500 - identity % 4000 > 1000) AS is_new FROM w"""
ORACLE["watermark_merge"] = f"""WITH {W}, e AS (SELECT *, 0 AS part FROM w WHERE timestamp < TIMESTAMP '2024-01-15'
  UNION ALL SELECT *, 1 FROM w WHERE timestamp < TIMESTAMP '2024-01-10'
   OR (mqtt_topic = 'factory/zone_1' AND timestamp >= TIMESTAMP '2024-01-20')),
 l AS (SELECT *, row_number() OVER (PARTITION BY mqtt_topic, part ORDER BY identity > 0 DESC, timestamp DESC, identity DESC) AS rn,
   count(*) OVER (PARTITION BY mqtt_topic, part) AS record_count FROM e),
 m AS (SELECT *, row_number() OVER (PARTITION BY mqtt_topic ORDER BY timestamp DESC, identity DESC, record_uuid DESC, record_count DESC) AS r2
   FROM l WHERE rn = 1)
 SELECT mqtt_topic, identity AS last_identity, record_uuid AS last_uuid, timestamp AS last_timestamp, record_count FROM m WHERE r2 = 1"""
ORACLE["requeue"] = f"""WITH {RAW} SELECT event_id, topic, CAST(CASE WHEN i % 3 = 0 THEN i % 4 + 1 ELSE i % 4 END AS INTEGER) AS attempts,
 i % 3 = 0 AS retried FROM raw WHERE i % 3 <> 0 OR i % 4 + 1 < 3"""
ORACLE["dedup_within"] = f"""WITH {W} SELECT mqtt_topic, linea, identity, timestamp FROM w"""
_B = """mqtt_topic, linea, article, batch_instance_id, seq AS batch_sequence, reason, start_time, end_time, closed_at, recorded,
 CAST(utc_date AS VARCHAR) AS utc_date"""
ORACLE["batches"] = f"""WITH {SEG} SELECT {_B}, packages, round(net_g / 1000, 4) AS kg, units_rejected FROM b"""
ORACLE["batches_lineitem"] = f"""WITH li AS (SELECT *, l_orderkey * 8 + l_linenumber AS identity FROM lineitem),
 m AS (SELECT identity, l_shipdate + to_seconds(identity % 86400) AS timestamp, 'factory/zone_' || (l_suppkey % 2) AS mqtt_topic,
  'Line_' || ((l_suppkey // 2) % 6) AS linea, 'P-' || (l_partkey % 3) AS article, 1 AS active_workers,
  l_quantity / 100 * 1000 AS clean_net_weight_g, CASE WHEN l_returnflag = 'R' THEN 'REJECTED' ELSE 'OK' END AS quality_status
  FROM li){_STEPS} SELECT mqtt_topic, linea, article, seq AS batch_sequence, reason, start_time, end_time, closed_at, recorded,
  packages, units_rejected FROM b"""
ORACLE["article_changes"] = f"""WITH {SEG} SELECT mqtt_topic, linea, timestamp AS changed_at, pa AS previous_article, article
 FROM s1 WHERE pa IS NULL OR pa <> article"""
ORACLE["weighings_with_batch"] = f"""WITH {SEG} SELECT s3.identity, mqtt_topic, linea, s3.timestamp, batch_instance_id,
 seq AS batch_sequence, b.start_time AS batch_start_time FROM s3 JOIN b USING (mqtt_topic, linea, run)"""
ORACLE["recent_batches"] = f"""WITH {SEG}, r AS (SELECT *, row_number() OVER (PARTITION BY mqtt_topic ORDER BY closed_at DESC,
  linea DESC, start_time DESC, batch_instance_id DESC) AS recency FROM b WHERE closed_at IS NOT NULL)
 SELECT mqtt_topic, recency, batch_instance_id, linea, start_time, closed_at FROM r WHERE recency <= 50"""
_PATH = """'packaging/daily_production/' || replace(mqtt_topic, '/', '_') || '/' || strftime(utc_date, '%Y/%m') || '/report_'
  || strftime(utc_date, '%Y-%m-%d') || '.json'"""
ORACLE["daily_report"] = f"""WITH {SEG} SELECT mqtt_topic AS topic, CAST(utc_date AS VARCHAR) AS date,
 row_number() OVER (PARTITION BY mqtt_topic, utc_date ORDER BY closed_at, linea, start_time, seq, article) AS position,
 article, linea AS device, batch_instance_id AS batch_id, seq AS batch_sequence, reason,
 {_stamp(_zone('start_time'))} AS start_time, {_stamp(_zone('end_time'))} AS end_time, {_PATH} AS path FROM b WHERE recorded"""
ORACLE["daily_totals"] = f"""WITH {SEG} SELECT mqtt_topic AS topic, CAST(utc_date AS VARCHAR) AS date,
 count(CASE WHEN recorded THEN 1 END) AS total_changes, {_stamp(_zone('max(end_time)'))} AS last_update,
 count(*) AS batches_started FROM b GROUP BY 1, utc_date, 2"""
ORACLE["line_status"] = f"""WITH {SEG}, r AS (SELECT *, row_number() OVER (PARTITION BY mqtt_topic, linea ORDER BY run DESC) AS rn,
  count(*) OVER (PARTITION BY mqtt_topic, linea) AS batches FROM b)
 SELECT mqtt_topic, linea, mqtt_topic || '/' || linea AS topic, article, batch_instance_id, seq AS batch_sequence, reason,
  start_time, end_time AS last_seen, {_stamp(_zone('end_time'))} AS last_seen_local, batches FROM r WHERE rn = 1"""
ORACLE["article_counters"] = f"""WITH {SEG} SELECT mqtt_topic, article, count(*) AS last_sequence FROM b GROUP BY 1, 2"""
_RET_MSG = ("'GLOBAL RETURN: ' || product || ' — previously on ' || origin_line || ' (ended ' || strftime("
            + _zone("prev_end") + ", '%H:%M:%S') || ', gap ' || printf('%.1f', gap_seconds / 3600) || 'h)'")
ORACLE["return_alerts"] = f"""WITH {_returns()} SELECT *, {_RET_MSG} AS message FROM ret"""
ORACLE["return_alerts_cap5"] = f"""WITH {_returns(5)} SELECT topic, batch_instance_id, origin_line, prev_end, curr_start FROM ret"""
ORACLE["stop_alerts"] = f"""WITH {STOPS} SELECT * EXCLUDE (lag), {_STOP_MSG} AS message FROM stop"""
ORACLE["stops_with_lag"] = f"""WITH {STOPS} SELECT topic, product, prev_end, curr_start, gap_seconds FROM stop WHERE lag <= 900"""
_NOW = "TIMESTAMP '2024-01-17 11:40:00'"
ORACLE["stops_now"] = f"""WITH {SEG.replace('FROM m),', f"FROM m WHERE timestamp <= {_NOW}),", 1)},
 l AS (SELECT *, {_fire('timestamp')} AS fire FROM s3 WHERE nt IS NULL),
 q AS (SELECT l.*, b.batch_instance_id, b.start_time AS bs, (epoch_us({_NOW}) - epoch_us(timestamp)) / 1000000.0 AS gap_seconds,
   l.linea AS origin_line, l.article AS product
  FROM l JOIN b USING (mqtt_topic, linea, run) WHERE fire < {_NOW} AND {_watched('timestamp', 'fire')})
 SELECT mqtt_topic, mqtt_topic || '/' || linea AS topic, 'LINE STOP (>10min)' AS alert_type, product, origin_line,
  'UNEXPECTED STOP' AS current_line, batch_instance_id, bs AS prev_start, timestamp AS prev_end, {_NOW} AS curr_start,
  gap_seconds, {_STOP_MSG} AS message FROM q"""
ORACLE["connection_lag"] = f"""WITH {W} SELECT mqtt_topic, linea,
 max(greatest((epoch_us(server_time) - epoch_us(timestamp)) / 1000000.0, 0)) AS max_lag_seconds FROM w GROUP BY 1, 2"""
ORACLE["connection_lag_local_clock"] = f"""WITH {W} SELECT mqtt_topic, linea,
 max(greatest((epoch_us(server_time) - epoch_us({_utc('timestamp')})) / 1000000.0, 0)) AS max_lag_seconds FROM w GROUP BY 1, 2"""
ORACLE["all_alerts"] = f"""WITH {STOPS}{_CLOSED.format(cap=50)}{_RET}, u AS (SELECT topic, alert_type, curr_start, product, origin_line, prev_end, batch_instance_id FROM ret
  UNION ALL SELECT topic, alert_type, curr_start, product, origin_line, prev_end, batch_instance_id FROM stop) SELECT * FROM u"""
ORACLE["alert_text"] = f"""WITH {STOPS} SELECT topic, batch_instance_id, prev_end, 'ALERT: ' || alert_type || ' — ' || topic AS subject,
 replace(upper(origin_line), '_', ' ') AS origin_text, 'UNEXPECTED STOP' AS current_text,
 strftime({_zone('prev_start')}, '%H:%M:%S') AS prev_start_text, strftime({_zone('prev_end')}, '%H:%M:%S') AS prev_end_text,
 strftime({_zone('curr_start')}, '%H:%M:%S') AS curr_start_text, strftime({_zone('curr_start')}, '%d/%m/%Y') AS date_text,
 CAST(floor(gap_seconds / 3600) AS BIGINT) || 'h ' || CAST(floor((gap_seconds % 3600) / 60) AS BIGINT) || 'm' AS gap_text,
 {_STOP_MSG} AS message FROM stop"""
ORACLE["alert_routing"] = f"""WITH {STOPS}, who AS (SELECT * FROM (VALUES ('Ana', 'ana@plant.example'), ('Luis', 'luis@plant.example'),
  ('Zone', 'zone1@plant.example'), ('Duty', 'duty@plant.example')) v(recipient_name, recipient_email))
 SELECT topic, prev_end, recipient_name, recipient_email, 'ALERT: ' || alert_type || ' — ' || topic AS subject FROM stop, who
 WHERE CASE WHEN topic = 'factory/zone_0/Line_00' THEN recipient_name IN ('Ana', 'Luis')
  WHEN topic = 'factory/zone_0/Line_02' THEN false WHEN mqtt_topic = 'factory/zone_1' THEN recipient_name = 'Zone'
  ELSE recipient_name = 'Duty' END"""
_WB = SEG + f""",
 x AS (SELECT s3.*, batch_instance_id, seq, b.start_time AS batch_start, CAST({_TARGET} AS DOUBLE) AS target_value
  FROM s3 JOIN b USING (mqtt_topic, linea, run))"""
ORACLE["hot_rows"] = f"""WITH {_WB} SELECT timestamp, mqtt_topic, linea, batch_code, article_number, article_name, article AS number_refactor,
 batch_instance_id, strftime(batch_start, '%Y-%m-%dT%H:%M:%S.%fZ') AS batch_start_time, seq AS batch_sequence, net_weight,
 round(clean_net_weight_g, 4) AS clean_net_weight_g, CAST(0 AS DOUBLE) AS target_weight_g, CAST(0 AS DOUBLE) AS giveaway_g,
 CAST(0 AS DOUBLE) AS tare_g, quality_status, CAST(0 AS BIGINT) AS quality_mismatch, CAST(reject_flag AS BIGINT) AS reject_flag,
 CAST(active_workers AS BIGINT) AS active_workers, upper(shift) AS shift, record_uuid, identity, target_value, server_time FROM x"""
ORACLE["hot_upsert"] = f"""WITH {M}, h AS (SELECT *, date_trunc('hour', timestamp) AS t FROM m),
 r AS (SELECT *, {SHIFT.replace('timestamp', 't')} AS sh FROM h),
 q AS (SELECT *, row_number() OVER (PARTITION BY mqtt_topic, linea, article_number, article_name, batch_code, quality_status, sh, article, t
   ORDER BY identity DESC) AS rn FROM r)
 SELECT mqtt_topic, linea, t AS timestamp, article_number, article_name, batch_code, quality_status, upper(sh) AS shift, identity, net_weight
 FROM q WHERE rn = 1"""
ORACLE["hot_merge"] = f"""WITH {M}, h AS (SELECT *, date_trunc('hour', timestamp) AS t FROM m),
 q AS (SELECT *, row_number() OVER (PARTITION BY mqtt_topic, linea, article_number, article_name, batch_code, quality_status, article, t
   ORDER BY identity % 2 DESC, identity DESC) AS rn FROM h)
 SELECT mqtt_topic, linea, t AS timestamp, article_number, article_name, batch_code, quality_status, identity, net_weight
 FROM q WHERE rn = 1"""
ORACLE["cold_rows"] = f"""WITH {_WB} SELECT identity, timestamp, CASE WHEN hit THEN quality_status END AS processed_status,
 CASE WHEN hit THEN round(clean_net_weight_g, 4) END AS calculated_net_weight, CASE WHEN hit THEN CAST(0 AS DOUBLE) END AS tare_g,
 CASE WHEN hit THEN batch_instance_id END AS batch_instance_id, CASE WHEN hit THEN seq END AS batch_sequence,
 CASE WHEN hit THEN batch_start END AS batch_start_time,
 CASE WHEN article = 'UNKNOWN_PRODUCT' THEN 'UNKNOWN_REF' ELSE article END AS number_refactor
 FROM (SELECT *, identity % 4 <> 0 AND identity % 10 <> 0 AS hit FROM x)"""
ORACLE["cold_semi"] = f"""WITH {W} SELECT mqtt_topic, identity, CASE WHEN identity % 10 <> 0 THEN record_uuid END AS record_uuid
 FROM w WHERE identity % 4 <> 0"""
ORACLE["cold_paths"] = f"""WITH {SEG} SELECT s3.identity, 'packaging/' || replace(mqtt_topic, '/', '_') || '/' || linea || '/' ||
 strftime({_zone('s3.timestamp')}, '%Y/%m/%d') || '/' || regexp_replace(s3.article, '[^\\p{{L}}\\p{{N}} _-]', '', 'g') || '/' ||
 batch_instance_id AS folder FROM s3 JOIN b USING (mqtt_topic, linea, run)"""
ORACLE["archive_manifest"] = f"""WITH {M}, p AS (SELECT *, 'packaging/' || replace(mqtt_topic, '/', '_') || '/' || linea || '/' ||
  strftime({_zone('timestamp')}, '%Y/%m/%d') || '/' || regexp_replace(article, '[^\\p{{L}}\\p{{N}} _-]', '', 'g') || '/UNKNOWN_BATCH' AS folder FROM m),
 g AS (SELECT folder, count(*) AS row_count, max(timestamp) AS last_time, bool_or(quality_status = 'REJECTED') AS rejected,
  bool_or(reject_flag = 1) AS hw, arg_min(batch_code, timestamp) AS bc, arg_min(article_name, timestamp) AS an,
  arg_min(mqtt_topic, timestamp) AS t FROM p GROUP BY 1)
 SELECT folder, row_count, 17 AS column_count, strftime(last_time, '%H%M%S') || '_' || regexp_replace(bc, '[^a-zA-Z0-9_-]', '', 'g')
  || '_' || substring(regexp_replace(an, '[^a-zA-Z0-9]', '', 'g'), 1, 20) || '_' || CASE WHEN rejected THEN 'WARNING' ELSE 'OK' END
  || '.csv' AS file_name, substring(replace(bc, '/', '-'), 1, 128) AS tag_batch, CASE WHEN rejected THEN 'WARNING' ELSE 'OK' END AS tag_quality,
  CASE WHEN hw THEN 'TRUE' END AS tag_hardware_reject, replace(t, '/', '_') AS tag_line FROM g"""
ORACLE["write_summary"] = f"""WITH {_WB}, y AS (SELECT mqtt_topic, linea, batch_instance_id, identity, quality_status FROM x
  UNION ALL SELECT 'factory/first', linea, batch_instance_id, identity, quality_status FROM x WHERE seq <= 1)
 SELECT mqtt_topic, count(*) AS records, count(CASE WHEN quality_status = 'REJECTED' THEN 1 END) AS rejects,
  min(identity) AS min_identity, max(identity) AS max_identity, array_to_string(list_sort(list(DISTINCT linea)), ',') AS lines,
  count(DISTINCT batch_instance_id) AS batch_count,
  CASE WHEN count(DISTINCT batch_instance_id) > 3 THEN count(DISTINCT batch_instance_id) || ' batches'
   ELSE array_to_string(list_sort(list(DISTINCT batch_instance_id)), ',') END AS batches FROM y GROUP BY 1"""


def _half_up(x: str) -> str:
    return f"floor(({x}) * 10000.0::DOUBLE + 0.5::DOUBLE) / 10000.0::DOUBLE"


def _figures(hours: str) -> str:
    workers = "workers_sum / CAST(units AS DOUBLE)"
    return f"""{_half_up('net_g / 1000')} AS kg, {_half_up('units_ok / CAST(units AS DOUBLE)')} AS quality_ratio,
 {_half_up(f'net_g / 1000 / ({hours})')} AS kg_per_hour, {_half_up(f'units / (({hours}) * 60)')} AS packages_per_minute,
 {_half_up(workers)} AS mean_workers, {_half_up(f'net_g / 1000 / ({hours}) / ({workers})')} AS kg_person_hour"""


_SUMS = """count(*) AS units, count(CASE WHEN quality_status = 'OK' THEN 1 END) AS units_ok,
  count(CASE WHEN quality_status = 'REJECTED' THEN 1 END) AS units_rejected,
  sum(CASE WHEN quality_status = 'OK' THEN clean_net_weight_g ELSE 0 END) AS net_g, CAST(sum(active_workers) AS DOUBLE) AS workers_sum"""
ORACLE["kpi_minute"] = f"""WITH {M}, g AS (SELECT mqtt_topic, linea, date_trunc('minute', timestamp) AS window_start, {_SUMS} FROM m GROUP BY 1, 2, 3)
 SELECT mqtt_topic, linea, window_start, units, units_ok, units_rejected, {_figures('CAST(1 AS DOUBLE) / 60')} FROM g"""
ORACLE["kpi_sliding"] = f"""WITH {M}, g AS (SELECT mqtt_topic, linea, date_trunc('hour', timestamp) - to_hours(d) AS window_start, {_SUMS}
  FROM m, (VALUES (0), (1)) s(d) GROUP BY 1, 2, 3)
 SELECT mqtt_topic, linea, window_start, units, units_ok, units_rejected, {_figures('CAST(2 AS DOUBLE)')} FROM g"""
ORACLE["kpi_batch"] = f"""WITH {SEG}, g AS (SELECT *, packages AS units, greatest((epoch_us(end_time) - epoch_us(start_time)) / 1000000.0, 60.0) / 3600 AS h FROM b)
 SELECT mqtt_topic, linea, article, batch_instance_id, start_time, end_time, units, units_ok, units_rejected, {_figures('h')} FROM g"""
ORACLE["kpi_shift"] = f"""WITH {M}, g AS (SELECT mqtt_topic, linea, CAST(CAST({_zone('timestamp')} AS DATE) AS VARCHAR) AS local_date, shift, {_SUMS}
  FROM m GROUP BY 1, 2, 3, 4)
 SELECT mqtt_topic, linea, local_date, shift, units, units_ok, units_rejected, {_figures('CAST(8 AS DOUBLE)')} FROM g"""
ORACLE["ops_metrics"] = """WITH r AS (SELECT event_type AS status, value / 10 AS s FROM events)
 SELECT status, count(CASE WHEN s <= 0.1 THEN 1 END) AS le_0_1, count(CASE WHEN s <= 0.5 THEN 1 END) AS le_0_5,
  count(CASE WHEN s <= 1 THEN 1 END) AS le_1, count(CASE WHEN s <= 2.5 THEN 1 END) AS le_2_5, count(CASE WHEN s <= 5 THEN 1 END) AS le_5,
  count(CASE WHEN s <= 10 THEN 1 END) AS le_10, count(*) AS runs, round(sum(s), 4) AS seconds_total,
  quantile_disc(s, 0.95) AS p95_seconds FROM r GROUP BY 1"""
ORACLE["ops_errors"] = f"""WITH {REC}, e AS (
  SELECT CASE WHEN i % 20 = 3 THEN 'json_decode_error' ELSE 'not_an_object' END AS error_type, 'parser' AS component FROM raw
   WHERE (topic = 'factory' OR topic LIKE 'factory/%') AND i % 20 IN (3, 8)
  UNION ALL SELECT 'bad_weight', 'cleaner' FROM can WHERE net_weight = 'sensor_error')
 SELECT error_type, component, count(*) AS errors FROM e GROUP BY 1, 2"""

# records as they were sent, beside what the whole chain found out
_SENT = REC + """,
 m AS (SELECT can.* EXCLUDE (quality_status, identity), i AS identity, can.identity AS sent_identity, can.quality_status AS sent_status,
   CASE WHEN can.quality_status IS NOT NULL OR coalesce(reject_flag, '0') = '0' THEN 'OK' ELSE 'REJECTED' END AS quality_status,
   base + to_microseconds(i % 10000000) AS timestamp, coalesce(a.name, 'UNKNOWN_PRODUCT') AS article, a.name AS mapped,
   number * 1000.0 AS clean_net_weight_g,
   CASE linea WHEN 'Line_00' THEN 4 WHEN 'Line_01' THEN 8 WHEN 'Line_02' THEN 100 ELSE 1 END AS active_workers
  FROM can LEFT JOIN (VALUES ('A-100', 'Alpha Mix'), ('A-101', 'Beta Mix'), ('A-102', 'Gamma (Mix)'), ('A-103', 'Delta/Mix')) a(code, name)
   ON can.article_number = a.code WHERE net_weight <> 'sensor_error')"""
ORACLE["pipeline_archive"] = f"""WITH {_SENT}{_STEPS}
 SELECT s3.mqtt_topic, s3.linea, sent_identity AS identity, record_uuid, net_weight, time_text AS timestamp_text,
  sent_status AS quality_status, reject_flag, article_name, article_number, s3.timestamp, s3.quality_status AS processed_status,
  round(clean_net_weight_g, 4) AS calculated_net_weight, CAST(0 AS DOUBLE) AS tare_g, active_workers, batch_instance_id,
  seq AS batch_sequence, b.start_time AS batch_start_time, coalesce(mapped, 'UNKNOWN_REF') AS number_refactor
 FROM s3 JOIN b USING (mqtt_topic, linea, run)"""
_OFFSET = (f"strftime({_zone('moment')}, '%Y-%m-%dT%H:%M:%S.%f') || CASE WHEN epoch_us({_zone('moment')}) - epoch_us(moment) = 7200000000 "
           "THEN '+02:00' ELSE '+01:00' END")
ORACLE["state_roundtrip"] = f"""WITH t AS (SELECT event_id, event_type, ts + to_microseconds(event_id * 5000000000) AS moment FROM events),
 u AS (SELECT *, CASE WHEN event_id % 3 <> 0 THEN moment END AS seen, {_OFFSET} AS written FROM t)
 SELECT event_id, '{{"event_id":' || event_id || ',"moment":"' || written || '","state":{{"event_type":"' || event_type || '","seen":'
  || CASE WHEN seen IS NULL THEN 'null' ELSE '"' || written || '"' END || '}}}}' AS line, moment, event_type, seen FROM u"""
ORACLE["kpi_parts"] = f"""WITH {M}, g AS (SELECT mqtt_topic, linea, time_bucket(INTERVAL 30 MINUTE, timestamp) AS window_start, {_SUMS} FROM m GROUP BY 1, 2, 3)
 SELECT mqtt_topic, linea, window_start, units, units_ok, units_rejected, {_figures('CAST(0.5 AS DOUBLE)')} FROM g"""
ORACLE["kpi_shift_parts"] = ORACLE["kpi_shift"]
ORACLE["enrich_workers_log"] = f"""WITH {W}, u AS (SELECT ts, 'Line_' || lpad(CAST(user_id % 40 AS VARCHAR), 2, '0') AS line_id,
   floor(value) % 120 AS n FROM events WHERE event_id % 10 NOT IN (0, 1) AND event_id % 9 NOT IN (0, 1)),
  l AS (SELECT line_id, CAST(max((ts, n))[2] AS INTEGER) AS n FROM u WHERE n <= 100 GROUP BY 1)
 SELECT identity, linea, coalesce(l.n, CASE linea WHEN 'Line_00' THEN 4 WHEN 'Line_01' THEN 8 WHEN 'Line_02' THEN 100 ELSE 1 END) AS active_workers
 FROM w LEFT JOIN l ON l.line_id = w.linea"""
