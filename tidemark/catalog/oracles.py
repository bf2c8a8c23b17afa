"""The registered queries as SQL for DuckDB, written row by row from ``events``."""

KIND = r"CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER)"
POWER_TIME = "strftime(ts, '%Y%m%d%H%M%S')"
WEATHER_TIME = "strftime(ts, '%Y%m%d%H') || '00'"
SHOWN_TIME = "'%Y-%m-%d %H:%M:%S'"

FEEDS = f"""
WITH power AS (
  SELECT event_id, event_type, {KIND} AS kind, {POWER_TIME} AS base_datetime,
         CAST(60000 + 50 * value AS FLOAT) AS current_demand_mw,
         CAST(5000 + 10 * value AS FLOAT) AS reserve_power_mw
  FROM events WHERE event_type <> 'view'
), weather AS (
  SELECT event_id, ts, {KIND} AS kind, {WEATHER_TIME} AS base_datetime,
         CAST(user_id % 4 AS INTEGER) AS rainfall_type,
         CAST(CASE WHEN user_id % 4 = 0 THEN 0 ELSE value / 10 END AS FLOAT) AS rainfall_mm,
         CAST(-10 + value / 10 AS FLOAT) AS temperature_c
  FROM events WHERE event_type = 'view'
)"""


def _double(column: str) -> str:
    return f"round(CAST({column} AS DOUBLE), 4) AS {column}"


POWER_SHOWN = f"base_datetime, {_double('current_demand_mw')}, {_double('reserve_power_mw')}"
WEATHER_MEASURES = (
    f"{_double('rainfall_type')}, {_double('rainfall_mm')}, {_double('temperature_c')}"
)

DEDUP = f"""{FEEDS}, p AS (
  SELECT * FROM power
  QUALIFY row_number() OVER (PARTITION BY base_datetime ORDER BY event_id) = 1
), w AS (
  SELECT * FROM weather
  QUALIFY row_number() OVER (PARTITION BY base_datetime ORDER BY event_id) = 1
)"""

JOINED = f"""{DEDUP}, joined AS (
  SELECT ph.hour_timestamp, ph.base_datetime, current_demand_mw, reserve_power_mw,
         rainfall_type, rainfall_mm, temperature_c
  FROM (SELECT *, date_trunc('hour', strptime(base_datetime, '%Y%m%d%H%M%S')) AS hour_timestamp
        FROM p) ph
  LEFT JOIN
       (SELECT *, date_trunc('hour', strptime(base_datetime, '%Y%m%d%H%M')) AS hour_timestamp
        FROM w) wh
  ON ph.hour_timestamp = wh.hour_timestamp
)"""

SUMMARY = f"""{JOINED}, summary AS (
  SELECT hour_timestamp, avg(temperature_c) AS avg_temp_c,
         max(current_demand_mw) AS max_demand_mw, avg(reserve_power_mw) AS avg_reserve_mw,
         max(rainfall_mm) AS max_rainfall_mm
  FROM joined GROUP BY hour_timestamp
)"""

SUMMARY_SHOWN = f"""strftime(hour_timestamp, {SHOWN_TIME}) AS hour_timestamp,
  {_double('avg_temp_c')}, {_double('max_demand_mw')}, {_double('avg_reserve_mw')},
  {_double('max_rainfall_mm')}"""

DAY_OF_HOUR = """CAST(year(hour_timestamp) AS INTEGER) AS year,
  strftime(hour_timestamp, '%m') AS month, strftime(hour_timestamp, '%d') AS day"""

# Days with both feeds; without outages every day of the tables may have both.
DAILY = f"""{SUMMARY}
SELECT {SUMMARY_SHOWN}, {DAY_OF_HOUR} FROM summary
WHERE CAST(hour_timestamp AS DATE) IN (SELECT CAST(ts AS DATE) FROM weather)"""

DAY_PARTS = """substr(base_datetime, 1, 4) AS year, substr(base_datetime, 5, 2) AS month,
  substr(base_datetime, 7, 2) AS day"""

DECODED_POWER = f"""{FEEDS}, decoded AS (
  SELECT kind, CASE WHEN kind < 6 OR kind IN (12, 13, 16, 17) THEN NULL ELSE base_datetime END
           AS base_datetime,
         CASE WHEN kind < 8 OR kind IN (12, 13, 17) THEN NULL ELSE current_demand_mw END
           AS current_demand_mw,
         CASE WHEN kind < 10 OR kind IN (12, 13, 17) THEN NULL ELSE reserve_power_mw END
           AS reserve_power_mw
  FROM power
)"""

DECODED_WEATHER = f"""{FEEDS}, decoded AS (
  SELECT CASE WHEN kind < 3 THEN NULL ELSE base_datetime END AS base_datetime,
         CASE WHEN kind < 9 OR kind = 11 THEN NULL ELSE rainfall_type END AS rainfall_type,
         CASE WHEN kind < 5 THEN NULL ELSE rainfall_mm END AS rainfall_mm,
         CASE WHEN kind < 5 OR kind IN (9, 10) THEN NULL ELSE temperature_c END AS temperature_c
  FROM weather
)"""

INGESTED_POWER = f"{DECODED_POWER} SELECT {POWER_SHOWN}, {DAY_PARTS} FROM decoded"
ALERTS = f"{DECODED_POWER} SELECT {POWER_SHOWN} FROM decoded WHERE reserve_power_mw < 5500"

DAMAGED_TIMES = f"""
WITH whole AS (
  SELECT event_id, event_type, {KIND} AS kind,
         CASE WHEN event_type = 'view' THEN {WEATHER_TIME} ELSE {POWER_TIME} END AS t
  FROM events
), damaged AS (
  SELECT event_id, event_type,
         CASE WHEN kind < 5 THEN substr(t, 1, 4) WHEN kind < 10 THEN NULL
              WHEN kind < 15 THEN substr(t, 1, 4) || '-xx' ELSE t END AS base_datetime
  FROM whole
)"""

SLOT = "date_trunc('hour', ts - INTERVAL 10 MINUTE)"

READ_WEATHER = f"""{FEEDS}, readings AS (
  SELECT event_id, strftime({SLOT}, '%Y%m%d%H%M') AS base_datetime,
         CASE WHEN kind IN (5, 6) THEN NULL WHEN kind = 15 THEN 0 ELSE rainfall_type END
           AS rainfall_type,
         CASE WHEN kind IN (5, 6) THEN NULL ELSE rainfall_mm END AS rainfall_mm,
         CASE WHEN kind IN (5, 6, 13) THEN NULL WHEN kind = 15 THEN 1 ELSE temperature_c END
           AS temperature_c
  FROM weather WHERE kind >= 5 AND kind NOT IN (9, 10, 11, 12, 14, 16, 18)
)"""

# How often a part of a payload is repeated that would try a parser's patience.
OFTEN = "CASE WHEN event_id % 100 = 0 THEN 5000 ELSE 3 END"

# The raw responses as texts, and why those that give no reading are rejected.
REJECTS = f"""
WITH power_parts AS (
  SELECT event_id, ts, {KIND} AS kind,
         '<item><baseDatetime>' || {POWER_TIME} || '</baseDatetime><currPwrTot>'
           || CASE WHEN kind BETWEEN 30 AND 33 THEN 'n/a'
                WHEN kind = 46 THEN repeat('1_', {OFTEN}) || '_1' ELSE printf('%.2f', 60000 + 50 * value) END
           || '</currPwrTot>'
           || CASE WHEN kind BETWEEN 21 AND 25 THEN '<suppReservePwr></suppReservePwr>'
                WHEN kind BETWEEN 26 AND 29 THEN ''
                ELSE printf('<suppReservePwr>%.2f</suppReservePwr>', 5000 + 10 * value) END
           || '</item>' AS item,
         CASE WHEN kind BETWEEN 5 AND 9
                THEN '<resultCode>30</resultCode><resultMsg>KEY ERROR</resultMsg>'
              WHEN kind BETWEEN 10 AND 12 THEN '<resultMsg>NO CODE</resultMsg>'
              ELSE '<resultCode>00</resultCode><resultMsg>OK</resultMsg>' END AS header
  FROM events WHERE event_type <> 'view'
), power_whole AS (
  SELECT *, '<response><header>' || header || '</header><body><items>'
         || CASE WHEN kind BETWEEN 13 AND 16 THEN '' ELSE item END
         || '</items></body></response>' AS whole
  FROM power_parts
), weather_parts AS (
  SELECT event_id, ts, {KIND} AS kind,
         '{{"category":"PTY","obsrValue":"'
           || CASE WHEN kind BETWEEN 11 AND 12 THEN '0.5'
                WHEN kind = 16 THEN repeat('1_', {OFTEN}) || '_1' ELSE CAST(user_id % 4 AS VARCHAR) END
           || '"}},{{"category":"REH","obsrValue":"55"}},{{"category":"RN1","obsrValue":"'
           || CASE WHEN kind BETWEEN 9 AND 10 THEN '1mm 미만' WHEN user_id % 4 = 0 THEN '강수없음'
                ELSE printf('%.3f', value / 10) END
           || '"}},{{"category":"T1H","obsrValue":"' || printf('%.3f', -10 + value / 10) || '"}}'
           AS listed
  FROM events WHERE event_type = 'view'
), weather_whole AS (
  SELECT *, '{{"response":{{"header":{{"resultCode":"00","resultMsg":"OK"}},'
         || '"body":{{"items":{{"item":[' || listed || ']}}}}}}}}' AS whole
  FROM weather_parts
), rejects AS (
  SELECT 'power' AS feed, event_id, ts,
         CASE WHEN kind < 5 THEN 'malformed' WHEN kind < 13 THEN 'api_error'
              WHEN kind < 17 THEN 'no_item' WHEN kind BETWEEN 30 AND 33 OR kind = 46 THEN 'bad_value'
              WHEN kind BETWEEN 43 AND 45 THEN 'malformed'
         END AS reject_reason,
         CASE WHEN kind BETWEEN 5 AND 9 THEN '30' END AS result_code,
         CASE WHEN kind BETWEEN 5 AND 9 THEN 'KEY ERROR' WHEN kind BETWEEN 10 AND 12 THEN 'NO CODE'
         END AS result_msg,
         CASE WHEN kind < 2 THEN '<html><title>gateway ' || event_id || '</title><p>'
                || repeat('no reply ', 40)
              WHEN kind = 2 THEN whole || 'junk' WHEN kind = 3 THEN whole || whole
              WHEN kind = 4 THEN '<response><header>' WHEN kind = 43 THEN '<html ' || repeat('ab ', {OFTEN})
              WHEN kind = 44 THEN whole || repeat('</response><!--', {OFTEN})
              WHEN kind = 45 THEN repeat('<item>', {OFTEN}) ELSE whole END AS payload
  FROM power_whole
  UNION ALL
  SELECT 'weather' AS feed, event_id, ts,
         CASE WHEN kind < 3 OR kind = 18 THEN 'malformed' WHEN kind < 5 THEN 'api_error'
              WHEN kind BETWEEN 9 AND 12 OR kind = 16 THEN 'bad_value' WHEN kind = 14 THEN 'unknown_structure'
         END AS reject_reason,
         CASE WHEN kind BETWEEN 3 AND 4 THEN '03' END AS result_code,
         CASE WHEN kind BETWEEN 3 AND 4 THEN 'NO DATA' END AS result_msg,
         CASE WHEN kind < 2 THEN '<html>gateway ' || event_id || '</html>' || repeat('no reply ', 40)
              WHEN kind = 2 THEN whole || '{{"x":1}}'
              WHEN kind < 5 THEN '{{"response":{{"header":{{"resultCode":"03","resultMsg":"NO DATA"}},'
                || '"body":{{"items":""}}}}}}'
              WHEN kind = 14 THEN '{{"x":1}}'
              WHEN kind = 18 THEN repeat('{{"response":[', {OFTEN}) ELSE whole END AS payload
  FROM weather_whole
)"""

DAYS = f"""{FEEDS}, days AS (
  SELECT substr(base_datetime, 1, 4) AS year, substr(base_datetime, 5, 2) AS month,
         substr(base_datetime, 7, 2) AS day,
         bool_or(feed = 'power') AS has_power, bool_or(feed = 'weather') AS has_weather
  FROM (SELECT CASE WHEN substr(base_datetime, 7, 2) IN ('07', '14', '21', '28')
                 THEN 'weather' ELSE 'power' END AS feed, base_datetime FROM power
        UNION ALL
        SELECT CASE WHEN substr(base_datetime, 7, 2) IN ('05', '10', '15', '20', '25', '30')
                 THEN 'power' ELSE 'weather' END AS feed, base_datetime FROM weather)
  GROUP BY 1, 2, 3
)"""

ORACLES: dict[str, str] = {
    "hourly_summary": f"{SUMMARY} SELECT {SUMMARY_SHOWN} FROM summary",
    "day_scan": f"""{FEEDS}
SELECT 'power' AS feed, base_datetime, {DAY_PARTS} FROM power
WHERE substr(base_datetime, 1, 8) = '20240115'
UNION ALL
SELECT 'weather' AS feed, base_datetime, {DAY_PARTS} FROM weather
WHERE substr(base_datetime, 1, 8) = '20240115'""",
    "power_from_xml": f"""{FEEDS}, readings AS (
  SELECT event_id, base_datetime, current_demand_mw,
         CASE WHEN kind BETWEEN 21 AND 29 THEN 0 ELSE reserve_power_mw END AS reserve_power_mw
  FROM power WHERE kind >= 17 AND kind NOT BETWEEN 30 AND 33 AND kind NOT BETWEEN 43 AND 46
)
SELECT event_id, {POWER_SHOWN} FROM readings""",
    "weather_from_json": f"""{READ_WEATHER}
SELECT event_id, base_datetime, {WEATHER_MEASURES} FROM readings""",
    "weather_pivot": f"{READ_WEATHER} SELECT event_id, {WEATHER_MEASURES} FROM readings",
    "api_rejects": f"""{REJECTS}
SELECT feed, reject_reason, result_code, result_msg,
       min(CASE WHEN reject_reason = 'malformed' THEN substr(payload, 1, 200) END) AS excerpt,
       count(*) AS n
FROM rejects WHERE reject_reason IS NOT NULL GROUP BY ALL""",
    "rejected_payloads": f"""{REJECTS}
SELECT feed, event_id, strftime(ts, {SHOWN_TIME}) AS fetched_at, reject_reason, payload
FROM rejects WHERE reject_reason IS NOT NULL""",
    "decode_power": f"{DECODED_POWER} SELECT {POWER_SHOWN} FROM decoded",
    "decode_weather": f"{DECODED_WEATHER} SELECT base_datetime, {WEATHER_MEASURES} FROM decoded",
    "encode_wire": f"""{FEEDS}
SELECT 'power' AS key, '{{"base_datetime":"' || base_datetime || '","current_demand_mw":'
       || CAST(current_demand_mw AS VARCHAR) || ',"reserve_power_mw":'
       || CAST(reserve_power_mw AS VARCHAR) || '}}' AS value
FROM power
UNION ALL
SELECT 'weather' AS key, '{{"base_datetime":"' || base_datetime || '","rainfall_type":'
       || CAST(rainfall_type AS VARCHAR) || ',"rainfall_mm":' || CAST(rainfall_mm AS VARCHAR)
       || ',"temperature_c":' || CAST(temperature_c AS VARCHAR) || '}}' AS value
FROM weather""",
    "date_parts": f"{DAMAGED_TIMES} SELECT event_id, base_datetime, {DAY_PARTS} FROM damaged",
    "date_parts_typed": """
SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(day(ts) AS INTEGER) AS day
FROM events WHERE event_type <> 'view'""",
    "hour_bucket": f"""{DAMAGED_TIMES}
SELECT event_id, base_datetime,
       strftime(date_trunc('hour', CASE WHEN event_type = 'view'
         THEN try_strptime(base_datetime, '%Y%m%d%H%M')
         ELSE try_strptime(base_datetime, '%Y%m%d%H%M%S') END), {SHOWN_TIME}) AS hour_timestamp
FROM damaged""",
    "target_day": """
SELECT event_id, CAST(year(d) AS INTEGER) AS target_year, strftime(d, '%m') AS target_month,
       strftime(d, '%d') AS target_day,
       'year=' || strftime(d, '%Y') || '/month=' || strftime(d, '%m') || '/day='
         || strftime(d, '%d') AS partition_path
FROM (SELECT event_id, ts - INTERVAL 1 DAY AS d FROM events)""",
    "publish_slot": """
SELECT event_id, strftime(s, '%Y%m%d') AS base_date, strftime(s, '%H') || '00' AS base_time,
       strftime(s, '%Y%m%d') || strftime(s, '%H') || '00' AS base_datetime
FROM (SELECT event_id, CASE WHEN minute(ts) < 10 THEN ts - INTERVAL 1 HOUR ELSE ts END AS s
      FROM events)""",
    "ts_format_roundtrip": f"""
SELECT event_id, strftime(ts, {SHOWN_TIME}) AS formatted,
       strftime(date_trunc('second', ts), {SHOWN_TIME}) AS parsed
FROM events""",
    "alert_message": r"""
SELECT event_id, concat(E'\n    :red_circle: **Task Failed** :red_circle:',
  E'\n    *DAG*: daily_summary', E'\n    *Task*: ', event_type,
  E'\n    *Date*: ', strftime(ts, '%Y-%m-%d'),
  E'\n    *Error*: ', CASE WHEN event_type = 'error' THEN props ELSE 'None' END,
  E'\n    ') AS message
FROM events""",
    "reserve_alerts": ALERTS,
    "dedup_power": f"{DEDUP} SELECT event_id, {POWER_SHOWN} FROM p",
    "dedup_power_no_id": f"""{FEEDS}, told AS (
  SELECT base_datetime, CASE WHEN event_id % 3 <> 0 THEN event_id END AS event_id,
         CASE WHEN event_id % 3 = 0 THEN CAST(60000 AS FLOAT) ELSE current_demand_mw END
           AS current_demand_mw,
         CASE WHEN event_id % 3 = 0 THEN CAST(5000 AS FLOAT) ELSE reserve_power_mw END
           AS reserve_power_mw
  FROM power
)
SELECT event_id, {POWER_SHOWN} FROM told
QUALIFY row_number() OVER (PARTITION BY base_datetime ORDER BY event_id NULLS LAST) = 1""",
    "dedup_weather": f"{DEDUP} SELECT event_id, base_datetime, {WEATHER_MEASURES} FROM w",
    "dedup_wide": f"""
SELECT {WEATHER_TIME} AS base_datetime, event_id, event_type, props, {_double('value')} FROM events
QUALIFY row_number() OVER (PARTITION BY base_datetime ORDER BY event_id) = 1""",
    "hourly_join": f"""{JOINED}
SELECT strftime(hour_timestamp, {SHOWN_TIME}) AS hour_timestamp, {POWER_SHOWN},
       {WEATHER_MEASURES} FROM joined""",
    "temp_demand_corr": f"""{SUMMARY}
SELECT count(*) AS n_hours,
       round(corr(avg_temp_c, CAST(max_demand_mw AS DOUBLE)), 4) AS temp_demand_corr
FROM summary WHERE avg_temp_c IS NOT NULL AND max_demand_mw IS NOT NULL""",
    "days_with_both_feeds": f"""{DAYS}
SELECT year, month, day FROM days WHERE has_power AND has_weather""",
    "days_skipped": f"""{DAYS}
SELECT year, month, day, CASE WHEN has_power THEN 'weather' ELSE 'power' END AS missing_feed
FROM days WHERE has_power <> has_weather""",
    "daily_summary": f"{DAILY} AND CAST(hour_timestamp AS DATE) = DATE '2024-01-15'",
    "summary_range": f"""{DAILY}
AND CAST(hour_timestamp AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'""",
    "summary_overwrite": f"""{DAILY}
AND CAST(hour_timestamp AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'""",
    "full_scan_summary": f"{SUMMARY} SELECT {SUMMARY_SHOWN} FROM summary",
    "summary_write_roundtrip": DAILY,
    "summary_seen_whole": f"""
WITH daily AS ({DAILY}), few AS (
  SELECT * REPLACE (CAST(NULL AS DOUBLE) AS max_demand_mw) FROM daily
  WHERE hour_timestamp BETWEEN '2024-01-08' AND '2024-01-22'
)
SELECT *, 'before' AS state FROM few
UNION ALL
SELECT * REPLACE (2023 AS year, '12' AS month, '31' AS day), 'before' FROM few
UNION ALL
SELECT *, unnest(['ordered', 'moved']) FROM daily""",
    "ingest_power_lake": INGESTED_POWER,
    "ingest_weather_lake": f"""{DECODED_WEATHER}
SELECT base_datetime, {WEATHER_MEASURES}, {DAY_PARTS} FROM decoded""",
    "ingest_restart": INGESTED_POWER,
    "ingest_both": f"""{DECODED_POWER}, decoded_weather AS (
  SELECT CASE WHEN kind < 3 THEN NULL ELSE base_datetime END AS base_datetime FROM weather
), both_feeds AS (
  SELECT 'power' AS feed, {DAY_PARTS} FROM decoded
  UNION ALL
  SELECT 'weather' AS feed, {DAY_PARTS} FROM decoded_weather
)
SELECT feed, year, month, day, count(*) AS n FROM both_feeds GROUP BY ALL""",
    "ingest_quarantine": f"""{DECODED_POWER}, texts AS (
  SELECT {KIND} AS kind, 60000 + 50 * value AS demand, 5000 + 10 * value AS reserve,
         {POWER_TIME} AS time,
         '{{"base_datetime":"' || {POWER_TIME} || '",' || printf(
           '"current_demand_mw":%.2f,"reserve_power_mw":%.2f', 60000 + 50 * value, 5000 + 10 * value
         ) || '}}' AS whole
  FROM events WHERE event_type <> 'view'
)
SELECT base_datetime, {_double('current_demand_mw')}, {_double('reserve_power_mw')},
       CAST(NULL AS VARCHAR) AS text
FROM decoded WHERE kind >= 6 AND kind NOT IN (8, 9, 17)
UNION ALL
SELECT NULL, NULL, NULL,
       CASE WHEN kind < 3 THEN 'not json' WHEN kind < 6 THEN substr(whole, 1, 25)
            WHEN kind < 10 THEN printf(
              '{{"base_datetime":"%s","current_demand_mw":%.2f,"reserve_power_mw":"%.2f"}}',
              time, demand, reserve)
            ELSE '[' || whole || ']' END
FROM texts WHERE kind < 6 OR kind IN (8, 9, 17)""",
    "publish_stream": f"""{REJECTS}, read_power AS (
  SELECT '{{"base_datetime":"' || {POWER_TIME} || '","current_demand_mw":'
         || CAST(CAST(60000 + 50 * value AS FLOAT) AS VARCHAR) || ',"reserve_power_mw":'
         || CAST(CAST(CASE WHEN {KIND} BETWEEN 21 AND 29 THEN 0 ELSE 5000 + 10 * value END AS FLOAT)
              AS VARCHAR) || '}}' AS text
  FROM events WHERE event_type <> 'view' AND {KIND} >= 17 AND {KIND} NOT BETWEEN 30 AND 33
    AND {KIND} NOT BETWEEN 43 AND 46
)
SELECT 'message' AS kind, text FROM read_power
UNION ALL
SELECT reject_reason, payload FROM rejects WHERE feed = 'power' AND reject_reason IS NOT NULL""",
    "stream_alerts": ALERTS,
    "late_day_rerun": DAILY,
    "publish_ordered": f"""{FEEDS}, sent AS (
  SELECT substr({POWER_TIME}, 9, 2) AS key, {POWER_TIME} AS time,
         '{{"base_datetime":"' || {POWER_TIME} || '","current_demand_mw":'
         || CAST(CAST(60000 + 50 * value AS FLOAT) AS VARCHAR) || ',"reserve_power_mw":'
         || CAST(CAST(CASE WHEN {KIND} BETWEEN 21 AND 29 THEN 0 ELSE 5000 + 10 * value END AS FLOAT)
              AS VARCHAR) || '}}' AS text
  FROM events WHERE event_type <> 'view' AND {KIND} >= 17 AND {KIND} NOT BETWEEN 30 AND 33
    AND {KIND} NOT BETWEEN 43 AND 46
)
SELECT key, text, CAST(row_number() OVER (PARTITION BY key ORDER BY time, text) AS INTEGER) AS place,
       1 AS parts FROM sent""",
    "summary_resumed": f"""
WITH daily AS ({DAILY} AND CAST(hour_timestamp AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-21')
SELECT *, CASE WHEN day BETWEEN '12' AND '15' THEN 3 ELSE 1 END AS attempts,
       CASE WHEN day BETWEEN '12' AND '15' THEN 2 ELSE 0 END AS failures
FROM daily""",
    "failed_run_messages": r"""
SELECT 'backfill' AS run, CAST(attempt AS INTEGER) AS attempt,
       concat(E'\n    :red_circle: **Task Failed** :red_circle:', E'\n    *DAG*: daily_summary',
         E'\n    *Task*: write_range', E'\n    *Date*: 2024-01-', day,
         E'\n    *Error*: FAILED_READ_FILE.NO_HINT', E'\n    ') AS message
FROM (SELECT DISTINCT strftime(ts, '%d') AS day FROM events
      WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-12' AND DATE '2024-01-15'), range(1, 3) t(attempt)""",
}
