"""The same results in SQL over the driver's tables, for the correctness check."""

from __future__ import annotations

# --- inputs ------------------------------------------------------------------------

KEYED = """
keyed AS (
  SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events
)"""

ARRIVALS = (
    KEYED
    + """,
arr AS (
  SELECT ts AS snapshot_ts,
         CASE WHEN k % 10 <> 0 THEN ts END AS recptn_dt,
         ts AS event_time,
         user_id AS station_id,
         'ST' || user_id AS station_name,
         1001 + user_id % 9 AS line_id,
         CASE WHEN event_id % 2 = 0 THEN 'up' ELSE 'down' END AS updn_line,
         event_type AS train_status,
         CASE WHEN k % 7 <> 3 THEN CAST(floor(value * 10) AS BIGINT) END AS arrival_seconds,
         CASE WHEN k % 11 <> 0 THEN CAST(k % 7 AS BIGINT) END AS arrival_status_code,
         CASE WHEN k >= 95 THEN TRUE WHEN k >= 5 THEN FALSE END AS is_last_train
  FROM keyed
)"""
)

EVENTS = (
    ARRIVALS
    + """,
enriched AS (
  SELECT * REPLACE (coalesce(is_last_train, FALSE) AS is_last_train,
                    coalesce(arrival_status_code, -1) AS arrival_status_code),
         event_time AS event_dt,
         coalesce(arrival_seconds, 0) AS wait_sec,
         CAST(event_time AS DATE) AS event_date,
         CAST(hour(event_time) AS INTEGER) AS event_hour,
         CAST(coalesce(arrival_seconds, 0) >= 300 AS INTEGER) AS is_long_wait_5,
         CAST(coalesce(is_last_train, FALSE) AS INTEGER) AS is_last_train_flag,
         CAST(train_status = 'purchase' AS INTEGER) AS is_express,
         CASE WHEN arrival_status_code IN (0, 3, 4, 5) THEN 'approach'
              WHEN arrival_status_code = 1 THEN 'at_platform'
              WHEN arrival_status_code = 2 THEN 'depart'
              ELSE 'other' END AS arrival_phase,
         CAST(hour(event_time) IN (22, 23, 0, 1) AS INTEGER) AS is_late_night
  FROM arr
)"""
)

KPI = (
    EVENTS
    + """,
kpi AS (
  SELECT event_date, line_id, station_id, station_name,
         count(*) AS total_events,
         avg(wait_sec) AS avg_wait_sec,
         quantile_disc(wait_sec, 0.95) AS p95_wait_sec,
         avg(is_long_wait_5) AS long_wait_ratio_5,
         avg(is_express) AS express_ratio,
         CAST(sum(is_late_night) AS BIGINT) AS late_night_events,
         max(event_dt) FILTER (WHERE is_last_train) AS last_train_dt,
         avg(wait_sec) FILTER (WHERE is_last_train) AS last_train_wait_sec
  FROM enriched GROUP BY event_date, line_id, station_id, station_name
)"""
)

BRONZE_USAGE = """
usage_days AS (
  SELECT *, CAST(DATE '2024-01-01' + CAST(date_diff('day', DATE '1992-01-01',
            CAST(l_shipdate AS DATE)) % 30 AS INTEGER) AS DATE) AS d
  FROM lineitem
),
bronze AS (
  SELECT strftime(d, '%Y%m%d') AS USE_YMD,
         l_returnflag || '-' || l_linestatus AS SBWY_ROUT_LN_NM,
         'ST' || l_suppkey AS SBWY_STNS_NM,
         CASE WHEN l_linenumber = 7 AND l_tax > 0.07 THEN '-1'
              WHEN l_quantity % 25 = 0 THEN NULL
              ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS GTON_TNOPE,
         CAST(l_linenumber AS VARCHAR) AS GTOFF_TNOPE,
         strftime(CAST(d + CAST(3 + l_linenumber % 3 AS INTEGER) AS DATE), '%Y%m%d') AS REG_YMD,
         lpad(CAST(l_orderkey AS VARCHAR), 12, '0') AS run_ts
  FROM usage_days
)"""

LATEST_USAGE = (
    BRONZE_USAGE
    + """,
latest AS (
  SELECT * FROM bronze
  QUALIFY row_number() OVER (
    PARTITION BY USE_YMD, SBWY_STNS_NM, SBWY_ROUT_LN_NM
    ORDER BY REG_YMD DESC, run_ts DESC, GTON_TNOPE DESC NULLS LAST,
             GTOFF_TNOPE DESC NULLS LAST) = 1
)"""
)

USAGE = (
    LATEST_USAGE
    + """,
counted AS (
  SELECT *, coalesce(CAST(GTON_TNOPE AS BIGINT), 0) AS ride_count,
         coalesce(CAST(GTOFF_TNOPE AS BIGINT), 0) AS alight_count
  FROM latest
),
usage AS (
  SELECT USE_YMD AS use_ymd,
         CAST(strptime(USE_YMD, '%Y%m%d') AS DATE) AS use_date,
         CAST(strptime(REG_YMD, '%Y%m%d') AS DATE) AS reg_date,
         SBWY_ROUT_LN_NM AS line_name, SBWY_STNS_NM AS station_name,
         ride_count, alight_count, ride_count + alight_count AS total_count,
         CAST(substr(USE_YMD, 1, 4) AS INTEGER) AS "year",
         CAST(substr(USE_YMD, 5, 2) AS INTEGER) AS "month",
         CAST(substr(USE_YMD, 7, 2) AS INTEGER) AS "day"
  FROM counted WHERE ride_count >= 0 AND alight_count >= 0
),
station_usage AS (
  SELECT use_ymd AS pasngYmd, station_name AS stnNm, line_name AS lineNm,
         CAST(sum(total_count) AS BIGINT) AS totalNope,
         CAST(sum(ride_count) AS BIGINT) AS rideNope,
         CAST(sum(alight_count) AS BIGINT) AS gffNope,
         CAST(NULL AS VARCHAR) AS stnCd, CAST(NULL AS VARCHAR) AS lineNo
  FROM usage GROUP BY use_ymd, station_name, line_name
)"""
)

REPORT = (
    KPI
    + ","
    + USAGE
    + """,
kpi_day AS (SELECT event_date AS report_date, * FROM kpi),
usage_day AS (
  SELECT CAST(CAST(strptime(pasngYmd, '%Y%m%d') AS DATE) + 4 AS DATE) AS report_date, *
  FROM station_usage
)"""
)

METRIC_COLUMNS = """
  count(*) AS n,
  round(avg(arrival_seconds), 6) AS avg_eta_sec,
  quantile_disc(arrival_seconds, 0.9) AS p90_eta_sec,
  avg(CASE WHEN arrival_seconds >= 600 THEN 1.0 ELSE 0.0 END) AS long_ratio_10m,
  coalesce(bool_or(is_last_train), FALSE) AS last_train_seen"""


STATION_KEYS = "station_id, station_name, line_id, updn_line"


def sliding(minutes: int, slide: int, source: str = "arr", keys: str = STATION_KEYS) -> str:
    """Metrics of all windows of a length, one per slide."""
    return f"""
metrics AS (
  SELECT {keys}, {METRIC_COLUMNS}, window_end
  FROM (
    SELECT *, time_bucket(INTERVAL {slide} MINUTE, event_time, TIMESTAMP '1970-01-01')
              + INTERVAL {slide} MINUTE * CAST(step + 1 AS INTEGER) AS window_end
    FROM {source}, range({minutes // slide}) AS steps(step)
  )
  GROUP BY {keys}, window_end
)"""


def metric_rows(minutes: int, where: str = "TRUE", keys: str = STATION_KEYS) -> str:
    return f"""
SELECT {keys}, n, avg_eta_sec, p90_eta_sec,
       round(long_ratio_10m, 6) AS long_ratio_10m, last_train_seen,
       window_end - INTERVAL {minutes} MINUTE AS window_start_ts, window_end AS window_end_ts,
       CAST({minutes} AS INTEGER) AS window_minutes, CAST(20 AS INTEGER) AS min_n,
       CAST(year(window_end) AS INTEGER) AS "year", CAST(month(window_end) AS INTEGER) AS "month",
       CAST(day(window_end) AS INTEGER) AS "day", CAST(hour(window_end) AS INTEGER) AS "hour",
       strftime(window_end, '%Y%m%d%H%M') AS window_end_ymdhm
FROM metrics WHERE {where}"""


HEALTH = """,
health AS (
  SELECT window_end - INTERVAL 1440 MINUTE AS window_start_ts, window_end AS window_end_ts,
         CAST(sum(n) AS BIGINT) AS total_n,
         coalesce(sum(n * long_ratio_10m) / sum(n), 0) AS delay_ratio_10m_weighted,
         coalesce(CAST(sum(n * p90_eta_sec) AS DOUBLE) / sum(n), 0) AS p90_eta_sec_weighted,
         count(*) AS "groups"
  FROM metrics GROUP BY window_end
)"""

DELAYED = """,
delayed AS (
  SELECT window_end - INTERVAL 1440 MINUTE AS window_start_ts, window_end AS window_end_ts,
         station_name, line_id, updn_line, n, long_ratio_10m, p90_eta_sec,
         CAST(row_number() OVER (PARTITION BY window_end
              ORDER BY long_ratio_10m DESC, n DESC, station_name, line_id, updn_line,
                       p90_eta_sec) AS INTEGER) AS position
  FROM metrics WHERE n >= 2
  QUALIFY position <= 10
)"""

HEALTH_ROWS = """
SELECT window_start_ts, window_end_ts, total_n,
       round(delay_ratio_10m_weighted, 6) AS delay_ratio_10m_weighted,
       round(p90_eta_sec_weighted, 6) AS p90_eta_sec_weighted, "groups"
FROM health"""

CLOSED = "(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM events)"

KPI_ROWS = """
SELECT event_date, line_id, station_id, station_name, total_events,
       round(avg_wait_sec, 6) AS avg_wait_sec, p95_wait_sec,
       round(long_wait_ratio_5, 6) AS long_wait_ratio_5,
       round(express_ratio, 6) AS express_ratio, late_night_events, last_train_dt,
       round(last_train_wait_sec, 6) AS last_train_wait_sec
FROM kpi"""


def painful(kpi: str, usage: str, match: str) -> str:
    """Scores of every pair, to be ranked."""
    day = "k.report_date, " if "report_date" in match else ""
    over = "OVER (PARTITION BY k.report_date)" if day else "OVER ()"
    return f"""
pairs AS (
  SELECT {day}k.station_name, k.line_id, k.avg_wait_sec, k.p95_wait_sec, k.long_wait_ratio_5,
         u.totalNope,
         (k.avg_wait_sec / (max(k.avg_wait_sec) {over} + 1e-6))
         * (u.totalNope / (max(u.totalNope) {over} + 1e-6)) AS pain_score
  FROM {kpi} k JOIN {usage} u ON {match}
)"""


PAIN_ORDER = (
    "pain_score DESC, avg_wait_sec DESC, totalNope DESC, station_name, line_id, p95_wait_sec,"
    " long_wait_ratio_5"
)
PAIN_BY_DAY = painful(
    "kpi_day", "usage_day", "k.station_name = u.stnNm AND k.report_date = u.report_date"
)
PAIN_FIELDS = (
    "station_name, line_id, round(avg_wait_sec, 6) AS avg_wait_sec, p95_wait_sec,"
    " round(long_wait_ratio_5, 6) AS long_wait_ratio_5, totalNope,"
    " round(pain_score, 6) AS pain_score"
)


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts[:-1]) + parts[-1]


BRONZE_ARRIVALS = (
    KEYED
    + """,
raw AS (
  SELECT *,
    CASE WHEN k % 10 = 0 THEN NULL
         WHEN event_id % 4 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
         WHEN event_id % 4 = 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
         WHEN event_id % 4 = 2 THEN strftime(ts, '%Y%m%d%H%M%S')
         ELSE 'soon' END AS received,
    CASE WHEN k % 13 = 0 THEN 'x' WHEN k % 17 = 0 THEN '1.7'
         ELSE CAST(user_id AS VARCHAR) END AS station,
    CASE WHEN k % 7 = 3 THEN '' ELSE CAST(CAST(floor(value * 10) AS BIGINT) AS VARCHAR) END AS wait
  FROM keyed
)"""
)


def _whole(text: str) -> str:
    return f"CASE WHEN regexp_full_match({text}, '-?[0-9]+') THEN CAST({text} AS BIGINT) END"


SQL: dict[str, str] = {
    "silver_arrival": _with(
        BRONZE_ARRIVALS
        + """,
parsed AS (
  SELECT *, coalesce(try_strptime(received, '%Y-%m-%d %H:%M:%S'),
                     try_strptime(received, '%Y-%m-%dT%H:%M:%S'),
                     try_strptime(received, '%Y%m%d%H%M%S')) AS recptn_dt
  FROM raw
)""",
        f"""
SELECT ts AS snapshot_ts, recptn_dt, coalesce(recptn_dt, ts) AS event_time,
       {_whole("station")} AS station_id, 'ST' || user_id AS station_name,
       1001 + user_id % 9 AS line_id,
       CASE WHEN event_id % 2 = 0 THEN 'up' ELSE 'down' END AS updn_line,
       CAST(NULL AS VARCHAR) AS train_line_name, user_id - 1 AS prev_station_id,
       user_id + 1 AS next_station_id, CAST(NULL AS BIGINT) AS dest_station_id,
       CAST(NULL AS VARCHAR) AS dest_station_name, CAST(event_id AS VARCHAR) AS train_no,
       event_type AS train_status, {_whole("wait")} AS arrival_seconds,
       CASE WHEN k % 11 <> 0 THEN CAST(k % 7 AS BIGINT) END AS arrival_status_code,
       CAST(NULL AS VARCHAR) AS arrival_msg_primary,
       CAST(NULL AS VARCHAR) AS arrival_msg_secondary,
       CASE WHEN k >= 95 THEN TRUE WHEN k >= 5 THEN FALSE END AS is_last_train,
       CAST(year(ts) AS INTEGER) AS "year", CAST(month(ts) AS INTEGER) AS "month",
       CAST(day(ts) AS INTEGER) AS "day", CAST(hour(ts) AS INTEGER) AS "hour"
FROM parsed""",
    ),
    "multi_format_timestamp": """
WITH rows AS (
  SELECT o_orderkey, CASE o_orderkey % 4
    WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
    WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
    WHEN 2 THEN strftime(o_orderdate, '%Y%m%d%H%M%S')
    ELSE strftime(o_orderdate, '%d.%m.%Y') END AS shown
  FROM orders
)
SELECT o_orderkey, shown, coalesce(try_strptime(shown, '%Y-%m-%d %H:%M:%S'),
       try_strptime(shown, '%Y-%m-%dT%H:%M:%S'), try_strptime(shown, '%Y%m%d%H%M%S')) AS parsed
FROM rows""",
    "time_keys": """
SELECT event_id, time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01') AS slot,
       strftime(ts, '%Y%m%d%H%M') AS minute_key, strftime(ts, '%Y%m%dT%H%M%S') AS run_key,
       ts + INTERVAL 9 HOUR AS local_time, CAST(ts AS DATE) AS day_date,
       CAST(year(ts) AS INTEGER) AS "year", CAST(month(ts) AS INTEGER) AS "month",
       CAST(day(ts) AS INTEGER) AS "day"
FROM events""",
    "usage_latest_dedup": _with(LATEST_USAGE, " SELECT * FROM latest"),
    "silver_usage": _with(USAGE, " SELECT * FROM usage"),
    "landed_usage": _with(
        BRONZE_USAGE,
        """
SELECT * EXCLUDE (run_ts), TIMESTAMP '2024-02-10 03:30:00' AS ingested_at,
       '20240210T033000' AS run_ts,
       CAST(substr(USE_YMD, 1, 4) AS INTEGER) AS "year",
       CAST(substr(USE_YMD, 5, 2) AS INTEGER) AS "month",
       CAST(substr(USE_YMD, 7, 2) AS INTEGER) AS "day"
FROM bronze""",
    ),
    "stringify_bronze": """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
       '{"segment":"' || c_mktsegment || '","nation":' || c_nationkey || '}' AS place,
       '[' || c_nationkey || ',' || c_custkey || ']' AS codes
FROM customer""",
    "union_schema_drift": """
SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 6) AS c_acctbal,
       CASE WHEN c_acctbal < 0 THEN c_mktsegment END AS c_mktsegment
FROM customer""",
    "arrival_metrics_15m": _with(ARRIVALS, sliding(15, 5), metric_rows(15)),
    "arrival_metrics_15m_single_window": _with(
        ARRIVALS,
        sliding(15, 5),
        metric_rows(15, "window_end = TIMESTAMP '2024-01-15 12:00:00'"),
    ),
    "line_metrics_daily": _with(
        ARRIVALS, sliding(1440, 480, keys="line_id"), metric_rows(1440, keys="line_id")
    ),
    "arrival_events_enriched": _with(EVENTS, " SELECT * FROM enriched"),
    "station_daily_kpi": _with(KPI, KPI_ROWS),
    "station_daily_kpi_join": _with(KPI, KPI_ROWS),
    "line_daily_kpi": _with(
        EVENTS,
        """
SELECT event_date, line_id, count(*) AS total_events,
       round(avg(wait_sec), 6) AS avg_wait_sec, quantile_disc(wait_sec, 0.95) AS p95_wait_sec,
       round(avg(is_long_wait_5), 6) AS long_wait_ratio_5,
       round(avg(is_express), 6) AS express_ratio,
       CAST(sum(is_late_night) AS BIGINT) AS late_night_events,
       max(event_dt) FILTER (WHERE is_last_train) AS last_train_dt,
       round(avg(wait_sec) FILTER (WHERE is_last_train), 6) AS last_train_wait_sec
FROM enriched GROUP BY event_date, line_id""",
    ),
    "window_health": _with(ARRIVALS, sliding(1440, 480) + HEALTH, HEALTH_ROWS),
    "delayed_station_topk": _with(
        ARRIVALS,
        sliding(1440, 480) + DELAYED,
        """
SELECT * REPLACE (round(long_ratio_10m, 6) AS long_ratio_10m) FROM delayed""",
    ),
    "delay_alert": _with(
        ARRIVALS,
        sliding(1440, 480) + HEALTH + DELAYED,
        """,
listed AS (
  SELECT window_end_ts, string_agg(station_name, ',' ORDER BY position) AS stations,
         CAST(count(*) AS INTEGER) AS station_count,
         string_agg(printf('%s, line %d %s: %d rows, %.2f wait long, p90 %d s', station_name, line_id,
                           updn_line, n, long_ratio_10m, coalesce(p90_eta_sec, 0)),
                    chr(10) ORDER BY position) AS lines
  FROM delayed GROUP BY window_end_ts
)
SELECT window_start_ts, window_end_ts, total_n,
       round(delay_ratio_10m_weighted, 6) AS delay_ratio_10m_weighted,
       round(p90_eta_sec_weighted, 6) AS p90_eta_sec_weighted, "groups", stations, station_count,
       'Long waits from ' || strftime(window_start_ts, '%Y-%m-%d %H:%M:%S') || ' to '
       || strftime(window_end_ts, '%Y-%m-%d %H:%M:%S') || ': ' || total_n || ' rows in '
       || "groups" || ' groups' || chr(10)
       || printf('Share of long waits %.2f, p90 %.0f s, over all rows', delay_ratio_10m_weighted,
                 p90_eta_sec_weighted) || chr(10)
       || 'Most delayed:' || chr(10) || lines AS alert_text
FROM health JOIN listed USING (window_end_ts)
WHERE total_n >= 200 AND (delay_ratio_10m_weighted >= 0.25 OR p90_eta_sec_weighted >= 1200)""",
    ),
    "missing_windows": _with(
        ARRIVALS,
        sliding(15, 5),
        """
SELECT e - INTERVAL 15 MINUTE AS window_start_ts, e AS window_end_ts,
       'No arrival metrics from ' || strftime(e - INTERVAL 15 MINUTE, '%Y-%m-%d %H:%M:%S')
       || ' to ' || strftime(e, '%Y-%m-%d %H:%M:%S') AS alert_text
FROM (SELECT unnest(generate_series(min(window_end), max(window_end), INTERVAL 5 MINUTE)) AS e
      FROM metrics)
WHERE e NOT IN (SELECT window_end FROM metrics)""",
    ),
    "usage_station_daily": _with(USAGE, " SELECT * FROM station_usage"),
    "usage_line_daily": _with(
        USAGE,
        """
SELECT use_ymd AS pasngYmd, line_name AS lineNm, CAST(sum(total_count) AS BIGINT) AS totalNope,
       CAST(sum(ride_count) AS BIGINT) AS rideNope, CAST(sum(alight_count) AS BIGINT) AS gffNope,
       CAST(NULL AS VARCHAR) AS lineNo
FROM usage GROUP BY use_ymd, line_name""",
    ),
    "usage_daily_total_top20": _with(
        USAGE,
        """
SELECT use_ymd, station_name, CAST(sum(total_count) AS BIGINT) AS daily_total
FROM usage GROUP BY use_ymd, station_name
ORDER BY daily_total DESC, use_ymd, station_name LIMIT 20""",
    ),
    "usage_line_total_top20": _with(
        USAGE,
        """
SELECT use_ymd, line_name, CAST(sum(total_count) AS BIGINT) AS daily_total
FROM usage GROUP BY use_ymd, line_name
ORDER BY daily_total DESC, use_ymd, line_name LIMIT 20""",
    ),
    "top_stations_ranked": _with(
        USAGE,
        """
SELECT pasngYmd, stnNm, lineNm, totalNope,
       rank() OVER (PARTITION BY pasngYmd ORDER BY totalNope DESC) AS rank_daily
FROM station_usage""",
    ),
    "top_stations": _with(
        USAGE,
        """
SELECT stnNm AS station_name, lineNm AS line_name, totalNope, CAST(NULL AS BIGINT) AS rank_daily
FROM station_usage ORDER BY totalNope DESC, station_name, line_name LIMIT 10""",
    ),
    "top_stations_by_day": _with(
        REPORT,
        """
SELECT report_date, stnNm AS station_name, lineNm AS line_name, totalNope,
       CAST(NULL AS BIGINT) AS rank_daily,
       CAST(row_number() OVER (PARTITION BY report_date
            ORDER BY totalNope DESC, stnNm, lineNm) AS INTEGER) AS position
FROM usage_day QUALIFY position <= 10""",
    ),
    "line_usage_stats": _with(
        USAGE,
        """
SELECT lineNm AS line_name, round(avg(totalNope), 6) AS avg_totalNope,
       max(totalNope) AS max_totalNope
FROM station_usage GROUP BY lineNm""",
    ),
    "line_wait_stats": _with(
        KPI,
        """
SELECT line_id, round(avg(avg_wait_sec), 6) AS avg_wait_sec,
       round(avg(p95_wait_sec), 6) AS p95_wait_sec,
       round(avg(long_wait_ratio_5), 6) AS long_wait_ratio_5,
       round(avg(express_ratio), 6) AS express_ratio
FROM kpi GROUP BY line_id""",
    ),
    "painful_stations": _with(
        REPORT,
        painful("kpi", "station_usage", "k.station_name = u.stnNm"),
        f" SELECT {PAIN_FIELDS} FROM (SELECT * FROM pairs ORDER BY {PAIN_ORDER} LIMIT 10)",
    ),
    "painful_stations_by_day": _with(
        REPORT,
        PAIN_BY_DAY,
        f"""
SELECT report_date, {PAIN_FIELDS}, position FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY report_date ORDER BY {PAIN_ORDER})
                 AS INTEGER) AS position
  FROM pairs) WHERE position <= 10""",
    ),
    "last_train_info": _with(
        KPI,
        """
SELECT station_name, line_id, strftime(last_train_dt, '%Y-%m-%d %H:%M:%S') AS last_train_time_str,
       round(last_train_wait_sec, 6) AS last_train_wait_sec
FROM kpi WHERE last_train_dt IS NOT NULL
ORDER BY last_train_dt DESC, station_name, line_id LIMIT 10""",
    ),
    "late_night_hotspots": _with(
        KPI,
        """
SELECT station_name, line_id, late_night_events
FROM kpi ORDER BY late_night_events DESC, station_name, line_id LIMIT 10""",
    ),
    "lagged_usage_report_day": _with(
        USAGE, " SELECT * FROM station_usage WHERE pasngYmd = '20240116'"
    ),
    "report_context": _with(
        REPORT,
        PAIN_BY_DAY,
        f""",
sections AS (
  SELECT report_date, 'top_stations_by_total' AS section, stnNm AS label,
         CAST(totalNope AS DOUBLE) AS measure,
         row_number() OVER (PARTITION BY report_date ORDER BY totalNope DESC, stnNm, lineNm) AS r
  FROM usage_day QUALIFY r <= 10
  UNION ALL
  SELECT report_date, 'line_usage_stats', lineNm, CAST(max(totalNope) AS DOUBLE),
         row_number() OVER (PARTITION BY report_date ORDER BY lineNm)
  FROM usage_day GROUP BY report_date, lineNm
  UNION ALL
  SELECT report_date, 'line_wait_stats', CAST(line_id AS VARCHAR), avg(avg_wait_sec),
         row_number() OVER (PARTITION BY report_date ORDER BY line_id)
  FROM kpi_day GROUP BY report_date, line_id
  UNION ALL
  SELECT report_date, 'painful_stations', station_name, pain_score,
         row_number() OVER (PARTITION BY report_date ORDER BY {PAIN_ORDER}) AS r
  FROM pairs QUALIFY r <= 10
  UNION ALL
  SELECT report_date, 'last_train_info', station_name, last_train_wait_sec,
         row_number() OVER (PARTITION BY report_date
           ORDER BY last_train_dt DESC, station_name, line_id) AS r
  FROM kpi_day WHERE last_train_dt IS NOT NULL QUALIFY r <= 10
  UNION ALL
  SELECT report_date, 'late_night_hotspots', station_name, CAST(late_night_events AS DOUBLE),
         row_number() OVER (PARTITION BY report_date
           ORDER BY late_night_events DESC, station_name, line_id) AS r
  FROM kpi_day QUALIFY r <= 10
),
days AS (SELECT report_date FROM kpi_day UNION SELECT report_date FROM usage_day),
seen AS (
  SELECT report_date, 'usage' AS section, 'has_data' AS label,
         CAST(report_date IN (SELECT report_date FROM usage_day) AS DOUBLE) AS measure, 1 AS r
  FROM days
  UNION ALL
  SELECT report_date, 'arrival', 'has_data',
         CAST(report_date IN (SELECT report_date FROM kpi_day) AS DOUBLE), 1
  FROM days
)
SELECT strftime(report_date, '%Y%m%d') AS target_ymd, section, CAST(r - 1 AS INTEGER) AS place,
       label, round(measure, 6) AS measure
FROM (SELECT report_date, section, label, measure, r FROM sections
      UNION ALL SELECT report_date, section, label, measure, r FROM seen)""",
    ),
    "station_names": """
SELECT DISTINCT 'ST' || s_suppkey AS STATN_NM FROM supplier ORDER BY 1""",
    "line_names": """
SELECT DISTINCT n_name AS "호선이름" FROM supplier JOIN nation ON s_nationkey = n_nationkey
ORDER BY 1""",
    "station_dim_join": _with(
        ARRIVALS,
        """
SELECT n_name AS ref_line_name, count(*) AS arrivals, count(arrival_seconds) AS known_waits,
       CAST(sum(arrival_seconds) AS BIGINT) AS wait_sum
FROM arr LEFT JOIN (SELECT * FROM supplier JOIN nation ON s_nationkey = n_nationkey)
  ON station_id = s_suppkey
GROUP BY n_name""",
    ),
    "json_field_extract": _with(KEYED, " SELECT event_id, k FROM keyed"),
    "ready_event_lookup": """
SELECT DISTINCT 'gold_ready:' || strftime(ts, '%Y%m%d') AS "key", 'gold_ready' AS "event",
       strftime(ts, '%Y%m%d') AS target_ymd,
       'gold/arrival/dt=' || strftime(ts, '%Y%m%d') || '/' AS arrival,
       'gold/position/dt=' || strftime(ts, '%Y%m%d') || '/' AS position, 'run-1' AS run_id
FROM events""",
    "usage_envelope_rows": _with(
        BRONZE_USAGE, " SELECT * EXCLUDE (run_ts) FROM bronze WHERE GTON_TNOPE IS NOT NULL"
    ),
    "usage_envelope_rejects": _with(
        BRONZE_USAGE,
        """
SELECT 'INFO-200 no data' AS reason, count(*) AS pages FROM bronze WHERE GTON_TNOPE IS NULL""",
    ),
    "sketched_windows_and_days": _with(
        ARRIVALS
        + """,
spans AS (
  SELECT 'day' AS kind, date_trunc('day', event_time) + INTERVAL 1 DAY AS ending, * FROM arr
  UNION ALL
  SELECT 'window', to_timestamp((CAST(floor(epoch(event_time) / 28800) AS BIGINT) + i) * 28800) AT TIME ZONE 'UTC', arr.*
  FROM arr, range(1, 4) AS t(i)
)""",
        """
SELECT kind, CAST(ending AS TIMESTAMP) AS ending, line_id, count(*) AS n, count(arrival_seconds) AS known_rows,
       round(avg(arrival_seconds), 6) AS avg_eta_sec,
       round(avg(CAST(coalesce(arrival_seconds, 0) >= 600 AS INTEGER)), 6) AS long_ratio_10m,
       coalesce(bool_or(is_last_train), FALSE) AS last_train_seen, TRUE AS within_error
FROM spans GROUP BY kind, ending, line_id""",
    ),
    "landed_pages_and_rejects": _with(
        BRONZE_USAGE,
        """
SELECT USE_YMD AS what, count(*) AS n, CAST(sum(CAST(GTON_TNOPE AS BIGINT)) AS BIGINT) AS boarded
FROM bronze WHERE GTON_TNOPE IS NOT NULL GROUP BY USE_YMD
UNION ALL SELECT 'INFO-200 no data', count(*), NULL FROM bronze WHERE GTON_TNOPE IS NULL""",
    ),
    "arrival_envelope_rows": _with(
        BRONZE_ARRIVALS,
        """
SELECT received AS recptnDt, station AS statnId, 'ST' || user_id AS statnNm,
       CAST(1001 + user_id % 9 AS VARCHAR) AS subwayId,
       CASE WHEN event_id % 2 = 0 THEN 'up' ELSE 'down' END AS updnLine,
       CAST(user_id - 1 AS VARCHAR) AS statnFid, CAST(user_id + 1 AS VARCHAR) AS statnTid,
       CAST(event_id AS VARCHAR) AS btrainNo, event_type AS btrainSttus, wait AS barvlDt,
       CASE WHEN k % 11 <> 0 THEN CAST(k % 7 AS VARCHAR) END AS arvlCd,
       CASE WHEN k >= 95 THEN '1' WHEN k >= 5 THEN '0' ELSE '2' END AS lstcarAt,
       '{"ordkey":"' || k || '"}' AS other_fields, 'ALL' AS query_station_name
FROM raw WHERE event_type <> 'error'""",
    ),
    "arrival_envelope_rejects": """
SELECT '500 ERROR-500 server error' AS reason, count(*) AS documents
FROM events WHERE event_type = 'error'""",
    "partition_replace_roundtrip": """
SELECT o_orderkey, o_custkey,
       round(CASE WHEN year(o_orderdate) = 1997 AND month(o_orderdate) = 5
             THEN o_totalprice + 1 ELSE o_totalprice END, 6) AS o_totalprice,
       CAST(year(o_orderdate) AS INTEGER) AS "year", CAST(month(o_orderdate) AS INTEGER) AS "month"
FROM orders WHERE year(o_orderdate) <> 1996""",
    "latest_partition_found": """
SELECT strftime(min(o_orderdate), '%Y') AS "year", strftime(min(o_orderdate), '%m') AS "month"
FROM orders""",
    "highest_partition_found": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS "year", CAST(month(o_orderdate) AS INTEGER) AS "month",
       count(*) AS orders
FROM orders
WHERE date_trunc('month', o_orderdate) = (SELECT date_trunc('month', max(o_orderdate)) FROM orders)
GROUP BY 1, 2""",
    "new_partitions_found": """
SELECT DISTINCT 0 AS run, strftime(o_orderdate, '%Y') AS "year", strftime(o_orderdate, '%m') AS "month"
FROM orders
UNION ALL
SELECT DISTINCT 2, strftime(o_orderdate, '%Y'), strftime(o_orderdate, '%m')
FROM orders WHERE o_custkey % 2 = 0 AND year(o_orderdate) < 1995""",
    "clashing_files_read": """
SELECT c_custkey, c_acctbal,
       CASE WHEN c_custkey % 2 = 1 THEN 'n' ELSE '' END || c_nationkey AS c_nationkey
FROM customer""",
    "compaction_roundtrip": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS "year", CAST(month(o_orderdate) AS INTEGER) AS "month",
       count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS price
FROM orders GROUP BY 1, 2""",
    "catalog_table_roundtrip": _with(
        USAGE,
        """
SELECT use_ymd, line_name, CAST(sum(total_count) AS BIGINT) AS daily_total
FROM usage GROUP BY use_ymd, line_name""",
    ),
    "stream_arrival_metrics_15m": _with(
        ARRIVALS, sliding(15, 5), metric_rows(15, f"window_end <= {CLOSED}")
    ),
    "stream_metrics_over_files": _with(
        ARRIVALS, sliding(15, 5), metric_rows(15, f"window_end <= {CLOSED}")
    ),
    "stream_late_windows_rerun": f"""
SELECT m.*, late_rows FROM ({_with(ARRIVALS, sliding(1440, 480), metric_rows(1440))}) m JOIN (
  SELECT to_timestamp(slot * 28800 + i * 28800 + 28800) AT TIME ZONE 'UTC' AS missed_end, CAST(count(*) AS BIGINT) AS late_rows
  FROM (SELECT CAST(floor(epoch(ts) / 28800) AS BIGINT) AS slot FROM events WHERE event_id % 40 = 0), range(3) AS t(i)
  WHERE to_timestamp(slot * 28800 + 28800) AT TIME ZONE 'UTC' <=
    (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM events WHERE event_id % 40 <> 0)
  GROUP BY ALL
) ON missed_end = window_end_ts""",
    "stream_latest_versions": """
WITH marked AS (
  SELECT *, ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 1 HOUR AS anew
  FROM events
), quiet AS (
  SELECT *, count(*) FILTER (WHERE anew) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS spell
  FROM marked
)
SELECT user_id, event_id % 97 AS version, event_id, ts AS t FROM quiet
QUALIFY row_number() OVER (PARTITION BY user_id, spell ORDER BY event_id % 97 DESC, event_id DESC) = 1
  AND max(ts) OVER (PARTITION BY user_id, spell) + INTERVAL 1 HOUR
      <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 8 HOUR FROM events)""",
    "stream_dedup": "SELECT event_id, user_id, ts AS t FROM events",
    "stream_window_replace": _with(
        ARRIVALS,
        sliding(1440, 480) + HEALTH,
        HEALTH_ROWS + f" WHERE window_end_ts <= {CLOSED}",
    ),
}

NOTIFICATIONS = """
SELECT 'purchase:' || strftime(ts, '%Y%m%d') AS "key", strftime(ts, '%Y%m%d') AS target_ymd,
       CAST(event_id AS VARCHAR) AS run_id,
       'Tables of ' || strftime(ts, '%Y%m%d') || ' are complete (run ' || event_id || ').' || chr(10)
       || 'Arrivals: gold/arrival/dt=' || strftime(ts, '%Y%m%d') || chr(10)
       || 'Positions: gold/position/dt=' || strftime(ts, '%Y%m%d') || chr(10) AS content
FROM events WHERE event_type = 'purchase'"""

SQL["arrival_metrics_one_pass"] = SQL["arrival_metrics_15m"]
SQL["event_filter"] = NOTIFICATIONS
SQL["stream_event_filter"] = NOTIFICATIONS
SQL["usage_daily_total_top20_sql"] = SQL["usage_daily_total_top20"]
SQL["drifting_files_read"] = SQL["union_schema_drift"]
