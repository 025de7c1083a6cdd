"""DuckDB statements equivalent to ``hourmill.plans.queries``.

Averages are exact DECIMAL sums divided by counts; where the Spark side sums
doubles, both are compared at nine decimals. Epoch seconds are whole seconds.
"""

from __future__ import annotations

_SECONDS = "(epoch_us({ts}) // 1000000)"

# Stand-in series, mirroring ``hourmill.plans.testbed``.
SERIES_CTE = """
  e AS (SELECT date_trunc('hour', ts) AS timestamp, max(value) AS price
        FROM events WHERE event_type = 'view' GROUP BY 1),
  w AS (SELECT date_trunc('hour', ts) AS timestamp, min(value) AS temperature_2m,
               max(value) AS wind_speed_10m, CAST(count(*) AS DOUBLE) AS direct_radiation
        FROM events WHERE event_type = 'click' GROUP BY 1),
  a AS (SELECT date_trunc('hour', ts) AS timestamp, min(value) AS carbon_monoxide,
               CAST(count(*) AS DOUBLE) AS nitrogen_dioxide, max(value) AS pm10
        FROM events WHERE event_type = 'error' GROUP BY 1)
"""


def gold_sql(threshold: float = 60.0, series_cte: str = SERIES_CTE) -> str:
    sec = _SECONDS.format(ts="j.timestamp")
    return f"""
WITH {series_cte},
  j AS (SELECT e.timestamp, e.price,
               w.temperature_2m AS wx_temperature_2m, w.wind_speed_10m AS wx_wind_speed_10m,
               w.direct_radiation AS wx_direct_radiation,
               a.carbon_monoxide AS aq_carbon_monoxide, a.nitrogen_dioxide AS aq_nitrogen_dioxide,
               a.pm10 AS aq_pm10
        FROM e LEFT JOIN w ON e.timestamp = w.timestamp LEFT JOIN a ON e.timestamp = a.timestamp),
  r AS (SELECT j.*,
               sum(CAST(j.price AS DECIMAL(18,6))) OVER win AS fs,
               count(j.price) OVER win AS fc
        FROM j WINDOW win AS (ORDER BY {sec} RANGE BETWEEN 10800 PRECEDING AND 1 PRECEDING)),
  g AS (SELECT r.*, CASE WHEN fc > 0 THEN CAST(fs AS DOUBLE) / fc END AS avg_price_last_3h FROM r)
SELECT timestamp, price, avg_price_last_3h,
       CASE WHEN avg_price_last_3h IS NOT NULL AND avg_price_last_3h <> 0
            THEN (price - avg_price_last_3h) / avg_price_last_3h END AS pct_vs_3h_avg,
       wx_temperature_2m, wx_wind_speed_10m, wx_direct_radiation,
       aq_carbon_monoxide, aq_nitrogen_dioxide, aq_pm10,
       CASE WHEN avg_price_last_3h IS NOT NULL AND price < avg_price_last_3h
                 AND wx_wind_speed_10m IS NOT NULL AND wx_wind_speed_10m >= {float(threshold)}
            THEN 'CHEAP' ELSE 'NORMAL' END AS label
FROM g
"""


TRAILING_AVG = f"""
SELECT event_id, ts, value,
       CASE WHEN fc > 0 THEN CAST(fs AS DOUBLE) / fc END AS avg_value_last_3h,
       fc AS n_prev_3h
FROM (SELECT event_id, ts, value,
             sum(CAST(value AS DECIMAL(18,6))) OVER win AS fs,
             count(value) OVER win AS fc
      FROM events
      WINDOW win AS (ORDER BY {_SECONDS.format(ts='ts')} RANGE BETWEEN 10800 PRECEDING AND 1 PRECEDING))
"""


def nine_places(sql: str, columns: list[str]) -> str:
    """A statement with some of its columns rounded."""
    rounded = ", ".join(f"round({c}, 9) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({rounded}) FROM ({sql})"


GOLD_CTE = "gold AS (" + gold_sql(60.0).strip().replace("WITH ", "SELECT * FROM (WITH ", 1) + "))"

_HOURLY_CLICK = "SELECT date_trunc('hour', ts) AS timestamp, max(value) AS value FROM events WHERE event_type = 'click' GROUP BY 1"
_HOURLY_VIEW_WINDOW = (
    "SELECT date_trunc('hour', ts) AS timestamp, max(value) AS value FROM events "
    "WHERE event_type = 'view' AND ts >= TIMESTAMP '2024-01-13 00:00:00' AND ts < TIMESTAMP '2024-01-21 00:00:00' GROUP BY 1"
)
UPSERT = f"""
WITH t AS ({_HOURLY_CLICK}), s AS ({_HOURLY_VIEW_WINDOW}),
  u AS (SELECT * FROM s UNION ALL SELECT * FROM t WHERE timestamp NOT IN (SELECT timestamp FROM s))
SELECT timestamp, value, CAST(timestamp AS DATE) AS date, md5(CAST(timestamp AS VARCHAR)) AS hk FROM u
"""

ZIP_ROWS = """
SELECT vec_id, label, unnest(generate_series(0, len(embedding) - 1)) AS idx, unnest(embedding) AS value
FROM embeddings
"""

ZIP_ROWS_RAGGED = """
SELECT l_orderkey, l_linenumber AS line,
       CASE WHEN row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity)
                 = count(*) OVER (PARTITION BY l_orderkey) THEN NULL ELSE l_quantity END AS qty
FROM lineitem
"""

EXPLODE_RECORDS = """
SELECT o.o_orderkey AS order_key, o.o_orderdate AS from_date, o.o_orderdate + INTERVAL 1 DAY AS till_date,
       CAST(4 AS BIGINT) AS interval_type, o.o_totalprice AS average,
       l.l_shipdate AS timestamp, l.l_extendedprice AS price
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
"""

SNAPSHOT_READ = """
WITH w AS (SELECT date_trunc('hour', ts) AS timestamp, min(value) AS temperature_2m,
                  max(value) AS wind_speed_10m, CAST(count(*) AS DOUBLE) AS direct_radiation
           FROM events WHERE event_type = 'click' GROUP BY 1)
SELECT timestamp, temperature_2m, wind_speed_10m, direct_radiation,
       CAST(timestamp AS DATE) AS date, md5(CAST(timestamp AS VARCHAR)) AS hk
FROM w
"""

TRAILING_EXTRACT = """
SELECT event_id, ts, event_type, value, '2024-01-13_2024-01-20' AS snapshot
FROM events WHERE ts >= TIMESTAMP '2024-01-13 00:00:00' AND ts < TIMESTAMP '2024-01-21 00:00:00'
"""

SNAKE_COLUMNS = """
SELECT c_custkey, c_name, c_acctbal AS acct_bal, c_mktsegment AS mkt_segment FROM customer
"""

PICK_COLUMNS = """
SELECT o_orderkey, o_custkey AS ord_o_custkey, o_totalprice AS ord_o_totalprice,
       o_orderdate AS ord_o_orderdate
FROM orders
"""

HASH_KEY = """
SELECT event_id,
       md5(concat_ws('||', coalesce(CAST(ts AS VARCHAR), ''), coalesce(CAST(user_id AS VARCHAR), ''),
                     coalesce(CASE WHEN event_type <> 'error' THEN event_type END, ''))) AS hk
FROM events
"""

UTC_POLICY = """
SELECT event_id, timezone('UTC', timezone('Europe/Amsterdam', ts)) AS ts_utc FROM events
"""

DATE_PARTITION = """
SELECT CAST(ts AS DATE) AS date, count(*) AS n_events, max(value) AS max_value FROM events GROUP BY 1
"""

MALFORMED_TIME = """
SELECT event_id, ts_parsed FROM (
  SELECT event_id,
         try_cast(CASE WHEN event_type = 'error' THEN props ELSE CAST(ts AS VARCHAR) END AS TIMESTAMP) AS ts_parsed
  FROM events)
WHERE ts_parsed IS NOT NULL
"""

DEDUPE_LATEST = """
SELECT date_trunc('hour', ts) AS hour, event_type, ts, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY date_trunc('hour', ts), event_type ORDER BY ts DESC, event_id DESC) = 1
"""

RECOMPUTE_START = """
WITH e AS (SELECT date_trunc('hour', ts) AS timestamp FROM events WHERE event_type = 'view' GROUP BY 1)
SELECT max(timestamp) AS hwm, max(timestamp) - INTERVAL 6 HOUR AS start_ts FROM e
"""

READ_SILVER_BOUND = """
WITH e AS (SELECT date_trunc('hour', ts) AS timestamp, max(value) AS value
           FROM events WHERE event_type = 'view' GROUP BY 1)
SELECT timestamp, value, CAST(timestamp AS DATE) AS date, md5(CAST(timestamp AS VARCHAR)) AS hk
FROM e WHERE timestamp >= TIMESTAMP '2024-01-20 06:00:00'
"""

# Totals of doubles are compared at six decimals: their last digits depend on the order of summation.
_DEC = "round(sum({c}), 6) AS sum_{c}"

CHART = f"""
WITH {GOLD_CTE}
SELECT price, {_DEC.format(c='avg_price_last_3h')} FROM gold GROUP BY price
"""

_SUMMED = [
    "price", "avg_price_last_3h", "pct_vs_3h_avg", "wx_temperature_2m", "wx_wind_speed_10m",
    "wx_direct_radiation", "aq_carbon_monoxide", "aq_nitrogen_dioxide", "aq_pm10",
]
DEFAULT_SUMS = f"""
WITH {GOLD_CTE}
SELECT label, {", ".join(_DEC.format(c=c) for c in _SUMMED)} FROM gold GROUP BY label
"""

RELATIONSHIP = f"""
WITH {GOLD_CTE},
  a AS (SELECT date_trunc('hour', ts) AS timestamp, min(value) AS carbon_monoxide,
               CAST(count(*) AS DOUBLE) AS nitrogen_dioxide, max(value) AS pm10
        FROM events WHERE event_type = 'error' GROUP BY 1)
SELECT coalesce(g.timestamp, a.timestamp) AS timestamp, g.price, g.avg_price_last_3h, g.pct_vs_3h_avg,
       g.wx_temperature_2m, g.wx_wind_speed_10m, g.wx_direct_radiation,
       g.aq_carbon_monoxide, g.aq_nitrogen_dioxide, g.aq_pm10, g.label,
       a.carbon_monoxide AS air_carbon_monoxide, a.nitrogen_dioxide AS air_nitrogen_dioxide, a.pm10 AS air_pm10
FROM gold g FULL OUTER JOIN a ON g.timestamp = a.timestamp
"""

PREVIEW = f"""
WITH {GOLD_CTE}
SELECT * FROM gold ORDER BY timestamp LIMIT 1000
"""

RUN_LOG = """
SELECT CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level, event_type AS step,
       count(*) AS n_events
FROM events GROUP BY 1, 2
"""


UPSERT_TEXT_PARTITION = """
SELECT event_id, CASE WHEN event_type = 'view' THEN value + 1 ELSE value END AS value,
       lpad(CAST(user_id % 13 AS VARCHAR), 3, '0') AS part
FROM events
"""

REPLACE_SCHEMA = """
SELECT event_id, value, user_id, CAST(ts AS DATE) AS date FROM events
"""

WRITE_METRICS = f"""
WITH t AS ({_HOURLY_CLICK}), s AS ({_HOURLY_VIEW_WINDOW}),
  c AS (SELECT s.timestamp FROM s LEFT JOIN t ON t.timestamp = s.timestamp WHERE t.timestamp IS NULL OR t.value IS DISTINCT FROM s.value)
SELECT 'hourly' AS table_name, 'replace' AS mode, count(*) AS batch_rows, count(*) AS changed_rows,
       CAST(NULL AS BIGINT) AS named_partitions, CAST(NULL AS BIGINT) AS rewritten_partitions, min(timestamp) AS earliest_change FROM t
UNION ALL
SELECT 'hourly', 'upsert', (SELECT count(*) FROM s), count(*), (SELECT count(DISTINCT CAST(timestamp AS DATE)) FROM s),
       count(DISTINCT CAST(timestamp AS DATE)), min(timestamp) FROM c
"""

_PRICES = "SELECT date_trunc('hour', ts) AS timestamp, max(value) AS price FROM events WHERE event_type = 'view' GROUP BY 1"

# The fetch of a run date covers its day and the seven before.
SNAPSHOT_RUNS = f"""
WITH e AS ({_PRICES}), r AS (SELECT * FROM (VALUES (DATE '2024-01-12', FALSE), (DATE '2024-01-20', TRUE), (DATE '2024-01-28', FALSE)) AS v(run_date, fell_back))
SELECT run_date, fell_back, timestamp, price FROM e JOIN r
  ON CASE WHEN fell_back THEN timestamp >= DATE '2024-01-05' AND timestamp < DATE '2024-01-13' OR timestamp >= DATE '2024-01-21' AND timestamp < DATE '2024-01-29'
          ELSE timestamp >= run_date - 7 AND timestamp < run_date + 1 END
"""

BRONZE_CLEARED = f"""
WITH e AS ({_PRICES}) SELECT * FROM e WHERE timestamp >= DATE '2024-01-16' AND timestamp < DATE '2024-01-24'
"""

# Of the hours in the fetch of 18 January only those of the 11th are in no later one.
OLDER_RERUN = f"""
WITH e AS ({_PRICES}) SELECT timestamp, CASE WHEN CAST(timestamp AS DATE) = DATE '2024-01-11' THEN price + 1 ELSE price END AS price FROM e
"""

SQL_TOP = """
SELECT event_id, ts, event_type, value FROM events ORDER BY ts DESC, event_id LIMIT 1000
"""

LOG_TABLE = """
SELECT ts AS event_ts, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level, 'events' AS logger, 'events' AS dataset,
       event_type AS step, 'event ' || event_id AS message, '{"kind":"' || event_type || '","user":"' || user_id || '"}' AS extra_json
FROM events
"""


def statements() -> dict[str, str]:
    exact = gold_sql(60.0)
    gold = nine_places(exact, ["avg_price_last_3h", "pct_vs_3h_avg"])
    return {
        "gold_flag": gold,
        "gold_flag_exact": exact,
        "trailing_avg": nine_places(TRAILING_AVG, ["avg_value_last_3h"]),
        "trailing_avg_exact": TRAILING_AVG,
        "zip_rows": ZIP_ROWS,
        "zip_rows_ragged": ZIP_ROWS_RAGGED,
        "explode_records": EXPLODE_RECORDS,
        "snapshot_read": SNAPSHOT_READ,
        "trailing_extract": TRAILING_EXTRACT,
        "snake_columns": SNAKE_COLUMNS,
        "pick_columns": PICK_COLUMNS,
        "hash_key": HASH_KEY,
        "utc_policy": UTC_POLICY,
        "date_partition": DATE_PARTITION,
        "malformed_time": MALFORMED_TIME,
        "dedupe_latest": DEDUPE_LATEST,
        "upsert_path": UPSERT,
        "upsert_table": UPSERT,
        "upsert_twice": UPSERT,
        "upsert_text_partition": UPSERT_TEXT_PARTITION,
        "replace_schema": REPLACE_SCHEMA,
        "write_metrics": WRITE_METRICS,
        "snapshot_runs": SNAPSHOT_RUNS,
        "bronze_cleared": BRONZE_CLEARED,
        "older_rerun": OLDER_RERUN,
        "recompute_start": RECOMPUTE_START,
        "gold_incremental": gold,
        "gold_correction": gold,
        "gold_retry": gold,
        "read_silver_bound": READ_SILVER_BOUND,
        "chart": CHART,
        "default_sums": DEFAULT_SUMS,
        "relationship": RELATIONSHIP,
        "preview": PREVIEW,
        "sql_top": SQL_TOP,
        "run_log": RUN_LOG,
        "log_table": LOG_TABLE,
        "end_to_end": gold,
        "streaming_ingest": gold,
    }
