"""DuckDB SQL for the bindings, shared by the oracle queries.

The oracles are independent re-statements of each operator in plain SQL;
they run in DuckDB over the same parquet tables and are what the Spark
results are compared with.
"""

from __future__ import annotations

# B1: service metrics per 6 h bucket.
METRICS_CTE = """metrics AS (
  SELECT '10.0.0.' || CAST(user_id % 2 AS VARCHAR) || ':8080' AS ip_port,
         'svc_' || CAST(user_id % 5 AS VARCHAR) AS server_name,
         time_bucket(INTERVAL '6 hours', ts) AS ts,
         CAST(count(*) AS DOUBLE) AS connection_count,
         avg(value) AS response_time,
         CAST(count(*) FILTER (WHERE event_type = 'error') AS DOUBLE) AS eps,
         CAST(count(*) AS DOUBLE) AS qps
  FROM events GROUP BY 1, 2, 3)"""

SPLIT = "TIMESTAMP '2024-01-22 00:00:00'"

# B2 phases on top of B1.
PHASES_CTE = METRICS_CTE + f""",
base AS (SELECT * FROM metrics WHERE ts < {SPLIT}),
prob AS (SELECT * FROM metrics WHERE ts >= {SPLIT})"""

# Call edges.
EDGES_CTE = """ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_type
  FROM events),
edges AS (
  SELECT event_id, ts, user_id, prev_type AS src, event_type AS dst, value AS rt,
         CAST(CASE WHEN k >= 90 THEN 1 ELSE 0 END AS DOUBLE) AS error, k
  FROM ev WHERE prev_type IS NOT NULL AND prev_type <> event_type)"""

# Server rows.
SERVERS_CTE = """servers AS (
  SELECT CAST(user_id % 20 AS INTEGER) AS server_id,
         time_bucket(INTERVAL '6 hours', ts) AS ts,
         CAST(count(*) AS DOUBLE) AS cpu_us,
         avg(value) AS cpu_sy,
         max(value) AS mem_free,
         avg(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS io_bi,
         (['DB', 'Web', 'App'])[CAST(user_id % 20 AS INTEGER) % 3 + 1] AS type
  FROM events GROUP BY 1, 2, 7)"""

# Acyclic graph region -> nation -> supplier.
DAG_CTE = """dag AS (
  SELECT DISTINCT 'region:' || r_name AS src, 'nation:' || n_name AS dst
  FROM region JOIN nation ON r_regionkey = n_regionkey
  UNION
  SELECT DISTINCT 'nation:' || n_name, 'supplier:' || s_name
  FROM nation JOIN supplier ON n_nationkey = s_nationkey)"""

# Counters on the hourly scrape grid (from B3).
COUNTERS_CTE = EDGES_CTE + """,
req_hourly AS (
  SELECT src, dst, CASE WHEN error > 0 THEN '500' ELSE '200' END AS response_code,
         time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS ts,
         CAST(count(*) AS DOUBLE) AS n
  FROM edges GROUP BY 1, 2, 3, 4),
requests_total AS (
  SELECT src, dst, response_code, ts,
         sum(n) OVER (PARTITION BY src, dst, response_code ORDER BY ts
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
  FROM req_hourly),
les AS (SELECT * FROM (VALUES (10.0::DOUBLE), (25.0), (50.0), (100.0), (250.0), ('inf'::DOUBLE)) t(le)),
bucket_hourly AS (
  SELECT e.src, e.dst, time_bucket(INTERVAL '1 hour', e.ts) + INTERVAL '1 hour' AS ts, l.le,
         CAST(count(*) FILTER (WHERE e.rt <= l.le) AS DOUBLE) AS n
  FROM edges e CROSS JOIN les l GROUP BY 1, 2, 3, 4),
duration_bucket AS (
  SELECT src, dst, le, ts,
         sum(n) OVER (PARTITION BY src, dst, le ORDER BY ts
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
  FROM bucket_hourly),
sum_hourly AS (
  SELECT src, dst, time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS ts, sum(rt) AS n
  FROM edges GROUP BY 1, 2, 3),
duration_sum AS (
  SELECT src, dst, ts,
         sum(n) OVER (PARTITION BY src, dst ORDER BY ts
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
  FROM sum_hourly)"""


def w(keys="ip_port, server_name", order="ts", frame=""):
    """Window clause text."""
    return f"(PARTITION BY {keys} ORDER BY {order} {frame})"


def guarded(agg, col, n, keys="ip_port, server_name"):
    fr = w(keys, frame=f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW")
    return f"CASE WHEN count({col}) OVER {fr} = {n} THEN {agg}({col}) OVER {fr} END"


def features_sql(src: str, metric: str, keys: str = "ip_port, server_name",
                 plain: bool = True, extra_cols: str = "") -> str:
    """SQL for the engineered features of one metric over relation ``src``
    (a CTE name).  Produces CTE text ``feat_<src>`` with the same columns as
    ``add_features(..., naming='plain' or 'suffix', log1p=plain)``."""
    n = (lambda f: f) if plain else (lambda f: f"{metric}_{f}")
    W = w(keys)
    return f"""f1_{src} AS (
  SELECT *, row_number() OVER {W} - 1 AS _ord,
    {guarded('avg', metric, 5, keys)} AS _rm5,
    lag({metric}) OVER {W} AS _prev,
    {guarded('max', metric, 10, keys)} AS _rmax,
    {guarded('avg', metric, 10, keys)} AS _rmean
  FROM {src}),
f2_{src} AS (
  SELECT *, {metric} - _prev AS _diff,
    ({metric} - _prev) / nullif(_prev, 0) AS _rc,
    CAST(coalesce({metric} > lag(_rmax) OVER {W}, false) AS INTEGER) AS _gmax,
    CAST(coalesce({metric} > lag(_rmean) OVER {W}, false) AS INTEGER) AS _gavg,
    _rmax - lag(_rmax, 10) OVER {W} AS _dmax,
    _rmean - lag(_rmean, 10) OVER {W} AS _davg,
    {metric} / nullif(lag(_rmean) OVER {W}, 0) AS _ravg
  FROM f1_{src}),
feat_{src} AS (
  SELECT {keys}, ts, {metric}{extra_cols},
    coalesce(_rm5, 0) AS {n('rolling_mean')},
    coalesce(_diff, 0) AS {n('diff')},
    coalesce(_rc, 0) AS {n('rate_change')},
    CAST(coalesce(sum(_gmax) OVER (PARTITION BY {keys}, floor(_ord / 10)), 0) AS DOUBLE) AS {n('over_max_count')},
    CAST(coalesce(sum(_gavg) OVER (PARTITION BY {keys}, floor(_ord / 10)), 0) AS DOUBLE) AS {n('over_avg_count')},
    coalesce(_dmax, 0) AS {n('delta_max')},
    coalesce(_davg, 0) AS {n('delta_avg')},
    coalesce(_ravg, 0) AS {n('ratio_avg')}
    {", ln(1 + " + metric + ") AS conn_log" if plain else ""},
    CAST(hour(ts) AS INTEGER) AS hour,
    CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week
  FROM f2_{src})"""
