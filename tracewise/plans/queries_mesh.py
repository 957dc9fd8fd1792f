"""Registered queries: call edges, counters, PromQL operators, mesh reports."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewise.functions.columns import epoch_seconds, to_naive
from tracewise.plans import mesh
from tracewise.plans.sqlbits import COUNTERS_CTE, EDGES_CTE
from tracewise.registry import register
from tracewise.sources.bindings import edge_points, requests_total

E = "src, dst"


def _rate_cte(name: str, counter: str, series: str) -> str:
    """DuckDB text of PQL1 over CTE ``counter`` grouped by ``series``."""
    return f"""{name}_d AS (
  SELECT {series}, ts, lag(ts) OVER w AS prev_ts,
         CASE WHEN value < lag(value) OVER w THEN value ELSE value - lag(value) OVER w END AS d
  FROM {counter} WINDOW w AS (PARTITION BY {series} ORDER BY ts)),
{name}_x AS (
  SELECT {series}, ts, prev_ts, d,
         time_bucket(INTERVAL '3 hours', ts - INTERVAL '1 microsecond') + INTERVAL '3 hours'
           + to_hours(CAST(3 * k AS BIGINT)) AS t
  FROM {name}_d, range(0, 2) AS r(k) WHERE prev_ts IS NOT NULL),
{name} AS (
  SELECT {series}, t AS ts, sum(d) AS increase,
         sum(d) / nullif(epoch(max(ts)) - epoch(min(prev_ts)), 0) AS rate
  FROM {name}_x WHERE prev_ts > t - INTERVAL '6 hours' GROUP BY {series}, t)"""


REQ_RATES = COUNTERS_CTE + ",\n" + _rate_cte("req_rate", "requests_total", "src, dst, response_code")
RPS = REQ_RATES + f""",
rps AS (SELECT ts, {E}, sum(rate) AS rps FROM req_rate GROUP BY ts, {E})"""
ERR = REQ_RATES + f""",
err AS (SELECT ts, {E},
          sum(rate) FILTER (WHERE regexp_full_match(response_code, '5..')) / nullif(sum(rate), 0) AS error_rate
        FROM req_rate GROUP BY ts, {E}
        HAVING count(*) FILTER (WHERE regexp_full_match(response_code, '5..')) > 0)"""


def _quantile_cte(q: float, out: str) -> str:
    return _rate_cte("bk_rate", "duration_bucket", "src, dst, le") + f""",
bk_sum AS (SELECT ts, {E}, le, sum(rate) AS c FROM bk_rate GROUP BY ts, {E}, le),
bk AS (SELECT ts, {E}, list(struct_pack(le := le, c := c) ORDER BY le) AS b FROM bk_sum GROUP BY ts, {E}),
bk2 AS (SELECT ts, {E}, b, b[-1].c AS total, {q} * b[-1].c AS rnk,
               len(list_filter(b, lambda x: x.c < {q} * b[-1].c)) AS below FROM bk),
lat_{out} AS (
  SELECT ts, {E},
    CASE WHEN b[below + 1].le = 'inf'::DOUBLE THEN b[-2].le
         ELSE coalesce(CASE WHEN below > 0 THEN b[below].le END, 0)
              + (b[below + 1].le - coalesce(CASE WHEN below > 0 THEN b[below].le END, 0))
              * (rnk - coalesce(CASE WHEN below > 0 THEN b[below].c END, 0))
              / nullif(b[below + 1].c - coalesce(CASE WHEN below > 0 THEN b[below].c END, 0), 0)
    END AS {out}
  FROM bk2 WHERE total > 0)"""


@register("src5_edge_points", sql=f"WITH {EDGES_CTE} SELECT * FROM edges")
def src5_edge_points(spark, sf_dir):
    """Call edges: per user the previous event type calls the current one
    (ordered by ts, event_id; per-day split with boundary repair)."""
    return edge_points(spark, sf_dir)


@register("pql1_rate", sql=f"WITH {REQ_RATES} SELECT * FROM req_rate")
def pql1_rate(spark, sf_dir):
    """PQL1: reset-aware increase and rate of the request counter."""
    return mesh.request_rates(mesh.counters_for(spark, sf_dir))


@register("pql1_extrapolated_rate", sql=f"""WITH {COUNTERS_CTE},
d AS (SELECT {E}, response_code, ts, lag(ts) OVER w AS prev_ts, lag(value) OVER w AS prev_value,
        CASE WHEN value < lag(value) OVER w THEN value ELSE value - lag(value) OVER w END AS d
      FROM requests_total WINDOW w AS (PARTITION BY src, dst, response_code ORDER BY ts)),
x AS (SELECT *, time_bucket(INTERVAL '3 hours', ts - INTERVAL '1 microsecond') + INTERVAL '3 hours'
        + to_hours(CAST(3 * k AS BIGINT)) AS t FROM d, range(0, 2) AS r(k) WHERE prev_ts IS NOT NULL),
g AS (SELECT {E}, response_code, t, sum(d) AS inc, count(*) AS gaps, epoch(max(ts)) AS hi, epoch(min(prev_ts)) AS lo,
        arg_min(prev_value, prev_ts) AS v0 FROM x WHERE prev_ts > t - INTERVAL '6 hours' GROUP BY ALL),
h AS (SELECT *, hi - lo AS span, (hi - lo) / gaps AS gap, lo - epoch(t) + 21600 AS head, epoch(t) - hi AS tail FROM g),
e AS (SELECT *, least(CASE WHEN head < 1.1 * gap THEN head ELSE gap / 2 END,
                 CASE WHEN inc > 0 AND v0 >= 0 THEN span * v0 / inc ELSE 1e300 END) AS a,
        CASE WHEN tail < 1.1 * gap THEN tail ELSE gap / 2 END AS b FROM h)
SELECT {E}, response_code, t AS ts, inc * (span + a + b) / span AS increase, inc * (span + a + b) / span / 21600 AS rate FROM e""")
def pql1_extrapolated_rate(spark, sf_dir):
    """PQL1 as the metric store evaluates it: the increase stretched to the
    borders of the range."""
    from tracewise.operators import promql
    c = requests_total(mesh.counters_for(spark, sf_dir))
    return promql.increase_and_rate(c, [*mesh.EDGE, "response_code"], mesh.P.range_, mesh.P.step, extrapolate=True)


@register("pql2_sum_by", sql=f"WITH {RPS} SELECT * FROM rps")
def pql2_sum_by(spark, sf_dir):
    """PQL2: ``sum(rate(...)) by (src, dst)``."""
    return mesh.rps(mesh.counters_for(spark, sf_dir))


@register("pql3_histogram_quantile", sql=f"WITH {COUNTERS_CTE}, {_quantile_cte(0.95, 'latency_ms')} "
                                         f"SELECT * FROM lat_latency_ms")
def pql3_histogram_quantile(spark, sf_dir):
    """PQL3: P95 latency per edge from cumulative bucket counters."""
    return mesh.latency_quantile(mesh.counters_for(spark, sf_dir))


@register("pql3_histogram_p90", sql=f"WITH {COUNTERS_CTE}, {_quantile_cte(0.9, 'rt')} SELECT * FROM lat_rt")
def pql3_histogram_p90(spark, sf_dir):
    """PQL3 at q = 0.9 (the edge RCA's response-time query)."""
    return mesh.latency_quantile(mesh.counters_for(spark, sf_dir), q=0.9, out="rt")


@register("pql4_error_ratio", sql=f"WITH {ERR} SELECT * FROM err")
def pql4_error_ratio(spark, sf_dir):
    """PQL4: 5xx rate / all rate, matched on (src, dst)."""
    return mesh.error_rate(mesh.counters_for(spark, sf_dir))


MEAN_LAT = (COUNTERS_CTE + ",\n" + _rate_cte("req_rate", "requests_total", "src, dst, response_code")
            + ",\n" + _rate_cte("sum_rate", "duration_sum", "src, dst") + f""",
rps AS (SELECT ts, {E}, sum(rate) AS rps FROM req_rate GROUP BY ts, {E}),
srt AS (SELECT ts, {E}, sum(rate) AS s FROM sum_rate GROUP BY ts, {E}),
ml AS (SELECT ts, {E}, s / nullif(rps, 0) AS mean_latency FROM srt JOIN rps USING (ts, {E})
       WHERE s / nullif(rps, 0) IS NOT NULL),
lavg AS (SELECT ts, {E}, avg(mean_latency) OVER (PARTITION BY {E} ORDER BY ts
           RANGE BETWEEN INTERVAL '21 hours' PRECEDING AND CURRENT ROW) AS latency_avg FROM ml)""")


@register("pql5_avg_over_time", sql=f"WITH {MEAN_LAT} SELECT * FROM lavg")
def pql5_avg_over_time(spark, sf_dir):
    """PQL5: ``avg_over_time((sum rate / count rate)[1d:3h])``."""
    from tracewise.operators import promql
    e = mesh.counters_for(spark, sf_dir)
    return promql.avg_over_time(mesh.mean_latency(e), mesh.EDGE, "mean_latency",
                                mesh.P.baseline_seconds, mesh.P.step_seconds, out="latency_avg")


@register("pql6_discover_edges", sql=f"""WITH {COUNTERS_CTE},
d AS (SELECT {E}, CASE WHEN value < lag(value) OVER w THEN value ELSE value - lag(value) OVER w END AS d
      FROM requests_total WINDOW w AS (PARTITION BY src, dst, response_code ORDER BY ts))
SELECT {E}, sum(d) AS increase FROM d WHERE d IS NOT NULL GROUP BY {E} HAVING sum(d) > 0""")
def pql6_discover_edges(spark, sf_dir):
    """PQL6 / AGG12: edges with traffic over the scanned range."""
    return mesh.discover_edges(mesh.counters_for(spark, sf_dir))


@register("pql7_cluster_rate", sql=f"WITH {REQ_RATES} SELECT ts, sum(rate) AS cluster_rps FROM req_rate GROUP BY ts")
def pql7_cluster_rate(spark, sf_dir):
    """PQL7: ``sum(rate(requests_total[R]))`` over the whole mesh, computed once."""
    return mesh.request_rates(mesh.counters_for(spark, sf_dir)).groupBy("ts").agg(F.sum("rate").alias("cluster_rps"))


@register("pql8_label_values", sql=f"WITH {EDGES_CTE} SELECT src AS workload FROM edges UNION SELECT dst FROM edges")
def pql8_label_values(spark, sf_dir):
    """PQL8 / SET1: distinct values of the source and destination labels."""
    e = edge_points(spark, sf_dir)
    return e.select(F.col("src").alias("workload")).union(e.select("dst")).distinct()


HEALTH = f"""{ERR}, {_quantile_cte(0.95, 'latency_ms')},
rps AS (SELECT ts, {E}, sum(rate) AS rps FROM req_rate GROUP BY ts, {E}),
health AS (SELECT r.ts, r.src, r.dst, r.rps, coalesce(e.error_rate, 0) AS error_rate
           FROM rps r LEFT JOIN err e USING (ts, {E}))"""


@register("pql9_mesh_health", sql=f"""WITH {HEALTH}
SELECT l.ts, l.src, l.dst, l.latency_ms, h.rps, h.error_rate
FROM lat_latency_ms l JOIN health h USING (ts, {E})""")
def pql9_mesh_health(spark, sf_dir):
    """PQL9 (+JN1, JN2): rps, error rate (left join, 0 when none), P95."""
    return mesh.service_health(mesh.counters_for(spark, sf_dir))


@register("rca9_latency_report", sql=f"""WITH {MEAN_LAT}, {_quantile_cte(0.95, 'latency_now')}
SELECT n.ts, n.src, n.dst, n.latency_now, a.latency_avg, n.latency_now > 2 * a.latency_avg AS is_anomaly
FROM lat_latency_now n JOIN lavg a USING (ts, {E})""")
def rca9_latency_report(spark, sf_dir):
    """RCA9 (+FLT4, JN1): P95 now vs 1-day mean latency, 2x flag."""
    return mesh.latency_report(mesh.counters_for(spark, sf_dir))


@register("flt4_ratio_flag", sql=f"""WITH {MEAN_LAT}, {_quantile_cte(0.95, 'latency_now')}
SELECT n.ts, n.src, n.dst, n.latency_now FROM lat_latency_now n JOIN lavg a USING (ts, {E})
WHERE n.latency_now > 2 * a.latency_avg""")
def flt4_ratio_flag(spark, sf_dir):
    """FLT4 + FLT1: keep the edges whose P95 exceeds twice the baseline mean."""
    r = mesh.latency_report(mesh.counters_for(spark, sf_dir))
    return r.filter(F.col("is_anomaly")).select("ts", "src", "dst", "latency_now")


@register("top5_busiest_destination", sql=f"""WITH {REQ_RATES},
d AS (SELECT ts, dst, sum(rate) AS rps FROM req_rate GROUP BY ts, dst)
SELECT ts, dst, rps FROM d QUALIFY row_number() OVER (PARTITION BY ts ORDER BY round(rps, 12) DESC, dst) = 1""")
def top5_busiest_destination(spark, sf_dir):
    """TOP5: ``topk(1, sum(rate) by (destination))`` at each step."""
    return mesh.busiest_destination(mesh.counters_for(spark, sf_dir))


@register("flt3_label_regex", sql=f"""WITH {COUNTERS_CTE}
SELECT * FROM requests_total WHERE regexp_full_match(response_code, '5..')""")
def flt3_label_regex(spark, sf_dir):
    """FLT3: fully anchored label matcher ``response_code=~"5.."``."""
    return requests_total(mesh.counters_for(spark, sf_dir)).filter(F.col("response_code").rlike("^5..$"))


@register("src5_range_vectors", sql=f"""WITH {RPS}
SELECT {E}, date_trunc('day', ts) AS day,
       list(CAST(round(CAST(round(rps, 8) AS DECIMAL(38,8)), 4) AS DOUBLE) ORDER BY ts) AS qps,
       count(*) AS n FROM rps GROUP BY {E}, date_trunc('day', ts)""")
def src5_range_vectors(spark, sf_dir):
    """SRC5: per-edge value vectors on the step grid, ordered by time, one
    vector per edge and day (a range query over a bounded window, so no
    vector grows with the length of the history)."""
    r = mesh.rps(mesh.counters_for(spark, sf_dir))
    g = (r.groupBy(*mesh.EDGE, F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"))
         .agg(F.array_sort(F.collect_list(F.struct("ts", "rps"))).alias("v"), F.count(F.lit(1)).alias("n")))
    return g.select(*mesh.EDGE, "day", F.transform("v", lambda x: F.round(F.round(x["rps"], 8), 4)).alias("qps"), "n")


_INSTANT_SCHEMA = T.StructType([
    T.StructField("metric", T.MapType(T.StringType(), T.StringType())),
    T.StructField("value", T.ArrayType(T.StringType())),
])
_RANGE_SCHEMA = T.StructType([
    T.StructField("metric", T.MapType(T.StringType(), T.StringType())),
    T.StructField("values", T.ArrayType(T.ArrayType(T.StringType()))),
])


def flatten_instant(js):
    """SRC3: instant-vector JSON -> labels as columns, string value -> double."""
    p = js.select(F.from_json("json", _INSTANT_SCHEMA).alias("r"))
    return p.select(F.col("r.metric").getItem("source_workload").alias("src"),
                    F.col("r.metric").getItem("destination_workload").alias("dst"),
                    to_naive(F.timestamp_seconds(F.element_at("r.value", 1).cast("double"))).alias("ts"),
                    F.element_at("r.value", 2).cast("double").alias("rps"))


def flatten_range(js):
    """SRC4: range-vector JSON -> one row per (labels, ts, value)."""
    p = js.select(F.from_json("json", _RANGE_SCHEMA).alias("r"))
    x = p.select("r.metric", F.explode("r.values").alias("pt"))
    return x.select(F.col("metric").getItem("source_workload").alias("src"),
                    F.col("metric").getItem("destination_workload").alias("dst"),
                    to_naive(F.timestamp_seconds(F.element_at("pt", 1).cast("double"))).alias("ts"),
                    F.element_at("pt", 2).cast("double").alias("rps"))


def _metric_map():
    return F.create_map(F.lit("source_workload"), F.col("src"),
                        F.lit("destination_workload"), F.col("dst"))


@register("src3_instant_vector_flatten", sql=f"""WITH {RPS}
SELECT {E}, ts, rps FROM rps""")
def src3_instant_vector_flatten(spark, sf_dir):
    """SRC3: encode the rps vector as the store's JSON result rows, then
    flatten them back (labels to columns, string value to double)."""
    r = mesh.rps(mesh.counters_for(spark, sf_dir))
    js = r.select(F.to_json(F.struct(_metric_map().alias("metric"),
                                     F.array(epoch_seconds("ts").cast("string"),
                                             F.col("rps").cast("string")).alias("value"))).alias("json"))
    return flatten_instant(js)


@register("src4_range_vector_flatten", sql=f"""WITH {RPS}
SELECT {E}, ts, rps FROM rps""")
def src4_range_vector_flatten(spark, sf_dir):
    """SRC4: range-vector JSON documents (one per edge and day, the answer
    of a bounded range query) exploded to one row per point."""
    r = mesh.rps(mesh.counters_for(spark, sf_dir))
    pts = F.array(epoch_seconds("ts").cast("string"), F.col("rps").cast("string"))
    docs = (r.groupBy("src", "dst", F.date_trunc("day", "ts")).agg(F.collect_list(pts).alias("values"))
            .select(F.to_json(F.struct(_metric_map().alias("metric"), "values")).alias("json")))
    return flatten_range(docs)
