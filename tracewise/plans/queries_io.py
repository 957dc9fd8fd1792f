"""Registered queries: streaming jobs, sinks and sources (round trips).

Sinks write under the cluster's checkpoint folder (shared storage) and the
query returns what a reader gets back, so each entry checks the sink and
the matching source together.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from tracewise.operators import normalize
from tracewise.plans import mesh
from tracewise.registry import register
from tracewise.session import ensure_checkpoint_dir
from tracewise.sources.bindings import KEYS, event_counters, metric_phases, with_service_id
from tracewise.streaming import jobs, stateful
from tracewise.functions.columns import MIN_STD, as_utc_instant, to_naive, weekday_mon0
from tracewise.plans.queries_mesh import _rate_cte
from tracewise.plans.sqlbits import METRICS_CTE, PHASES_CTE, features_sql


def _iqr_sql():
    from tracewise.plans.queries_graph import _LONG_SQL
    return f"WITH {_LONG_SQL} SELECT *, anomaly_type IS NOT NULL AS is_anomalous FROM iqr"


_IQR_SQL = _iqr_sql()


def _path(spark, name):
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:8]}")


# ---------------------------------------------------------------- streaming

def _events(spark, sf_dir):
    """The events as a stream of four micro-batches in time order."""
    folder, width = jobs.stage_events(spark, sf_dir)
    return jobs.read_events(spark, folder, watermark=f"{width + 86400} seconds", max_files=jobs.STAGE_FILES)


@register("str1_stream_bucket_mean", sql=f"""WITH {METRICS_CTE}
SELECT ip_port, server_name, ts, connection_count, response_time, eps FROM metrics""")
def str1_stream_bucket_mean(spark, sf_dir):
    """STR1 (+STR5): streaming bucket aggregate; equals the batch AGG1."""
    ev = _events(spark, sf_dir)
    out = jobs.run_upsert_log(jobs.bucket_means(ev), ["ip_port", "server_name", "w"], "str1")
    return out.select("ip_port", "server_name", to_naive("w.start").alias("ts"),
                      "connection_count", "response_time", "eps")


@register("str2_stream_scoring", sql=f"""WITH {PHASES_CTE},
st AS (SELECT ip_port, server_name, avg(connection_count) AS m,
         CASE WHEN stddev_samp(connection_count) IS NOT NULL THEN greatest(stddev_samp(connection_count), {MIN_STD}) END AS s
       FROM base GROUP BY ip_port, server_name)
SELECT ip_port, server_name, ts, connection_count, coalesce(abs(connection_count - m) > 3 * s, false) AS is_anomaly
FROM metrics LEFT JOIN st USING (ip_port, server_name)""")
def str2_stream_scoring(spark, sf_dir):
    """STR2 + STR6 + SNK2: micro-batch 3-sigma scoring against static stats."""
    base, _ = metric_phases(spark, sf_dir)
    stats = normalize.baseline_stats(base, KEYS, ["connection_count"])
    ev = _events(spark, sf_dir)
    return jobs.score_stream(ev, stats, "str2")


@register("str3_stateful_features", sql=f"WITH {METRICS_CTE}, {features_sql('metrics', 'connection_count')} "
                                        "SELECT * FROM feat_metrics")
def str3_stateful_features(spark, sf_dir):
    """STR3: the eight trailing features of the bucket points, from keyed
    state across five micro-batches with late and repeated events; equals the
    batch DET2 over the whole table."""
    folder, width = jobs.stage_events(spark, sf_dir, parts=4, late=True)
    delay, idle = width + 86400, 10 * 6 * 3600
    jobs.close_stage(folder, spark.read.parquet(folder), delay + 2 * idle)
    ev = jobs.read_events(spark, folder, watermark=f"{delay} seconds", max_files=jobs.STAGE_FILES)
    out = jobs.run_appended(stateful.trailing_features(
        jobs.service_points(ev), KEYS, "connection_count", f"{idle} seconds"), "str3")
    # a point carries the last microsecond of its bucket
    start = F.col("ts") + F.expr("INTERVAL 1 MICROSECOND") - F.expr("INTERVAL 6 HOURS")
    return out.withColumn("ts", to_naive(start)).withColumn("hour", F.hour("ts")) \
        .withColumn("day_of_week", weekday_mon0("ts"))


@register("str4_sliding_windows", sql="""
SELECT time_bucket(INTERVAL '3 hours', ts) + to_hours(CAST(3 * (k + 1) AS BIGINT)) AS ts, event_type,
       count(*) AS n
FROM events, range(0, 2) AS r(k) GROUP BY 1, 2""")
def str4_sliding_windows(spark, sf_dir):
    """STR4: 6 h windows sliding by 3 h over the event stream."""
    ev = _events(spark, sf_dir)
    out = jobs.run_upsert_log(jobs.sliding_counts(ev), ["w", "event_type"], "str4")
    return out.select(to_naive("w.end").alias("ts"), "event_type", "n")


@register("str4_sliding_rates", sql="""WITH counts AS (
  SELECT event_type, time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS ts, count(*) AS n FROM events GROUP BY 1, 2),
counter AS (
  SELECT event_type, ts, sum(n) OVER (PARTITION BY event_type, floor(epoch(ts) / 345600) ORDER BY ts
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM counts),
""" + _rate_cte("r", "counter", "event_type") + """
SELECT event_type, ts, CAST(increase AS DOUBLE) AS increase, rate FROM r""")
def str4_sliding_rates(spark, sf_dir):
    """STR4 (+PQL1 on a stream): rate of the request counters (which restart
    every four days) over 6 h every 3 h, from samples that come in five
    micro-batches, late and repeated; equals the batch rate."""
    samples = event_counters(spark, sf_dir).withColumn("at", F.unix_micros(as_utc_instant("ts")))
    folder, width = jobs.stage_rows(samples, "samples", 4, late_by="at")
    delay = width + 86400
    staged = spark.read.parquet(folder)
    jobs.close_stage(folder, staged, delay + 86400)
    s = jobs.read_samples(spark, folder, "event_type string, ts timestamp_ntz, value double, at bigint", ["event_type"], f"{delay} seconds")
    out = jobs.run_appended(stateful.sliding_rates(s, ["event_type"], "6 hours", "3 hours"), "str4-rates")
    return out.withColumn("ts", to_naive("ts"))


# ---------------------------------------------------------------- sinks

@register("snk1_csv_roundtrip", sql=_IQR_SQL)
def snk1_csv_roundtrip(spark, sf_dir):
    """SNK1/SNK3 + SRC6: ranked table to CSV with header, read back."""
    from tracewise.plans.queries_graph import iqr_table
    path = _path(spark, "iqr-csv")
    t = iqr_table(spark, sf_dir)
    t.write.mode("overwrite").option("header", True).csv(path)
    return spark.read.schema(t.schema).option("header", True).csv(path)


@register("snk1_worst_services_csv")
def snk1_worst_services_csv(spark, sf_dir):
    """SNK1: the ranked worst-services table with its chains, to CSV and back."""
    from tracewise.plans.queries_models import rca3_worst_services
    path = _path(spark, "worst-csv")
    t = rca3_worst_services(spark, sf_dir)
    t.write.mode("overwrite").option("header", True).csv(path)
    return spark.read.schema(t.schema).option("header", True).csv(path)


@register("snk4_stats_json", sql=f"""WITH {PHASES_CTE}
SELECT ip_port, server_name, {", ".join(
    f"avg({c}) AS {c}_mean, CASE WHEN stddev_samp({c}) IS NOT NULL THEN greatest(stddev_samp({c}), {MIN_STD}) END AS {c}_std"
    for c in ["connection_count", "response_time", "eps"])} FROM base GROUP BY ip_port, server_name""")
def snk4_stats_json(spark, sf_dir):
    """SNK4 + SRC7: baseline statistics to JSON lines and back."""
    base, _ = metric_phases(spark, sf_dir)
    stats = normalize.baseline_stats(base, KEYS, ["connection_count", "response_time", "eps"])
    path = _path(spark, "stats-json")
    stats.write.mode("overwrite").json(path)
    return spark.read.schema(stats.schema).json(path)


@register("snk5_model_state")
def snk5_model_state(spark, sf_dir):
    """SNK5 + SRC8: persist the forest node table and the stats (Parquet),
    load them back (JOB1 train state)."""
    from tracewise.plans.queries_models import det6_forest_fit
    path = _path(spark, "forest")
    det6_forest_fit(spark, sf_dir).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _graph_sql():
    from tracewise.plans.queries_mesh import MEAN_LAT, _quantile_cte
    return f"""WITH {MEAN_LAT}, {_quantile_cte(0.95, 'latency_now')},
rep AS (SELECT n.ts, n.src, n.dst, n.latency_now AS latency, n.latency_now > 2 * a.latency_avg AS anomaly
        FROM lat_latency_now n JOIN lavg a USING (ts, src, dst)),
g AS (SELECT src, dst, latency, anomaly FROM rep WHERE ts = (SELECT max(ts) FROM rep))"""


def _graph(spark, sf_dir):
    r = mesh.latency_report(mesh.counters_for(spark, sf_dir))
    end = r.select(F.max("ts")).scalar()
    return r.filter(F.col("ts") == end).select("src", "dst", F.col("latency_now").alias("latency"),
                                                F.col("is_anomaly").alias("anomaly"))


@register("snk6_node_link_json", sql=_graph_sql() + """
SELECT src AS source, dst AS target, latency, anomaly FROM g""")
def snk6_node_link_json(spark, sf_dir):
    """SNK6: node-link graph export as two JSON-lines tables (nodes, links);
    returns the links as read back."""
    g = _graph(spark, sf_dir)
    base = _path(spark, "graph")
    nodes = g.select(F.col("src").alias("id")).union(g.select("dst")).distinct()
    nodes.write.mode("overwrite").json(base + "/nodes")
    (g.select(F.col("src").alias("source"), F.col("dst").alias("target"), "latency", "anomaly")
     .write.mode("overwrite").json(base + "/links"))
    return spark.read.schema("source string, target string, latency double, anomaly boolean").json(base + "/links")


@register("snk7_cytoscape_json", sql=_graph_sql() + """
SELECT id, NULL::VARCHAR AS source, NULL::VARCHAR AS target, NULL::DOUBLE AS latency, NULL::BOOLEAN AS anomaly
FROM (SELECT src AS id FROM g UNION SELECT dst FROM g)
UNION ALL
SELECT src || '->' || dst, src, dst, latency, anomaly FROM g""")
def snk7_cytoscape_json(spark, sf_dir):
    """SNK7: Cytoscape elements (``{"data": {...}}``) as JSON lines."""
    g = _graph(spark, sf_dir)
    path = _path(spark, "cyto")
    nodes = (g.select(F.col("src").alias("id")).union(g.select("dst")).distinct()
             .select(F.struct(F.col("id"), F.lit(None).cast("string").alias("source"),
                              F.lit(None).cast("string").alias("target"),
                              F.lit(None).cast("double").alias("latency"),
                              F.lit(None).cast("boolean").alias("anomaly")).alias("data")))
    links = g.select(F.struct(F.concat_ws("->", "src", "dst").alias("id"), F.col("src").alias("source"),
                              F.col("dst").alias("target"), "latency", "anomaly").alias("data"))
    nodes.unionByName(links).write.mode("overwrite").json(path)
    return spark.read.schema(
        "data struct<id string, source string, target string, latency double, anomaly boolean>").json(path) \
        .select("data.*")


@register("job3_results_readback", sql=f"""WITH {PHASES_CTE},
st AS (SELECT ip_port, server_name, {", ".join(f"avg({m}) AS m_{m}, stddev_samp({m}) AS s_{m}" for m in ["response_time", "qps", "eps"])}
       FROM base GROUP BY ip_port, server_name),
pd AS (SELECT *, {", ".join(f"coalesce({m} - lag({m}) OVER (PARTITION BY ip_port, server_name ORDER BY ts), 0) AS d_{m}" for m in ["response_time", "qps", "eps"])} FROM prob),
fl AS (SELECT server_name || '_' || ip_port AS service_id, p.ts,
         greatest({", ".join(f"CAST(coalesce(abs(p.{m} - st.m_{m}) > 3 * st.s_{m}, false) OR coalesce(abs(p.d_{m}) > 3 * st.s_{m}, false) AS INTEGER)" for m in ["response_time", "qps", "eps"])}) AS sigma3
       FROM pd p LEFT JOIN st USING (ip_port, server_name))
SELECT * FROM fl ORDER BY ts DESC, service_id LIMIT 100""")
def job3_results_readback(spark, sf_dir):
    """JOB3 / TOP8: append scored rows per cycle, read back the newest 100."""
    from tracewise.plans import service
    path = _path(spark, "results")
    f = with_service_id(service.sigma_flags_multi(metric_phases(spark, sf_dir)))
    # appended per scoring cycle, partitioned by day so time-bounded reads prune files
    (f.select("service_id", "ts", "sigma3", F.to_date("ts").alias("day"))
     .write.mode("append").partitionBy("day").parquet(path))
    return (spark.read.parquet(path).select("service_id", "ts", "sigma3")
            .orderBy(F.col("ts").desc(), "service_id").limit(100))
