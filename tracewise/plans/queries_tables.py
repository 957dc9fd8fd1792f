"""Registered queries: labels, pivots, sequences, splits and plot-ready
tables (FN7, AGG8, AGG11, AGG13, AGG15, WIN11, WIN12, SET3, VIZ1-3, JOB1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewise.operators import features, normalize
from tracewise.plans import edge_rca, mesh
from tracewise.plans.queries_graph import _LONG_SQL, _corr_sql, _diff_sql, corr_change, iqr_table
from tracewise.plans.queries_mesh import MEAN_LAT, REQ_RATES, _quantile_cte
from tracewise.plans.sqlbits import DAG_CTE, PHASES_CTE, SERVERS_CTE, features_sql
from tracewise.registry import register
from tracewise.sources.bindings import (KEYS, SERVICE_IDS, metric_phases, server_points, with_service_id)

SRV_METRICS = ["cpu_us", "cpu_sy", "mem_free", "io_bi"]


@register("fn7_anomaly_labels", sql=f"""WITH {_LONG_SQL}
SELECT service, metric,
       CAST(round(CAST(round(current_value, 8) AS DECIMAL(38,8)), 2) AS DOUBLE) AS current_2,
       CAST(round(CAST(round(ub, 8) AS DECIMAL(38,8)), 2) AS DOUBLE) AS ub_2,
       anomaly_type || ' (' || CAST(CAST(round(CAST(round(current_value, 8) AS DECIMAL(38,8)), 2) AS DOUBLE) AS VARCHAR) || ')' AS label
FROM iqr""")
def fn7_anomaly_labels(spark, sf_dir):
    """FN7 (+FN5): node attributes of the IQR detector: current value and
    upper bound rounded to 2 places, and the label ``High (12.3)``."""
    t = iqr_table(spark, sf_dir)
    cur2 = F.round(F.round("current_value", 8), 2)
    return t.select("service", "metric", cur2.alias("current_2"),
                    F.round(F.round("ub", 8), 2).alias("ub_2"),
                    F.concat("anomaly_type", F.lit(" ("), cur2.cast("string"), F.lit(")")).alias("label"))


@register("agg8_anomalous_steps_per_pair", sql=f"""WITH {MEAN_LAT}, {_quantile_cte(0.95, 'latency_now')}
SELECT n.src, n.dst, count(*) AS anomalous_steps
FROM lat_latency_now n JOIN lavg a USING (ts, src, dst)
WHERE n.latency_now > 2 * a.latency_avg GROUP BY n.src, n.dst""")
def agg8_anomalous_steps_per_pair(spark, sf_dir):
    """AGG8 (+FLT1): count of flagged evaluation steps per (caller, callee)."""
    r = mesh.latency_report(mesh.counters_for(spark, sf_dir))
    return r.filter("is_anomaly").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("anomalous_steps"))


@register("agg11_minmax_scale", sql=f"""WITH {SERVERS_CTE},
r AS (SELECT type, {", ".join(f"min({m}) AS {m}_min, max({m}) AS {m}_max" for m in SRV_METRICS)} FROM servers GROUP BY type)
SELECT s.server_id, s.ts, s.type,
  {", ".join(f"coalesce(({m} - {m}_min) / nullif({m}_max - {m}_min, 0), 0) AS {m}" for m in SRV_METRICS)}
FROM servers s JOIN r USING (type)""")
def agg11_minmax_scale(spark, sf_dir):
    """AGG11: per server type min-max scaling (constant column -> 0)."""
    return normalize.minmax_scale(server_points(spark, sf_dir), ["type"], SRV_METRICS)


@register("win12_fraction_split", sql=f"""WITH {SERVERS_CTE}
SELECT server_id, ts, CASE WHEN row_number() OVER (PARTITION BY server_id ORDER BY ts)
    <= floor(count(*) OVER (PARTITION BY server_id) * 0.7) THEN 'baseline' ELSE 'current' END AS phase
FROM servers""")
def win12_fraction_split(spark, sf_dir):
    """WIN12: first 70 % of each server's rows (in time) are baseline."""
    return features.split_by_fraction(server_points(spark, sf_dir), ["server_id"]).select("server_id", "ts", "phase")


_SERVER_METRICS = ["cpu_us", "cpu_sy", "mem_free", "io_bi"]


@register("win11_sequences", sql=f"""WITH {SERVERS_CTE},
q AS (SELECT server_id, ts, {", ".join(
        f"list({m}) OVER w AS {m}" for m in _SERVER_METRICS)},
        lead(ts, 10) OVER (PARTITION BY server_id ORDER BY ts) AS nxt
      FROM servers WINDOW w AS (PARTITION BY server_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING))
SELECT server_id, ts, {", ".join(_SERVER_METRICS)} FROM q WHERE nxt IS NOT NULL""")
def win11_sequences(spark, sf_dir):
    """WIN11: overlapping 10-step windows per server over all metrics, stride
    1 (last dropped); one list per metric."""
    s = features.sequences(server_points(spark, sf_dir), ["server_id"], _SERVER_METRICS)
    return s.select("server_id", "ts", *[F.transform("seq", _item(k)).alias(m)
                                         for k, m in enumerate(_SERVER_METRICS)])


def _item(k):
    return lambda step: step[k]


_SERVICES = ", ".join(f"'{s}'" for s in SERVICE_IDS)


@register("agg15_pivot_zero_fill", sql=f"""WITH {PHASES_CTE},
p AS (PIVOT (SELECT ts, server_name || '_' || ip_port AS service_id, connection_count FROM base)
      ON service_id IN ({_SERVICES}) USING first(connection_count))
SELECT ts, COALESCE(COLUMNS(* EXCLUDE (ts)), 0) FROM p""")
def agg15_pivot_zero_fill(spark, sf_dir):
    """AGG15: time x service pivot of the baseline with 0 for missing cells.
    The caller names the columns (a wide table is for a known, small set of
    services); nothing is collected to find them."""
    base, _ = metric_phases(spark, sf_dir)
    b = with_service_id(base)
    return b.groupBy("ts").pivot("service_id", SERVICE_IDS).agg(F.first("connection_count")).fillna(0.0)


@register("set3_window_union", sql=f"""WITH {MEAN_LAT},
e AS (SELECT max(ts) AS t FROM rps)
SELECT least(t - INTERVAL '8 days', t - INTERVAL '2 days') AS union_start,
       greatest(t, t) AS union_end FROM e""")
def set3_window_union(spark, sf_dir):
    """SET3: union of the baseline and current windows of the edge RCA
    (earliest start, latest end), used to scope graph discovery."""
    p = edge_rca.P
    rps = mesh.rps(mesh.counters_for(spark, sf_dir))
    end = rps.select(F.max("ts").alias("t"))
    return end.select(F.least(F.col("t") - F.expr(f"INTERVAL {p.baseline_days} DAYS"),
                              F.col("t") - F.expr(f"INTERVAL {p.current_days} DAYS")).alias("union_start"),
                      F.greatest("t", "t").alias("union_end"))


@register("viz3_corr_heatmap", sql=f"""WITH {PHASES_CTE}, {_corr_sql('base')}, {_corr_sql('prob')}, {_diff_sql('base', 'prob')}
SELECT a, b, diff FROM df""")
def viz3_corr_heatmap(spark, sf_dir):
    """VIZ3: long-form heat map of the correlation change."""
    return corr_change(spark, sf_dir).select("a", "b", "diff")


@register("viz1_scatter_points")
def viz1_scatter_points(spark, sf_dir):
    """VIZ1: scatter points of the scored window with both flags: over the
    fixed score threshold (is_anomaly) and over the contamination offset
    (is_outlier)."""
    from tracewise.plans.queries_models import scored_services
    s = with_service_id(scored_services(spark, sf_dir))
    return s.select("service_id", "ts", F.col("connection_count").alias("value"), "is_anomaly", "is_outlier")


@register("agg13_service_summary")
def agg13_service_summary(spark, sf_dir):
    """AGG13: per-service result summary: mean count, mean hour, mean score,
    and whether any scored row is over the threshold (is_anomaly) or the
    contamination offset (is_outlier)."""
    from tracewise.plans.queries_models import scored_services
    s = with_service_id(scored_services(spark, sf_dir))
    return s.groupBy("service_id").agg(F.avg("connection_count").alias("connection_count_mean"),
                                       F.avg("hour").alias("hour_mean"),
                                       F.avg("anomaly_score").alias("anomaly_score"),
                                       F.bool_or("is_anomaly").alias("is_anomaly"),
                                       F.bool_or("is_outlier").alias("is_outlier"))


@register("viz2_bar_table")
def viz2_bar_table(spark, sf_dir):
    """VIZ2: bars of anomaly rate and rank score per service."""
    from tracewise.plans.queries_models import rca3_worst_services
    return rca3_worst_services(spark, sf_dir).select("service_id", "anomaly_rate", "rank_score")


@register("job1_train")
def job1_train(spark, sf_dir):
    """JOB1: train on the baseline and persist every state table under the
    checkpoint folder; the result lists each table with its row count as read
    back."""
    from tracewise.plans import train
    root = train.train(spark, sf_dir)
    out = None
    for name in train.TABLES:
        back = train.load(spark, root, name).select(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"))
        out = back if out is None else out.unionByName(back)
    return out


_FEAT_STATS = ["connection_count", "rolling_mean", "diff", "rate_change", "over_max_count", "over_avg_count",
               "delta_max", "delta_avg", "ratio_avg", "conn_log"]


@register("job1_feature_stats", sql=f"""WITH {PHASES_CTE}, {features_sql('base', 'connection_count')}
SELECT ip_port, server_name, {", ".join(
    f"avg({c}) AS {c}_mean, CASE WHEN stddev_samp({c}) IS NOT NULL THEN greatest(stddev_samp({c}), 1e-6) END AS {c}_std"
    for c in _FEAT_STATS)} FROM feat_base GROUP BY ip_port, server_name""")
def job1_feature_stats(spark, sf_dir):
    """JOB1 (SNK5, SRC8): statistics of the raw features, as stored and loaded."""
    from tracewise.plans import train
    return train.load(spark, train.train(spark, sf_dir, ["feature_stats"]), "feature_stats")


@register("job2_predict")
def job2_predict(spark, sf_dir):
    """JOB2 (SRC8): the problem window scored with nothing but stored state;
    the same rows as ``det7_forest_score``."""
    from tracewise.plans import train
    return train.predict(spark, sf_dir, train.train(spark, sf_dir, ["feature_stats", "forest_nodes", "offset"])) \
        .drop("connection_count", "hour")


@register("job2_worst_services")
def job2_worst_services(spark, sf_dir):
    """JOB2: the ranked services of a whole cycle from one stored generation;
    the same rows as ``rca3_worst_services``."""
    from tracewise.plans import train
    return train.cycle(spark, sf_dir, train.train(spark, sf_dir))["worst"]


@register("job2_corr_change", sql=f"""WITH {PHASES_CTE}, {_corr_sql('base')}, {_corr_sql('prob')}, {_diff_sql('base', 'prob')}
SELECT * FROM df""")
def job2_corr_change(spark, sf_dir):
    """JOB2 (+COR4): the correlation change of a cycle, with the baseline's
    correlations as stored."""
    from tracewise.operators import correlate
    from tracewise.plans import train
    root = train.train(spark, sf_dir, ["corr", "corr_series"])
    at = train.newest(spark, root)
    now, series = train._corr(metric_phases(spark, sf_dir)[1])
    return correlate.corr_diff(now, train.load(spark, root, "corr", at), series, train.load(spark, root, "corr_series", at))


_FOLD = ["connection_count", "response_time", "qps", "eps"]


@register("job1_baseline_folded", sql=f"""WITH {PHASES_CTE},
l AS (SELECT ip_port, server_name, m.metric, m.v FROM base, (SELECT unnest([{", ".join(
    f"{{'metric': '{c}', 'v': {c}}}" for c in _FOLD)}]) AS m)),
s AS (SELECT ip_port, server_name, metric, count(v) AS n, avg(v) AS mean, stddev_samp(v) AS sd, var_pop(v) AS vp,
        kurtosis_pop(v) AS k, min(v) AS lo, max(v) AS hi FROM l WHERE v IS NOT NULL GROUP BY 1, 2, 3),
c AS (SELECT ip_port, server_name, metric, avg((v - mean) ** 3) AS m3 FROM l JOIN s USING (ip_port, server_name, metric) GROUP BY 1, 2, 3)
SELECT ip_port, server_name, metric, n, mean, greatest(sd, {1e-6}) AS std,
       CASE WHEN lo < hi THEN m3 / vp ** 1.5 END AS skew, CASE WHEN lo < hi THEN k END AS kurt
FROM s JOIN c USING (ip_port, server_name, metric)""")
def job1_baseline_folded(spark, sf_dir):
    """JOB1 (+AGG2-4): the baseline folded in over three spans, one of them
    twice; equals the statistics of all its points at once."""
    from tracewise.operators import baseline
    from tracewise.plans import train
    from tracewise.sources.bindings import PHASE_SPLIT
    root = train.new_root(spark)
    cuts = [None, "2024-01-08", "2024-01-15", PHASE_SPLIT]
    for a, b in [*zip(cuts, cuts[1:]), (cuts[1], cuts[2])]:
        train.fold(spark, sf_dir, root, a, b)
    state = baseline.merged(train.folded(spark, root), KEYS)
    return baseline.statistics(state, KEYS)


# ------------------------------------------------------- explicit small ops

@register("flt1_flag_filter", sql=f"""WITH {PHASES_CTE},
st AS (SELECT ip_port, server_name, {", ".join(f"avg({m}) AS m_{m}, stddev_samp({m}) AS s_{m}" for m in ["response_time", "qps", "eps"])}
       FROM base GROUP BY ip_port, server_name),
pd AS (SELECT *, {", ".join(f"coalesce({m} - lag({m}) OVER (PARTITION BY ip_port, server_name ORDER BY ts), 0) AS d_{m}" for m in ["response_time", "qps", "eps"])} FROM prob)
SELECT p.ip_port, p.server_name, p.ts FROM pd p LEFT JOIN st USING (ip_port, server_name)
WHERE {" OR ".join(f"coalesce(abs(p.{m} - st.m_{m}) > 3 * st.s_{m}, false) OR coalesce(abs(p.d_{m}) > 3 * st.s_{m}, false)" for m in ["response_time", "qps", "eps"])}""")
def flt1_flag_filter(spark, sf_dir):
    """FLT1: keep the rows whose flag is set (3-sigma == 1)."""
    from tracewise.plans import service
    f = service.sigma_flags_multi(metric_phases(spark, sf_dir))
    return f.filter(F.col("sigma3") == 1).select(*KEYS, "ts")


@register("flt6_min_rows_guard", sql=f"""WITH {PHASES_CTE}
SELECT ip_port, server_name, ts, connection_count FROM prob
WHERE (ip_port, server_name) IN (SELECT ip_port, server_name FROM prob GROUP BY 1, 2 HAVING count(*) >= 5)""")
def flt6_min_rows_guard(spark, sf_dir):
    """FLT6: the problem window of the services with at least 5 buckets in it."""
    from tracewise.operators.detect import min_rows
    _, prob = metric_phases(spark, sf_dir)
    return min_rows(prob.select(*KEYS, "ts", "connection_count"), KEYS, 5)


@register("set4_distinct_services", sql=f"""WITH {PHASES_CTE}
SELECT DISTINCT server_name || '_' || ip_port AS service_id FROM prob""")
def set4_distinct_services(spark, sf_dir):
    """SET4: distinct services seen in the problem window."""
    _, prob = metric_phases(spark, sf_dir)
    return with_service_id(prob).select("service_id").distinct()


@register("jn3_latency_error_join", sql=f"""WITH {REQ_RATES}, {_quantile_cte(0.95, 'latency_ms')},
err AS (SELECT ts, src, dst,
          sum(rate) FILTER (WHERE regexp_full_match(response_code, '5..')) / nullif(sum(rate), 0) AS error_rate
        FROM req_rate GROUP BY ts, src, dst
        HAVING count(*) FILTER (WHERE regexp_full_match(response_code, '5..')) > 0)
SELECT l.ts, l.src, l.dst, l.latency_ms, coalesce(e.error_rate, 0) AS error_rate
FROM lat_latency_ms l LEFT JOIN err e USING (ts, src, dst)""")
def jn3_latency_error_join(spark, sf_dir):
    """JN3: P95 latency left-joined with the error share on (ts, src, dst),
    missing errors -> 0 (the input of the historical forest report)."""
    from tracewise.plans.queries_models import _health_frame
    return _health_frame(spark, sf_dir).drop("_key")


@register("top6_highest_in_degree", sql=f"""WITH {DAG_CTE}
SELECT dst AS id, count(*) AS in_degree FROM dag GROUP BY dst ORDER BY in_degree DESC, id LIMIT 1""")
def top6_highest_in_degree(spark, sf_dir):
    """TOP6: the vertex with the most callers (ties by name)."""
    from tracewise.plans import graph
    from tracewise.sources.bindings import dag_edges
    d = graph.degrees(dag_edges(spark, sf_dir))
    return d.orderBy(F.col("in_degree").desc(), F.col("id")).limit(1).select("id", "in_degree")
