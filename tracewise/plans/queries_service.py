"""Registered queries: sources, service metrics, features, stats, flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewise.functions.columns import MIN_STD
from tracewise.operators import detect, features, normalize
from tracewise.operators.ranks import exact_quantile
from tracewise.plans import service
from tracewise.plans.sqlbits import METRICS_CTE, PHASES_CTE, features_sql
from tracewise.registry import register
from tracewise.sources.bindings import (KEYS, METRICS, metric_phases, metric_points, table, with_service_id)

K = "ip_port, server_name"


# ------------------------------------------------------------------ sources

@register("agg1_bucket_mean", sql=f"WITH {METRICS_CTE} SELECT * FROM metrics")
def agg1_bucket_mean(spark, sf_dir):
    """AGG1: mean (and count) per service and time bucket."""
    return metric_points(spark, sf_dir)


@register("src1_lookback_scan", sql=f"""
WITH ev AS (SELECT * FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL '7 days')
SELECT '10.0.0.' || CAST(user_id % 2 AS VARCHAR) || ':8080' AS ip_port,
       'svc_' || CAST(user_id % 5 AS VARCHAR) AS server_name,
       time_bucket(INTERVAL '6 hours', ts) AS ts,
       avg(value) AS connection_count
FROM ev GROUP BY 1, 2, 3""")
def src1_lookback_scan(spark, sf_dir):
    """SRC1: scan of the last 7 days before the newest point ("now"), mean per
    service and bucket.  "now" is a scalar subquery, evaluated once."""
    ev = table(spark, sf_dir, "events")
    now = ev.select(F.max("ts")).scalar()
    recent = ev.filter(F.col("ts") >= now - F.expr("INTERVAL 7 DAYS"))
    return (recent.groupBy(
        F.concat(F.lit("10.0.0."), (F.col("user_id") % 2).cast("string"), F.lit(":8080")).alias("ip_port"),
        F.concat(F.lit("svc_"), (F.col("user_id") % 5).cast("string")).alias("server_name"),
        F.window("ts", "6 hours").start.alias("ts"))
        .agg(F.avg("value").alias("connection_count")))


@register("src2_time_range", sql=f"""
WITH {METRICS_CTE}
SELECT * FROM metrics
WHERE ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-22 00:00:00'""")
def src2_time_range(spark, sf_dir):
    """SRC2: absolute [start, end) range on the raw timestamps (pushed into
    the parquet scan); the bounds are bucket-aligned, so whole buckets result."""
    return metric_points(spark, sf_dir, start="2024-01-08 00:00:00", end="2024-01-22 00:00:00")


@register("prj2_service_id", sql=f"""
WITH {METRICS_CTE}
SELECT server_name || '_' || ip_port AS service_id, ts, connection_count FROM metrics""")
def prj2_service_id(spark, sf_dir):
    """PRJ2: composite key to one ``service_id`` column."""
    return with_service_id(metric_points(spark, sf_dir)).select("service_id", "ts", "connection_count")


# ------------------------------------------------------------------ stats

@register("agg2_baseline_stats", sql=f"""
WITH {PHASES_CTE}
SELECT {K}, avg(connection_count) AS connection_count_mean,
       CASE WHEN stddev_samp(connection_count) IS NOT NULL
            THEN greatest(stddev_samp(connection_count), {MIN_STD}) END AS connection_count_std
FROM base GROUP BY {K}""")
def agg2_baseline_stats(spark, sf_dir):
    base, _ = metric_phases(spark, sf_dir)
    return normalize.baseline_stats(base, KEYS, ["connection_count"])


_AGG3_COLS = ["response_time", "qps", "eps"]


@register("agg3_multi_stats", sql=f"""
WITH {PHASES_CTE}
SELECT {K}, {", ".join(f"avg({c}) AS {c}_mean, stddev_samp({c}) AS {c}_std" for c in _AGG3_COLS)}
FROM base GROUP BY {K}""")
def agg3_multi_stats(spark, sf_dir):
    """AGG3: many features in one pass (unfloored, multi-metric form)."""
    base, _ = metric_phases(spark, sf_dir)
    return normalize.baseline_stats(base, KEYS, _AGG3_COLS, floor=None)


def _moment_sql(c):
    m = f"avg({c})"
    return (f"avg({c}) AS {c}_mean, stddev_samp({c}) AS {c}_std, "
            f"(avg(power({c},3)) - 3*{m}*avg(power({c},2)) + 2*power({m},3)) "
            f"/ nullif(power(var_pop({c}), 1.5), 0) AS {c}_skew, "
            f"kurtosis_pop({c}) AS {c}_kurt")


@register("agg4_moments", sql=f"""
WITH {PHASES_CTE}
SELECT {K}, {", ".join(_moment_sql(c) for c in METRICS)} FROM prob GROUP BY {K}""")
def agg4_moments(spark, sf_dir):
    """AGG4 / JOB3 stats: mean, std, skew, kurtosis per service (problem window)."""
    _, prob = metric_phases(spark, sf_dir)
    return normalize.moments(prob, KEYS, METRICS)


@register("agg6_system_total", sql=f"""
WITH {PHASES_CTE} SELECT ts, sum(connection_count) AS total FROM prob GROUP BY ts""")
def agg6_system_total(spark, sf_dir):
    """AGG6: system total per timestamp."""
    _, prob = metric_phases(spark, sf_dir)
    return prob.groupBy("ts").agg(F.sum("connection_count").alias("total"))


@register("agg10_quartiles", sql=f"""
WITH {METRICS_CTE}
SELECT {K}, quantile_cont(response_time, 0.25) AS q1, quantile_cont(response_time, 0.75) AS q3
FROM metrics GROUP BY {K}""")
def agg10_quartiles(spark, sf_dir):
    return detect.quartiles(metric_points(spark, sf_dir), KEYS, "response_time")


# ------------------------------------------------------------------ z-scores

@register("det1_zscore", sql=f"""
WITH {PHASES_CTE},
st AS (SELECT {K}, avg(connection_count) AS m,
              CASE WHEN stddev_samp(connection_count) IS NOT NULL
                   THEN greatest(stddev_samp(connection_count), {MIN_STD}) END AS s
       FROM base GROUP BY {K})
SELECT p.ip_port, p.server_name, p.ts, p.connection_count,
       coalesce((p.connection_count - st.m) / nullif(st.s, 0), 0) AS conn_zscore,
       ln(1 + p.connection_count) AS conn_log,
       st.m IS NULL AS is_new_key
FROM prob p LEFT JOIN st USING ({K})""")
def det1_zscore(spark, sf_dir):
    """DET1: predict-mode z-score with baseline stats; null -> 0; log1p."""
    base, prob = metric_phases(spark, sf_dir)
    stats = normalize.baseline_stats(base, KEYS, ["connection_count"])
    z = normalize.zscore(prob.select(*KEYS, "ts", "connection_count"), stats, KEYS,
                         ["connection_count"], prefix="z_")
    return (z.withColumnRenamed("z_connection_count", "conn_zscore")
            .withColumn("conn_log", F.log1p("connection_count"))
            .select(*KEYS, "ts", "connection_count", "conn_zscore", "conn_log", "is_new_key"))


_FEATS = ["connection_count", "rolling_mean", "diff", "rate_change", "over_max_count",
          "over_avg_count", "delta_max", "delta_avg", "ratio_avg", "conn_log"]


def _zfeat_sql():
    zs = ", ".join(
        f"avg({f}) AS m_{f}, CASE WHEN stddev_samp({f}) IS NOT NULL THEN greatest(stddev_samp({f}), {MIN_STD}) END AS s_{f}"
        for f in _FEATS)
    zcols = ", ".join(f"coalesce((p.{f} - st.m_{f}) / nullif(st.s_{f}, 0), 0) AS z_{f}" for f in _FEATS)
    return f"""
WITH {PHASES_CTE}, {features_sql('base', 'connection_count')}, {features_sql('prob', 'connection_count')},
st AS (SELECT {K}, {zs} FROM feat_base GROUP BY {K})
SELECT p.ip_port, p.server_name, p.ts, {zcols}, p.hour, p.day_of_week
FROM feat_prob p LEFT JOIN st USING ({K})"""


@register("det3_feature_zscores", sql=_zfeat_sql())
def det3_feature_zscores(spark, sf_dir):
    """DET3: every engineered feature z-normalised with baseline stats."""
    _, zp, feats = service.scored_features(metric_phases(spark, sf_dir))
    return zp.select(*KEYS, "ts", *[f"z_{f}" for f in feats], "hour", "day_of_week")


# ------------------------------------------------------------------ features

_ALL_FEATS = ["rolling_mean", "diff", "rate_change", "over_max_count", "over_avg_count",
              "delta_max", "delta_avg", "ratio_avg"]


def _feat_query(cols):
    def q(spark, sf_dir):
        f = features.add_features(metric_points(spark, sf_dir), KEYS, ["connection_count"],
                                  naming="plain", log1p=True)
        return f.select(*KEYS, "ts", *cols)
    return q


def _feat_sql(cols):
    return f"""WITH {METRICS_CTE}, {features_sql('metrics', 'connection_count')}
SELECT {K}, ts, {", ".join(cols)} FROM feat_metrics"""


for _name, _cols in {
    "win1_rolling_mean": ["rolling_mean"],
    "win2_diff": ["diff"],
    "win3_rate_change": ["rate_change"],
    "win5_over_max_count": ["over_max_count"],
    "win6_over_avg_count": ["over_avg_count"],
    "win7_delta_max": ["delta_max"],
    "win8_delta_avg": ["delta_avg"],
    "win9_ratio_avg": ["ratio_avg"],
    "fn2_hour_weekday": ["hour", "day_of_week"],
    "fn1_log1p": ["conn_log"],
    "det2_features": ["connection_count"] + _ALL_FEATS + ["conn_log", "hour", "day_of_week"],
}.items():
    register(_name, sql=_feat_sql(_cols))(_feat_query(_cols))


@register("win4_rolling_max_mean", sql=f"""WITH {METRICS_CTE}
SELECT {K}, ts, CASE WHEN count(connection_count) OVER w = 10 THEN max(connection_count) OVER w END AS rolling_max,
       CASE WHEN count(connection_count) OVER w = 10 THEN avg(connection_count) OVER w END AS rolling_mean
FROM metrics WINDOW w AS (PARTITION BY {K} ORDER BY ts ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""")
def win4_rolling_max_mean(spark, sf_dir):
    """WIN4: trailing max and mean over 10 buckets per service."""
    return features.rolling(metric_points(spark, sf_dir), KEYS, "connection_count")


@register("det1_zscore_train", sql=f"""WITH {PHASES_CTE},
st AS (SELECT {K}, avg(response_time) AS m, greatest(stddev_samp(response_time), 1e-6) AS s FROM base GROUP BY {K})
SELECT {K}, ts, coalesce((response_time - m) / s, 0) AS z_response_time FROM base JOIN st USING ({K})""")
def det1_zscore_train(spark, sf_dir):
    """DET1, train mode: the baseline scored with its own statistics."""
    base, _ = metric_phases(spark, sf_dir)
    z, _ = normalize.fit_zscore(base, KEYS, ["response_time"])
    return z.select(*KEYS, "ts", "z_response_time")


@register("win10_row_ordinal", sql=f"""
WITH {METRICS_CTE}
SELECT {K}, ts, CAST(row_number() OVER (PARTITION BY {K} ORDER BY ts) - 1 AS INTEGER) AS ordinal FROM metrics""")
def win10_row_ordinal(spark, sf_dir):
    from pyspark.sql import Window
    wk = Window.partitionBy(*KEYS).orderBy("ts")
    return metric_points(spark, sf_dir).select(*KEYS, "ts", (F.row_number().over(wk) - 1).alias("ordinal"))


def _multi_feat_sql():
    parts = [METRICS_CTE]
    for m in METRICS:
        parts.append(features_sql("metrics", m, plain=False).replace("_metrics", f"_{m}"))
    sel = ", ".join(f"{m}.{m}_{f}" for m in METRICS for f in _ALL_FEATS)
    return (f"WITH {', '.join(parts)} SELECT response_time.ip_port, response_time.server_name, "
            f"response_time.ts, {sel} FROM feat_response_time response_time "
            f"JOIN feat_qps qps USING ({K}, ts) JOIN feat_eps eps USING ({K}, ts)")


@register("det2_multi_metric_features", sql=_multi_feat_sql())
def det2_multi_metric_features(spark, sf_dir):
    """DET2 multi-metric form: ``<metric>_<feature>`` for all three metrics in
    one window pass."""
    f = features.add_features(metric_points(spark, sf_dir), KEYS, METRICS, calendar=False)
    return f.select(*KEYS, "ts", *[f"{m}_{x}" for m in METRICS for x in _ALL_FEATS])


# ------------------------------------------------------------------ flags

def _sigma_multi_sql():
    st = ", ".join(f"avg({m}) AS m_{m}, stddev_samp({m}) AS s_{m}" for m in METRICS)
    diffs = ", ".join(f"coalesce({m} - lag({m}) OVER (PARTITION BY {K} ORDER BY ts), 0) AS d_{m}"
                      for m in METRICS)
    flags = ", ".join(
        f"CAST(coalesce(abs(p.{m} - st.m_{m}) > 3 * st.s_{m}, false) OR coalesce(abs(p.d_{m}) > 3 * st.s_{m}, false) AS INTEGER) AS sigma3_{m}"
        for m in METRICS)
    return f"""WITH {PHASES_CTE},
st AS (SELECT {K}, {st} FROM base GROUP BY {K}),
pd AS (SELECT *, {diffs} FROM prob),
fl AS (SELECT p.ip_port, p.server_name, p.ts, {flags} FROM pd p LEFT JOIN st USING ({K}))"""


@register("det4_sigma3_multi", sql=_sigma_multi_sql() + """
SELECT *, greatest(sigma3_response_time, sigma3_qps, sigma3_eps) AS sigma3 FROM fl""")
def det4_sigma3_multi(spark, sf_dir):
    """DET4 multi-metric: level or jump beyond 3 baseline std; row flag = max."""
    f = service.sigma_flags_multi(metric_phases(spark, sf_dir))
    return f.select(*KEYS, "ts", *[f"sigma3_{m}" for m in METRICS], "sigma3")


@register("det4_sigma3_diff", sql=f"""WITH {PHASES_CTE},
st AS (SELECT {K}, avg(connection_count) AS m,
         CASE WHEN stddev_samp(connection_count) IS NOT NULL THEN greatest(stddev_samp(connection_count), {MIN_STD}) END AS s
       FROM base GROUP BY {K}),
pd AS (SELECT *, coalesce(connection_count - lag(connection_count) OVER (PARTITION BY {K} ORDER BY ts), 0) AS d FROM prob),
ds AS (SELECT {K}, CASE WHEN stddev_samp(d) IS NOT NULL THEN greatest(stddev_samp(d), {MIN_STD}) END AS sd FROM pd GROUP BY {K})
SELECT p.ip_port, p.server_name, p.ts,
  CAST(coalesce(abs(p.connection_count - st.m) > 3 * st.s, false) OR coalesce(abs(p.d) > 3 * ds.sd, false) AS INTEGER) AS sigma3
FROM pd p LEFT JOIN st USING ({K}) LEFT JOIN ds USING ({K})""")
def det4_sigma3_diff(spark, sf_dir):
    """DET4 single-metric: jump measured against the scored window's own std of
    differences."""
    f = service.sigma_flags_single(metric_phases(spark, sf_dir))
    return f.select(*KEYS, "ts", "sigma3")


@register("agg5_flag_rates", sql=_sigma_multi_sql() + """
SELECT server_name || '_' || ip_port AS service_id, avg(CAST(sigma3_response_time AS DOUBLE)) AS rt_sigma_rate,
       avg(CAST(greatest(sigma3_response_time, sigma3_qps, sigma3_eps) AS DOUBLE)) AS sigma_rate
FROM fl GROUP BY 1""")
def agg5_flag_rates(spark, sf_dir):
    """AGG5: mean of flags per service."""
    f = with_service_id(service.sigma_flags_multi(metric_phases(spark, sf_dir)))
    return detect.flag_rates(f, "service_id", {"sigma3_response_time": "rt_sigma_rate", "sigma3": "sigma_rate"})


TOP2_SQL = _sigma_multi_sql() + """,
rates AS (SELECT server_name || '_' || ip_port AS service_id,
                 avg(CAST(greatest(sigma3_response_time, sigma3_qps, sigma3_eps) AS DOUBLE)) AS sigma_rate
          FROM fl GROUP BY 1)
SELECT * FROM rates ORDER BY sigma_rate DESC NULLS LAST, service_id LIMIT 5"""


@register("top2_worst_services", sql=TOP2_SQL)
def top2_worst_services(spark, sf_dir):
    """Minimum slice: metrics -> baseline stats -> z/3-sigma -> rates -> top 5."""
    return service.worst_services_by_sigma(metric_phases(spark, sf_dir), k=5)


@register("fn5_round_abs_max", sql=f"""WITH {PHASES_CTE}
SELECT {K}, ts, CAST(round(CAST(round(abs(response_time - qps), 8) AS DECIMAL(38,8)), 2) AS DOUBLE) AS gap, greatest(response_time, qps, eps) AS top,
       CAST(eps > 0 AS INTEGER) AS has_errors FROM prob""")
def fn5_round_abs_max(spark, sf_dir):
    """FN5: abs, max across columns, bool to int, round(2)."""
    _, prob = metric_phases(spark, sf_dir)
    return prob.select(*KEYS, "ts", F.round(F.round(F.abs(F.col("response_time") - F.col("qps")), 8), 2).alias("gap"),
                       F.greatest("response_time", "qps", "eps").alias("top"),
                       (F.col("eps") > 0).cast("int").alias("has_errors"))


@register("flt5_nan_zscore_services", sql=f"""WITH {PHASES_CTE},
st AS (SELECT {K}, stddev_samp(eps) AS s FROM base GROUP BY {K})
SELECT DISTINCT server_name || '_' || ip_port AS service_id
FROM prob LEFT JOIN st USING ({K}) WHERE st.s IS NULL OR st.s = 0""")
def flt5_nan_zscore_services(spark, sf_dir):
    """FLT5: services whose z-score is undefined (missing or zero baseline std)."""
    base, prob = metric_phases(spark, sf_dir)
    stats = normalize.baseline_stats(base, KEYS, ["eps"], floor=None)
    z = normalize.zscore(prob, stats, KEYS, ["eps"], fill=None)
    return with_service_id(z.filter(F.col("z_eps").isNull())).select("service_id").distinct()


@register("fn4_median_impute", sql=f"""WITH {METRICS_CTE},
grid AS (SELECT s.ip_port, s.server_name, unnest(generate_series(
             (SELECT min(ts) FROM metrics), (SELECT max(ts) FROM metrics), INTERVAL '6 hours')) AS ts
         FROM (SELECT DISTINCT {K} FROM metrics) s),
dense AS (SELECT g.ip_port, g.server_name, g.ts, m.connection_count FROM grid g LEFT JOIN metrics m USING ({K}, ts)),
med AS (SELECT quantile_cont(connection_count, 0.5) AS md FROM metrics)
SELECT {K}, ts, coalesce(connection_count, md) AS connection_count FROM dense, med""")
def fn4_median_impute(spark, sf_dir):
    """FN4: densify each service onto the regular bucket grid between the
    first and last bucket, and fill missing counts with the exact median.
    The grid is generated per service with ``sequence`` (no cross join); the
    bounds are one-row scalar subqueries, the median a distributed rank."""
    pts = metric_points(spark, sf_dir)
    lo = pts.select(F.min("ts")).scalar()
    hi = pts.select(F.max("ts")).scalar()
    grid = (pts.select(*KEYS).distinct()
            .select(*KEYS, F.explode(F.sequence(lo, hi, F.expr("INTERVAL 6 HOURS"))).alias("ts")))
    dense = grid.join(pts.select(*KEYS, "ts", "connection_count"), on=[*KEYS, "ts"], how="left")
    med = F.lit(exact_quantile(pts, "connection_count", 0.5))
    return dense.select(*KEYS, "ts", F.coalesce("connection_count", med).alias("connection_count"))


@register("win5_over_counts_all_scope", sql=f"""WITH {METRICS_CTE}, {features_sql('metrics', 'connection_count')},
blk AS (SELECT floor(_ord / 10) AS b, sum(_gmax) AS tmax, sum(_gavg) AS tavg FROM f2_metrics GROUP BY 1)
SELECT f.ip_port, f.server_name, f.ts, CAST(coalesce(blk.tmax, 0) AS DOUBLE) AS over_max_count,
       CAST(coalesce(blk.tavg, 0) AS DOUBLE) AS over_avg_count
FROM f2_metrics f JOIN blk ON blk.b = floor(f._ord / 10)""")
def win5_over_counts_all_scope(spark, sf_dir):
    """WIN5/WIN6 with the reference's block scope: each block number summed
    over all services (``block_scope="all"``)."""
    f = features.add_features(metric_points(spark, sf_dir), KEYS, ["connection_count"],
                              naming="plain", block_scope="all")
    return f.select(*KEYS, "ts", "over_max_count", "over_avg_count")
