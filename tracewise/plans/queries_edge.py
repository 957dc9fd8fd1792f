"""Registered queries: edge features, typed anomalies, entry, chains."""

from __future__ import annotations

from tracewise.plans import edge_rca, mesh
from tracewise.plans.queries_mesh import ERR, _quantile_cte
from tracewise.registry import register
from tracewise.sources.bindings import PLANT_HOURS, PLANT_K, PLANTED, planted_edge_points

E = "src, dst"

SERIES = f"""{ERR}, {_quantile_cte(0.9, 'rt')},
rps AS (SELECT ts, {E}, sum(rate) AS rps FROM req_rate GROUP BY ts, {E}),
ser AS (SELECT r.ts, r.src, r.dst, l.rt, coalesce(e.error_rate, 0) AS error, r.rps AS qps,
               e.error_rate IS NOT NULL AS has_error
        FROM rps r JOIN lat_rt l USING (ts, {E}) LEFT JOIN err e USING (ts, {E})),
w AS (SELECT *, ts > (SELECT max(ts) FROM ser) - INTERVAL '8 days' AS in_base,
                ts > (SELECT max(ts) FROM ser) - INTERVAL '2 days' AS in_cur FROM ser)"""

PERF = SERIES + f""",
pbase AS (SELECT {E}, avg(rt) AS b_mean, max(rt) AS b_max FROM w WHERE in_base GROUP BY {E}),
perf AS (SELECT {E}, CAST(count(*) FILTER (WHERE rt > b_max) AS DOUBLE) AS over_max_count,
           max(rt) - any_value(b_max) AS max_delta,
           CAST(count(*) FILTER (WHERE rt > b_mean) AS DOUBLE) AS over_avg_count,
           coalesce(avg(rt) / nullif(any_value(b_mean), 0), 0) AS avg_ratio
         FROM w JOIN pbase USING ({E}) WHERE in_cur GROUP BY {E})"""

TRAF = PERF + f""",
tbase AS (SELECT {E}, avg(qps) AS b_mean, stddev_pop(qps) AS b_std FROM w WHERE in_base GROUP BY {E}),
cl AS (SELECT ts, sum(qps) AS cluster FROM w WHERE in_cur GROUP BY ts),
tg AS (SELECT {E}, avg(qps) - any_value(b_mean) AS mean_delta, stddev_pop(qps) - any_value(b_std) AS std_delta,
         CAST(count(*) FILTER (WHERE abs(qps - b_mean) > 3 * b_std) AS DOUBLE) AS outlier_count,
         count(*) FILTER (WHERE abs(qps - b_mean) > 4 * b_std) AS strict_n, count(*) AS n,
         covar_pop(qps, cluster) / nullif(stddev_pop(qps) * stddev_pop(cluster), 0) AS r
       FROM w JOIN tbase USING ({E}) JOIN cl USING (ts) WHERE in_cur GROUP BY {E}),
traf AS (SELECT {E}, mean_delta, std_delta, outlier_count,
           CASE WHEN n = (SELECT count(*) FROM cl) AND n > 1 THEN coalesce(r, 0) ELSE 0 END AS corr_cluster, strict_n
         FROM tg),
relw AS (SELECT *, CAST(floor((epoch((SELECT max(ts) FROM w)) - epoch(ts)) / 172800) AS INTEGER) AS part
         FROM w WHERE in_base OR in_cur),
relm AS (SELECT {E}, part, max(error) AS max_error FROM relw GROUP BY ALL HAVING count(*) FILTER (WHERE has_error) > 0),
reld AS (SELECT {E}, part, error - lag(error) OVER (PARTITION BY {E}, part ORDER BY ts) AS d FROM relw),
rels AS (SELECT {E}, part, avg(d) AS m, stddev_pop(d) AS s FROM reld WHERE d IS NOT NULL GROUP BY ALL),
relo AS (SELECT {E}, part, avg(d) AS o FROM reld JOIN rels USING ({E}, part) WHERE abs(d - m) > 3 * s GROUP BY ALL),
relf AS (SELECT relm.*, coalesce(o, 0) AS current_outlier FROM relm LEFT JOIN relo USING ({E}, part)),
rell AS (SELECT avg(max_error) + 3 * stddev_pop(max_error) AS le, avg(current_outlier) + 3 * stddev_pop(current_outlier) AS lo
         FROM relf WHERE part > 0),
anoms AS (SELECT {E}, 'performance' AS kind FROM perf
          WHERE NOT (over_max_count = 0 AND max_delta = 0 AND over_avg_count = 0 AND avg_ratio = 1.0)
          UNION ALL
          SELECT {E}, 'reliability' FROM relf WHERE part = 0
            AND (coalesce(max_error > (SELECT le FROM rell), false) OR coalesce(current_outlier > (SELECT lo FROM rell), false))
          UNION ALL
          SELECT {E}, 'traffic' FROM traf
          WHERE (outlier_count > 0 AND corr_cluster > 0.9) OR (outlier_count > 0 AND strict_n > 0))"""


REL = SERIES + f""",
rc AS (SELECT {E}, CAST(avg(rt) > 50 AS DOUBLE) AS rt_over_thresh, max(error) AS max_error, count(*) AS n,
         covar_pop(error, rt) / nullif(stddev_pop(error) * stddev_pop(rt), 0) AS r FROM w WHERE in_cur GROUP BY {E} HAVING bool_or(has_error)),
d_baseline_outlier AS (SELECT {E}, error - lag(error) OVER (PARTITION BY src, dst ORDER BY ts) AS d FROM w WHERE in_base),
s_baseline_outlier AS (SELECT {E}, avg(d) AS m, stddev_pop(d) AS s FROM d_baseline_outlier WHERE d IS NOT NULL GROUP BY {E}),
o_baseline_outlier AS (SELECT x.src, x.dst, avg(x.d) AS baseline_outlier FROM d_baseline_outlier x JOIN s_baseline_outlier USING ({E})
             WHERE x.d IS NOT NULL AND abs(x.d - m) > 3 * s GROUP BY 1, 2),
d_current_outlier AS (SELECT {E}, error - lag(error) OVER (PARTITION BY src, dst ORDER BY ts) AS d FROM w WHERE in_cur),
s_current_outlier AS (SELECT {E}, avg(d) AS m, stddev_pop(d) AS s FROM d_current_outlier WHERE d IS NOT NULL GROUP BY {E}),
o_current_outlier AS (SELECT x.src, x.dst, avg(x.d) AS current_outlier FROM d_current_outlier x JOIN s_current_outlier USING ({E})
             WHERE x.d IS NOT NULL AND abs(x.d - m) > 3 * s GROUP BY 1, 2)"""


#: the same over the edges with the planted fault
_ON_PATH = " OR ".join(f"(prev_type = '{a}' AND event_type = '{b}')" for a, b in PLANTED)
_PLANT = f"""CASE WHEN k >= {PLANT_K} OR (({_ON_PATH})
    AND ts > (SELECT max(ts) FROM events) - INTERVAL '{PLANT_HOURS} hours') THEN 1 ELSE 0 END"""


def _planted(sql):
    return sql.replace("CASE WHEN k >= 90 THEN 1 ELSE 0 END", _PLANT)


ENTRY = f"""by_node AS (SELECT dst AS entry, CAST(count(*) AS DOUBLE) AS score, 1 AS p FROM anoms GROUP BY dst),
busy AS (SELECT dst AS entry, sum(qps) AS score, 0 AS p FROM w WHERE ts = (SELECT max(ts) FROM w) GROUP BY dst),
entry AS (SELECT entry FROM (SELECT * FROM by_node UNION ALL SELECT * FROM busy) ORDER BY p DESC, round(score, 12) DESC, entry LIMIT 1)"""

CHAINS = ENTRY + """,
cs AS (SELECT a.kind, w.ts, w.src, w.dst, CASE a.kind WHEN 'performance' THEN rt WHEN 'reliability' THEN error ELSE qps END AS v,
         count(*) OVER (PARTITION BY a.kind, w.src, w.dst) AS len
       FROM w JOIN anoms a ON a.src = w.src AND a.dst = w.dst WHERE in_cur),
cp AS (SELECT x.kind, x.src AS a, x.dst AS b, y.dst AS c, CASE WHEN any_value(x.len) <> any_value(y.len) THEN 0
         ELSE covar_pop(x.v, y.v) / nullif(stddev_pop(x.v) * stddev_pop(y.v), 0) END AS r
       FROM cs x JOIN cs y ON x.kind = y.kind AND x.ts = y.ts AND x.dst = y.src AND x.src <> y.dst GROUP BY ALL),
steps AS (SELECT kind, a AS prev, b AS hop, c AS cand, r FROM cp WHERE r >= 0.7 AND kind <> 'traffic'
          UNION ALL SELECT kind, c, b, a, r FROM cp WHERE r >= 0.7 AND kind = 'traffic'),
walk(kind, path) AS (
  SELECT kind, CASE WHEN kind = 'traffic' THEN [dst, src] ELSE [src, dst] END FROM anoms
  WHERE CASE WHEN kind = 'traffic' THEN dst ELSE src END = (SELECT entry FROM entry)
  UNION ALL
  (SELECT k, list_append(p, cand) FROM (
     SELECT walk.kind AS k, walk.path AS p, s.cand, row_number() OVER (PARTITION BY walk.kind, walk.path ORDER BY s.r DESC, s.cand) AS n
     FROM walk JOIN steps s ON s.kind = walk.kind AND s.prev = walk.path[-2] AND s.hop = walk.path[-1]
     WHERE NOT list_contains(walk.path, s.cand)) WHERE n = 1))
SELECT path[-1] AS root, kind AS type, array_to_string(path, ' -> ') AS chain, CAST(len(path) AS INTEGER) AS length
FROM walk WHERE NOT EXISTS (SELECT 1 FROM walk n WHERE n.kind = walk.kind AND n.path[1:-2] = walk.path)"""


def _w(spark, sf_dir):
    return edge_rca.prepared_windows(mesh.counters_for(spark, sf_dir))


def _planted_counters(spark, sf_dir):
    return mesh.mesh_counters(planted_edge_points(spark, sf_dir))


@register("det11_performance_features", sql=f"WITH {PERF} SELECT * FROM perf")
def det11_performance_features(spark, sf_dir):
    """DET11: current latency against the baseline max and mean per edge."""
    return edge_rca.performance_features(_w(spark, sf_dir))


@register("det12_reliability_features", sql=f"""WITH {REL}
SELECT c.src, c.dst, coalesce(ob.baseline_outlier, 0) AS baseline_outlier,
       coalesce(oc.current_outlier, 0) AS current_outlier, c.rt_over_thresh, c.max_error,
       CASE WHEN c.n > 1 THEN coalesce(c.r, 0) ELSE 0 END AS corr_rt_error
FROM rc c LEFT JOIN o_baseline_outlier ob USING ({E}) LEFT JOIN o_current_outlier oc USING ({E})
WHERE EXISTS (SELECT 1 FROM w WHERE w.in_base AND w.src = c.src AND w.dst = c.dst)""")
def det12_reliability_features(spark, sf_dir):
    """DET12: outlier deltas of the error share, rt threshold, max error,
    corr(error, rt)."""
    return edge_rca.reliability_features(_w(spark, sf_dir))


@register("det13_traffic_features", sql=f"""WITH {TRAF}
SELECT {E}, mean_delta, std_delta, outlier_count, corr_cluster,
       (outlier_count > 0 AND corr_cluster > 0.9) OR (outlier_count > 0 AND strict_n > 0) AS is_anomaly FROM traf""")
def det13_traffic_features(spark, sf_dir):
    """DET13 + DET14 (+PQL7): traffic deltas, 3-sigma outliers, cluster corr, rule."""
    return edge_rca.traffic_features(_w(spark, sf_dir))


@register("det15_edge_anomalies", sql=f"WITH {TRAF} SELECT * FROM anoms")
def det15_edge_anomalies(spark, sf_dir):
    """DET15 (+DET14, JN9 input): typed edge anomalies in long form."""
    return edge_rca.edge_anomalies(_w(spark, sf_dir))


@register("det15_planted_anomalies", sql=_planted(f"WITH {TRAF} SELECT * FROM anoms"))
def det15_planted_anomalies(spark, sf_dir):
    """DET15 on the edges with a planted error burst: the burst's edges are
    reliability anomalies."""
    return edge_rca.edge_anomalies(edge_rca.prepared_windows(_planted_counters(spark, sf_dir)))


@register("det15_reliability_forest")
def det15_reliability_forest(spark, sf_dir):
    """DET15 (+DET6, D7): forest scores of the reliability features, fitted on
    the baseline windows of all edges, with the planted error burst."""
    return edge_rca.reliability_scores(edge_rca.prepared_windows(_planted_counters(spark, sf_dir)))


@register("rca4_entry_selection", sql=f"WITH {TRAF}, {ENTRY} SELECT entry FROM entry")
def rca4_entry_selection(spark, sf_dir):
    """RCA4 (+AGG9, TOP6, TOP5): the entry service of the edge RCA."""
    w = _w(spark, sf_dir)
    return edge_rca.select_entry(edge_rca.edge_anomalies(w), w)


@register("rca6_edge_candidates")
def rca6_edge_candidates(spark, sf_dir):
    """RCA5 + RCA6 (JOB4, +COR6, JN9, GRA5, TOP7): typed correlated chains
    from the entry and their root candidates; reliability by the forest."""
    return edge_rca.edge_rca(mesh.counters_for(spark, sf_dir))


@register("rca6_rule_candidates", sql=f"WITH RECURSIVE {TRAF}, {CHAINS}")
def rca6_rule_candidates(spark, sf_dir):
    """RCA5 + RCA6 with the reliability rule in place of the forest."""
    return edge_rca.edge_rca(mesh.counters_for(spark, sf_dir), reliability="rule")


@register("rca6_planted_candidates", sql=_planted(f"WITH RECURSIVE {TRAF}, {CHAINS}").replace(
    "(SELECT entry FROM entry)", "'view'"))
def rca6_planted_candidates(spark, sf_dir):
    """RCA5 + RCA6 from the first service of the planted fault: a reliability
    chain follows the burst."""
    return edge_rca.edge_rca(_planted_counters(spark, sf_dir), entry=PLANTED[0][0], reliability="rule")
