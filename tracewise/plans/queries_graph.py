"""Registered queries: correlation, dependency graphs, IQR root cause."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewise.functions.columns import CORR_THRESHOLD
from tracewise.operators import correlate, detect, features
from tracewise.plans import graph, mesh
from tracewise.plans.queries_mesh import RPS
from tracewise.plans.sqlbits import DAG_CTE, EDGES_CTE, METRICS_CTE, PHASES_CTE
from tracewise.registry import register
from tracewise.sources.bindings import (SERVICE_IDS, dag_edges, edge_points, linked_points, metric_phases,
                                        metric_points, standby_points, trade_edges, TRADE_SIGMA, with_service_id)

STEP = 6 * 3600
V5_THRESHOLD = 0.5          # threshold the lagged-correlation inference is called with
V5_METRICS = {"RT": "response_time", "QPS": "qps", "Error": "eps"}


def _series(df, value):
    return with_service_id(df).select(F.col("service_id").alias("id"), "ts", F.col(value).alias("x"))


def _corr_sql(src, series="SELECT server_name || '_' || ip_port AS id, ts, connection_count AS x FROM {src}"):
    """cor_<src>: pairs with a common timestamp, and others over the threshold;
    all_<src>: every pair."""
    return f"""s_{src} AS ({series.format(src=src)}),
nn_{src} AS (SELECT CAST(count(DISTINCT ts) AS DOUBLE) AS n FROM s_{src}),
one_{src} AS (SELECT id, sum(x) AS sx, sum(x * x) AS sxx FROM s_{src} GROUP BY id),
pr_{src} AS (SELECT a.id AS a, b.id AS b, sum(a.x * b.x) AS sxy FROM s_{src} a JOIN s_{src} b
             ON a.ts = b.ts AND a.id < b.id GROUP BY 1, 2),
all_{src} AS (SELECT oa.id AS a, ob.id AS b, pr.a IS NOT NULL AS met,
    CASE WHEN n * oa.sxx - oa.sx * oa.sx > 0 AND n * ob.sxx - ob.sx * ob.sx > 0
         THEN (n * coalesce(pr.sxy, 0) - oa.sx * ob.sx)
              / sqrt((n * oa.sxx - oa.sx * oa.sx) * (n * ob.sxx - ob.sx * ob.sx)) END AS r
  FROM one_{src} oa JOIN one_{src} ob ON oa.id < ob.id LEFT JOIN pr_{src} pr ON pr.a = oa.id AND pr.b = ob.id, nn_{src}),
cor_{src} AS (SELECT a, b, r FROM all_{src} WHERE met OR abs(r) > {CORR_THRESHOLD})"""


def _diff_sql(normal, problem):
    return f"""df AS (SELECT a, b, p.r AS r_problem, n.r AS r_normal, p.r - n.r AS diff
  FROM (SELECT a, b FROM cor_{problem} UNION SELECT a, b FROM cor_{normal})
  LEFT JOIN all_{problem} p USING (a, b) LEFT JOIN all_{normal} n USING (a, b))"""


def corr_normal(spark, sf_dir):
    base, _ = metric_phases(spark, sf_dir)
    return correlate.corr_matrix(_series(base, "connection_count"), "id", "ts", "x", STEP)


def corr_change(spark, sf_dir):
    """COR4 of the problem window against the baseline."""
    (normal, n_series), (problem, p_series) = (
        correlate.corr_state(_series(x, "connection_count"), "id", "ts", "x", STEP) for x in metric_phases(spark, sf_dir))
    return correlate.corr_diff(problem, normal, p_series, n_series)


@register("cor1_corr_matrix", sql=f"WITH {PHASES_CTE}, {_corr_sql('base')} SELECT * FROM cor_base")
def cor1_corr_matrix(spark, sf_dir):
    """COR1: zero-filled Pearson matrix of the baseline series (pairs a < b)."""
    return corr_normal(spark, sf_dir)


@register("cor2_corr_graph", sql=f"""WITH {PHASES_CTE}, {_corr_sql('base')}
SELECT a, b, r FROM cor_base WHERE abs(r) > {CORR_THRESHOLD}
UNION ALL SELECT b, a, r FROM cor_base WHERE abs(r) > {CORR_THRESHOLD}""")
def cor2_corr_graph(spark, sf_dir):
    """COR2: ``|r| > 0.7`` dependency graph, both directions."""
    return correlate.corr_graph(corr_normal(spark, sf_dir), CORR_THRESHOLD)


@register("cor4_corr_diff", sql=f"""WITH {PHASES_CTE}, {_corr_sql('base')}, {_corr_sql('prob')}, {_diff_sql('base', 'prob')}
SELECT * FROM df""")
def cor4_corr_diff(spark, sf_dir):
    """COR4 (+JN6, VIZ3): correlation change between problem and normal."""
    return corr_change(spark, sf_dir)


_STANDBY = """duty AS (SELECT DISTINCT time_bucket(INTERVAL '6 hours', ts) AS ts FROM events),
turns AS (SELECT CASE WHEN floor(epoch(ts) / 21600) % 2 = 0 THEN 'active' ELSE 'standby' END AS id, ts, 5.0::DOUBLE AS x FROM duty
           UNION ALL SELECT 'odd', ts, CASE WHEN floor(epoch(ts) / 21600) % 2 = 1 THEN 2.0::DOUBLE ELSE 1.0 END FROM duty
           UNION ALL SELECT 'rare', ts, 1.0::DOUBLE FROM duty WHERE floor(epoch(ts) / 21600) % 8 = 3)"""


@register("cor2_standby_graph", sql=f"""WITH {_STANDBY},
{_corr_sql('turns', 'SELECT * FROM turns')}
SELECT a, b, r FROM cor_turns WHERE abs(r) > {CORR_THRESHOLD}
UNION ALL SELECT b, a, r FROM cor_turns WHERE abs(r) > {CORR_THRESHOLD}""")
def cor2_standby_graph(spark, sf_dir):
    """COR2 on services that never report at the same time: an active and a
    standby series take turns (r = -1)."""
    return correlate.corr_graph(correlate.corr_matrix(standby_points(spark, sf_dir), "id", "ts", "x", STEP), CORR_THRESHOLD)


_STEPS_SQL = """s AS (SELECT server_name || '_' || ip_port AS id,
        CAST((epoch(ts) - epoch((SELECT min(ts) FROM metrics))) / 21600 AS BIGINT) AS step, response_time AS x
      FROM metrics)"""

COR5_CTE = f"""{METRICS_CTE}, {_STEPS_SQL},
lp AS (SELECT a.id AS caller, b.id AS callee, l.lag, a.x AS x, b.x AS y
       FROM s a JOIN range(1, 6) AS l(lag) ON true JOIN s b ON b.step = a.step - l.lag AND a.id <> b.id),
lr AS (SELECT caller, callee, lag, covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0) AS r
       FROM lp GROUP BY caller, callee, lag),
lb AS (SELECT * FROM lr WHERE r IS NOT NULL AND r > -1
       QUALIFY row_number() OVER (PARTITION BY caller, callee ORDER BY r DESC, lag) = 1),
cor5 AS (SELECT caller, callee, r, CAST(lag AS INTEGER) AS lag FROM lb WHERE r >= {V5_THRESHOLD})"""


def lagged_edges(spark, sf_dir):
    pts = metric_points(spark, sf_dir)
    return correlate.lagged_corr_edges(_series(pts, "response_time"), "id", "ts", "x", STEP,
                                       lag_max=5, threshold=V5_THRESHOLD)


@register("cor5_lagged_corr_edges", sql=f"WITH {COR5_CTE} SELECT * FROM cor5")
def cor5_lagged_corr_edges(spark, sf_dir):
    """COR5 (+JN11, WIN14, JN7): best-lag cross-correlation edges caller -> callee."""
    return lagged_edges(spark, sf_dir)


@register("win14_best_lag", sql=f"""WITH {COR5_CTE} SELECT caller, callee, r, CAST(lag AS INTEGER) AS lag FROM lb""")
def win14_best_lag(spark, sf_dir):
    """WIN14: best lag per ordered pair before the threshold."""
    pts = metric_points(spark, sf_dir)
    return correlate.lagged_corr_edges(_series(pts, "response_time"), "id", "ts", "x", STEP,
                                       lag_max=5, threshold=-1.0)


@register("cor6_edge_pair_corr", sql=f"""WITH {RPS},
el AS (SELECT *, count(*) OVER (PARTITION BY src, dst) AS len FROM rps)
SELECT e1.src AS a, e1.dst AS b, e2.dst AS c, count(*) AS n,
       CASE WHEN any_value(e1.len) <> any_value(e2.len) THEN 0.0
            ELSE covar_pop(e1.rps, e2.rps) / nullif(stddev_pop(e1.rps) * stddev_pop(e2.rps), 0) END AS r
FROM el e1 JOIN el e2 ON e1.ts = e2.ts AND e1.dst = e2.src AND e1.src <> e2.dst
GROUP BY 1, 2, 3""")
def cor6_edge_pair_corr(spark, sf_dir):
    """COR6: qps correlation of consecutive call edges a->b, b->c."""
    return correlate.edge_pair_corr(mesh.rps(mesh.counters_for(spark, sf_dir)), "rps")


# ------------------------------------------------- series linked by a known lag

_LINKED = f"""lk AS (SELECT user_id % 5 AS k, time_bucket(INTERVAL '6 hours', ts) AS ts, CAST(count(*) AS DOUBLE) AS x
       FROM events GROUP BY 1, 2),
linked AS (SELECT 'link_' || CAST(a.k AS VARCHAR) AS id, a.ts, z.x + 0.1 * a.x AS x FROM lk a
             JOIN lk z ON z.k = 0 AND z.ts = a.ts - to_hours(CAST(6 * a.k AS BIGINT))
           UNION ALL SELECT 'shifted', ts, 1e9 + x FROM lk WHERE k = 0
           UNION ALL SELECT 'constant', ts, 0.7 FROM lk WHERE k = 0)"""

_LINKED_LAGS = f"""{_LINKED},
ls AS (SELECT id, CAST((epoch(ts) - epoch((SELECT min(ts) FROM linked))) / 21600 AS BIGINT) AS step, x FROM linked),
lz AS (SELECT id, step, CASE WHEN id = 'shifted' THEN x - 1e9 ELSE x END AS x FROM ls WHERE id <> 'constant'),
lr AS (SELECT a.id AS caller, b.id AS callee, l.lag, covar_pop(a.x, b.x) / nullif(stddev_pop(a.x) * stddev_pop(b.x), 0) AS r
       FROM lz a JOIN range(1, 6) AS l(lag) ON true JOIN lz b ON b.step = a.step - l.lag AND a.id <> b.id GROUP BY 1, 2, 3),
lb AS (SELECT * FROM lr WHERE r IS NOT NULL
       QUALIFY row_number() OVER (PARTITION BY caller, callee ORDER BY round(r, 9) DESC, lag) = 1),
ledge AS (SELECT caller, callee, r, CAST(lag AS INTEGER) AS lag FROM lb WHERE r >= 0.6)"""


def _linked_edges(spark, sf_dir):
    return correlate.lagged_corr_edges(linked_points(spark, sf_dir), "id", "ts", "x", STEP, lag_max=5, threshold=0.6)


@register("cor5_linked_edges", sql=f"WITH {_LINKED_LAGS} SELECT * FROM ledge")
def cor5_linked_edges(spark, sf_dir):
    """COR5 on series with known lags: ``link_k`` follows ``link_j`` by k - j."""
    return _linked_edges(spark, sf_dir)


@register("cor2_linked_graph", sql=f"""WITH {_LINKED},
g AS (SELECT DISTINCT ts FROM linked), ids AS (SELECT DISTINCT id FROM linked),
z AS (SELECT ids.id, g.ts, coalesce(l.x, 0) AS x FROM ids CROSS JOIN g LEFT JOIN linked l USING (id, ts)),
c AS (SELECT a.id AS a, b.id AS b, covar_pop(a.x, b.x) / nullif(stddev_pop(a.x) * stddev_pop(b.x), 0) AS r
      FROM z a JOIN z b ON a.ts = b.ts AND a.id < b.id WHERE a.id <> 'constant' GROUP BY 1, 2)
SELECT a, b, r FROM c WHERE abs(r) > {CORR_THRESHOLD}
UNION ALL SELECT b, a, r FROM c WHERE abs(r) > {CORR_THRESHOLD}""")
def cor2_linked_graph(spark, sf_dir):
    """COR2 on the linked series: a constant has no edges, an offset of 1e9
    does not hide one."""
    x = linked_points(spark, sf_dir)
    return correlate.corr_graph(correlate.corr_matrix(x, "id", "ts", "x", STEP), CORR_THRESHOLD)


def _linked_tests(spark, sf_dir):
    """Dense linked series and the ordered pairs among them."""
    from tracewise.plans import service
    x = correlate.with_step_index(linked_points(spark, sf_dir).filter("id LIKE 'link%'"), "ts", STEP)
    pairs = _linked_edges(spark, sf_dir).filter("caller LIKE 'link%' AND callee LIKE 'link%'") \
        .select(F.col("caller").alias("a"), F.col("callee").alias("b"))
    return service.densify(x, "id", "step", "x"), pairs


@register("cor3_linked_directions")
def cor3_linked_directions(spark, sf_dir):
    """COR3 on the linked series: which neighbour causes which."""
    from tracewise.operators import granger
    return granger.granger(*_linked_tests(spark, sf_dir), maxlag=5)


@register("cor3_linked_lag1_f", sql=f"""WITH {_LINKED_LAGS},
gl AS (SELECT id, step, x FROM ls WHERE id LIKE 'link%'),
hull AS (SELECT min(step) AS lo, max(step) AS hi FROM gl),
dense AS (SELECT i.id, g.step, coalesce(gl.x, 0) AS x FROM (SELECT DISTINCT id FROM gl) i
          CROSS JOIN (SELECT unnest(range(lo, hi + 1)) AS step FROM hull) g LEFT JOIN gl ON gl.id = i.id AND gl.step = g.step),
tr AS (SELECT e.caller AS a, e.callee AS b, y.x AS y, p.x AS p, q.x AS q FROM ledge e
       JOIN dense y ON y.id = e.caller JOIN dense p ON p.id = e.caller AND p.step = y.step - 1
       JOIN dense q ON q.id = e.callee AND q.step = y.step - 1),
c AS (SELECT a, b, count(*) AS n, var_pop(y) * count(*) AS syy, corr(y, p) AS yp, corr(y, q) AS yq, corr(p, q) AS pq FROM tr GROUP BY a, b),
ssr AS (SELECT *, syy * (1 - yp * yp) AS part, syy * (1 - (yp * yp + yq * yq - 2 * yp * yq * pq) / (1 - pq * pq)) AS whole FROM c)
SELECT a, b, (part - whole) / (whole / (n - 3)) AS f FROM ssr""")
def cor3_linked_lag1_f(spark, sf_dir):
    """COR3: the F of lag 1 from lagged Gram products, in closed form."""
    from tracewise.operators import granger
    return granger.granger_tests(*_linked_tests(spark, sf_dir), maxlag=1).select("a", "b", "f")


@register("agg7_corr_with_total", sql=f"""WITH {PHASES_CTE},
s AS (SELECT server_name || '_' || ip_port AS id, ts, connection_count AS x FROM prob),
tot AS (SELECT ts, sum(x) AS t FROM s GROUP BY ts)
SELECT id, covar_pop(x, t) / nullif(stddev_pop(x) * stddev_pop(t), 0) AS corr_total
FROM s JOIN tot USING (ts) GROUP BY id HAVING count(*) = (SELECT count(*) FROM tot)""")
def agg7_corr_with_total(spark, sf_dir):
    """AGG7 (+AGG6, JN8): each service vs the system total, full series only."""
    _, prob = metric_phases(spark, sf_dir)
    return correlate.series_vs_total(_series(prob, "connection_count"), "id", "ts", "x")


# ----------------------------------------------------------- IQR root cause

def long_metrics(spark, sf_dir):
    """SRC9 target shape: (service, ts, metric, value) for RT / QPS / Error."""
    pts = with_service_id(metric_points(spark, sf_dir))
    return pts.select(F.col("service_id").alias("service"), "ts",
                      F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), F.col(v).alias("value"))
                                          for k, v in V5_METRICS.items()])).alias("m")).select(
        "service", "ts", "m.metric", "m.value")


def iqr_table(spark, sf_dir):
    lm = features.split_last_n(long_metrics(spark, sf_dir), ["service", "metric"], n=20)
    return detect.iqr_anomalies(lm, ["service", "metric"], "value")


_LONG_SQL = f"""{METRICS_CTE},
lm AS (SELECT server_name || '_' || ip_port AS service, ts, m.metric, m.value FROM metrics,
         (SELECT unnest([{{'metric': 'RT', 'value': response_time}}, {{'metric': 'QPS', 'value': qps}},
                         {{'metric': 'Error', 'value': eps}}]) AS m)),
ph AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY service, metric ORDER BY ts DESC) <= 20
                      THEN 'current' ELSE 'history' END AS phase FROM lm),
iqr0 AS (SELECT service, metric,
           quantile_cont(value, 0.25) FILTER (WHERE phase = 'history') AS q1,
           quantile_cont(value, 0.75) FILTER (WHERE phase = 'history') AS q3,
           avg(value) FILTER (WHERE phase = 'current') AS current_value
         FROM ph GROUP BY service, metric),
iqr AS (SELECT service, metric, q1, q3, q3 + 3 * (q3 - q1) AS ub, q1 - 3 * (q3 - q1) AS lb, current_value,
          CASE WHEN current_value > q3 + 3 * (q3 - q1) THEN 'High'
               WHEN current_value < q1 - 3 * (q3 - q1) THEN 'Low' END AS anomaly_type
        FROM iqr0)"""


@register("det5_iqr_anomalies", sql=f"""WITH {_LONG_SQL}
SELECT *, anomaly_type IS NOT NULL AS is_anomalous FROM iqr""")
def det5_iqr_anomalies(spark, sf_dir):
    """DET5 (+WIN12, AGG10): last 20 steps vs IQR fences of the history."""
    return iqr_table(spark, sf_dir)


@register("src9_wide_to_long", sql=f"""WITH {_LONG_SQL} SELECT service, ts, metric, value FROM lm""")
def src9_wide_to_long(spark, sf_dir):
    """SRC9: the wide ``<svc>_<metric>`` table unpivoted to long rows.

    The wide table is built with ``pivot`` over the caller's list of service
    columns; ``unpivot`` takes its columns from the wide table's schema, and a
    regex on the column name gives back (service, metric)."""
    lm = long_metrics(spark, sf_dir)
    cols = [f"{s}|{m}" for s in SERVICE_IDS for m in V5_METRICS]
    wide = (lm.select("ts", F.concat_ws("|", "service", "metric").alias("col"), "value")
            .groupBy("ts").pivot("col", cols).agg(F.first("value")))
    long = wide.unpivot("ts", [F.col(f"`{c}`") for c in wide.columns if c != "ts"], "col", "value")
    return long.select(F.regexp_extract("col", r"^(.*)\|([^|]*)$", 1).alias("service"), "ts",
                       F.regexp_extract("col", r"^(.*)\|([^|]*)$", 2).alias("metric"), "value").filter(
        F.col("value").isNotNull())


def anomalous_services(spark, sf_dir):
    return (iqr_table(spark, sf_dir).groupBy(F.col("service").alias("id"))
            .agg(F.bool_or("is_anomalous").alias("a")).filter("a").select("id"))


_RCA7_SQL = f"""WITH {_LONG_SQL}, {COR5_CTE.replace(METRICS_CTE + ',', '', 1)},
anom AS (SELECT DISTINCT service AS id FROM iqr WHERE anomaly_type IS NOT NULL),
sick AS (SELECT DISTINCT caller AS id FROM cor5 WHERE callee IN (SELECT id FROM anom)),
cand AS (SELECT id FROM anom WHERE id NOT IN (SELECT id FROM sick)),
indeg AS (SELECT callee AS id, count(*) AS d FROM cor5 GROUP BY callee),
ranked AS (SELECT c.id AS root_cause, coalesce(i.d, 0) AS d, 1 AS f FROM cand c LEFT JOIN indeg i USING (id)
           UNION ALL SELECT 'Not Found', 0, 0)"""


@register("rca7_downstream_root_cause", sql=_RCA7_SQL + """
SELECT root_cause FROM ranked ORDER BY f DESC, d DESC, root_cause LIMIT 1""")
def rca7_downstream_root_cause(spark, sf_dir):
    """RCA7 (+JN10, AGG14, TOP6): anomalous service without anomalous callees,
    most callers first; 'Not Found' when none."""
    edges = lagged_edges(spark, sf_dir).select(F.col("caller").alias("src"), F.col("callee").alias("dst"))
    return graph.downstream_root_cause(anomalous_services(spark, sf_dir), edges)


@register("viz4_graph_labels", sql=_RCA7_SQL + """,
root AS (SELECT root_cause FROM ranked ORDER BY f DESC, d DESC, root_cause LIMIT 1),
v AS (SELECT caller AS id FROM cor5 UNION SELECT callee FROM cor5 UNION SELECT id FROM anom)
SELECT id, CASE WHEN id IN (SELECT root_cause FROM root) THEN 'root'
                WHEN id IN (SELECT id FROM anom) THEN 'symptom' ELSE 'normal' END AS status FROM v""")
def viz4_graph_labels(spark, sf_dir):
    """VIZ4: root / symptom / normal label per graph vertex."""
    edges = lagged_edges(spark, sf_dir).select(F.col("caller").alias("src"), F.col("callee").alias("dst"))
    anom = anomalous_services(spark, sf_dir)
    return graph.graph_labels(anom, edges, graph.downstream_root_cause(anom, edges))


# ---------------------------------------------------------------- graphs

@register("gra1_build_graph", sql=f"""WITH {EDGES_CTE}
SELECT src, dst, count(*) AS calls, avg(rt) AS latency, avg(error) > 0.1 AS anomaly FROM edges GROUP BY src, dst""")
def gra1_build_graph(spark, sf_dir):
    """GRA1: directed graph from edge rows with latency and anomaly attributes."""
    e = edge_points(spark, sf_dir)
    return e.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("calls"), F.avg("rt").alias("latency"),
                                       (F.avg("error") > 0.1).alias("anomaly"))


@register("agg14_degrees", sql=f"""WITH {DAG_CTE},
v AS (SELECT src AS id FROM dag UNION SELECT dst FROM dag)
SELECT id, (SELECT count(*) FROM dag WHERE dst = id) AS in_degree, (SELECT count(*) FROM dag WHERE src = id) AS out_degree
FROM v""")
def agg14_degrees(spark, sf_dir):
    """AGG14: in/out degree per vertex of the region-nation-supplier DAG."""
    return graph.degrees(dag_edges(spark, sf_dir))


@register("gra5_successors", sql=f"""WITH {EDGES_CTE} SELECT DISTINCT dst AS id FROM edges WHERE src = 'view'""")
def gra5_successors(spark, sf_dir):
    """GRA5: callees of one service."""
    return graph.neighbours(edge_points(spark, sf_dir).select("src", "dst"), "view", "out")


def _pagerank_sql(max_iter: int = 100, alpha: float = 0.85, tol: float = 1e-6) -> str:
    """Unrolled power iteration with the same start, dangling rule and
    stopping test as ``graph.pagerank`` (first round whose L1 change is
    below N * tol)."""
    parts = [DAG_CTE,
             "e AS (SELECT DISTINCT src, dst FROM dag)",
             "v AS (SELECT src AS id FROM e UNION SELECT dst FROM e)",
             "od AS (SELECT v.id, coalesce(c.c, 0) AS od FROM v LEFT JOIN "
             "(SELECT src AS id, count(*) AS c FROM e GROUP BY src) c USING (id))",
             "nn AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM v)",
             "p0 AS (SELECT id, 1.0 / (SELECT n FROM nn) AS pr FROM v)"]
    for i in range(1, max_iter + 1):
        prev = f"p{i - 1}"
        parts.append(
            f"p{i} AS (SELECT o.id, {alpha} * coalesce(c.c, 0) + ({alpha} * "
            f"(SELECT coalesce(sum(q.pr), 0) FROM {prev} q JOIN od d USING (id) WHERE d.od = 0) "
            f"+ {1 - alpha}) / (SELECT n FROM nn) AS pr FROM od o LEFT JOIN "
            f"(SELECT e.dst AS id, sum(q.pr / d.od) AS c FROM e JOIN {prev} q ON q.id = e.src "
            f"JOIN od d ON d.id = e.src GROUP BY e.dst) c USING (id))")
        parts.append(f"r{i} AS (SELECT {i} AS k, sum(abs(a.pr - b.pr)) AS err FROM p{i} a JOIN {prev} b USING (id))")
    errs = " UNION ALL ".join(f"SELECT * FROM r{i}" for i in range(1, max_iter + 1))
    ranks = " UNION ALL ".join(f"SELECT {i} AS k, id, pr FROM p{i}" for i in range(1, max_iter + 1))
    parts.append(f"errs AS ({errs})")
    parts.append(f"stop AS (SELECT coalesce(min(k) FILTER (WHERE err < (SELECT n FROM nn) * {tol}), {max_iter}) AS k FROM errs)")
    parts.append(f"allr AS ({ranks})")
    return "WITH " + ",\n".join(parts) + "\nSELECT id, pr AS pagerank FROM allr WHERE k = (SELECT k FROM stop)"


@register("gra2_pagerank", sql=_pagerank_sql())
def gra2_pagerank(spark, sf_dir):
    """GRA2: PageRank of the region-nation-supplier graph (iterative joins)."""
    return graph.pagerank(dag_edges(spark, sf_dir))


def _closure(edges):
    """Which vertex reaches which along the (src, dst) rows of ``edges``."""
    return f"reach(a, b) AS (SELECT src, dst FROM {edges} UNION SELECT reach.a, e.dst FROM reach JOIN {edges} e ON e.src = reach.b)"


@register("gra3_acyclic", sql=f"""WITH RECURSIVE {DAG_CTE}, {_closure('dag')}
SELECT NOT EXISTS (SELECT 1 FROM reach WHERE a = b) AS is_acyclic""")
def gra3_acyclic(spark, sf_dir):
    """GRA3: acyclicity of the DAG binding (layer peeling)."""
    return spark.range(1).select(F.lit(graph.is_acyclic(dag_edges(spark, sf_dir))).alias("is_acyclic"))


@register("gra3_cycle_detected", sql=f"""WITH RECURSIVE {EDGES_CTE}, calls AS (SELECT DISTINCT src, dst FROM edges), {_closure('calls')}
SELECT NOT EXISTS (SELECT 1 FROM reach WHERE a = b) AS is_acyclic""")
def gra3_cycle_detected(spark, sf_dir):
    """GRA3 on the (dense, cyclic) call graph: reports the cycle."""
    e = edge_points(spark, sf_dir).select("src", "dst").distinct()
    return spark.range(1).select(F.lit(graph.is_acyclic(e)).alias("is_acyclic"))


_TRADE = f"""lines AS (SELECT s.n_name AS src, c.n_name AS dst, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation s ON s.n_nationkey = s_nationkey
    JOIN customer ON o_custkey = c_custkey JOIN nation c ON c.n_nationkey = c_nationkey GROUP BY 1, 2),
trade AS (SELECT src, dst FROM lines WHERE n > (SELECT avg(n) + {TRADE_SIGMA} * stddev_pop(n) FROM lines) AND src <> dst),
tv AS (SELECT src AS id FROM trade UNION SELECT dst FROM trade),
{_closure('trade')},
comp AS (SELECT tv.id, least(tv.id, coalesce(min(f.b), tv.id)) AS component FROM tv
         LEFT JOIN (reach f JOIN reach g ON f.a = g.b AND f.b = g.a) ON f.a = tv.id GROUP BY tv.id),
sized AS (SELECT id, component, count(*) OVER (PARTITION BY component) AS size FROM comp)"""


@register("gra3_strong_components", sql=f"WITH RECURSIVE {_TRADE} SELECT id, component, size FROM sized")
def gra3_strong_components(spark, sf_dir):
    """GRA3: strongly connected component of every nation in the trade graph."""
    return graph.strong_components(trade_edges(spark, sf_dir))


@register("gra4_cycle_members", sql=f"WITH RECURSIVE {_TRADE} SELECT component, id FROM sized WHERE size > 1")
def gra4_cycle_members(spark, sf_dir):
    """GRA4 on a graph with cycles: the members of each cycle's component."""
    return graph.cycle_members(trade_edges(spark, sf_dir))


@register("gra4_longest_path", sql=f"""WITH RECURSIVE {DAG_CTE},
v AS (SELECT src AS id FROM dag UNION SELECT dst FROM dag),
srcs AS (SELECT id FROM v WHERE id NOT IN (SELECT dst FROM dag)),
paths(path) AS (SELECT [id] FROM srcs
                UNION ALL
                SELECT list_append(p.path, d.dst) FROM paths p JOIN dag d ON d.src = p.path[-1]),
lay AS (SELECT path[-1] AS id, max(len(path)) - 1 AS layer FROM paths GROUP BY 1),
endv AS (SELECT id, layer FROM lay ORDER BY layer DESC, id LIMIT 1),
best AS (SELECT path FROM paths
         WHERE path[-1] = (SELECT id FROM endv) AND len(path) - 1 = (SELECT layer FROM endv)
         ORDER BY list_reverse(path) DESC LIMIT 1)
SELECT CAST(i - 1 AS INTEGER) AS pos, path[i] AS id FROM best, range(1, len(path) + 1) AS r(i)""")
def gra4_longest_path(spark, sf_dir):
    """GRA4: a longest path of the DAG, one row per position."""
    return graph.longest_path(dag_edges(spark, sf_dir))
