"""Registered queries on the planted service fault (B13): the detectors, labels
and rankings where something is wrong, with a rule in place of the forest so that
SQL can state the result (FN6, FN7, FLT5, DET5, RCA1-3, RCA7, JN4, JN10, AGG13,
TOP3, VIZ2, VIZ4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewise.functions.columns import SIGMA_K, safe_div
from tracewise.operators import detect, normalize
from tracewise.operators.correlate import series_vs_total
from tracewise.plans import graph, service
from tracewise.plans.queries_graph import _LINKED_LAGS, _linked_edges
from tracewise.registry import register
from tracewise.session import cut_lineage
from tracewise.sources.bindings import FAULT_STEPS, planted_points

_PLANTED = f"""{_LINKED_LAGS},
pend AS (SELECT max(ts) AS t FROM linked WHERE id = 'link_0'),
page AS (SELECT id, ts, x, CAST((epoch((SELECT t FROM pend)) - epoch(ts)) / 21600 AS BIGINT) AS age FROM linked
         WHERE (id LIKE 'link%' OR id = 'constant') AND ts <= (SELECT t FROM pend)),
pp AS (SELECT id, ts, x + CASE WHEN id = 'link_1' AND age < 5 THEN -1000
           WHEN id LIKE 'link%' AND age < 5 * CAST(right(id, 1) AS INTEGER) THEN 1000 ELSE 0 END AS x, age FROM page
       UNION ALL SELECT 'late', ts, x, age FROM page WHERE id = 'link_0' AND age < {FAULT_STEPS}),
piqr0 AS (SELECT id, quantile_cont(x, 0.25) FILTER (WHERE age >= {FAULT_STEPS}) AS q1,
            quantile_cont(x, 0.75) FILTER (WHERE age >= {FAULT_STEPS}) AS q3,
            avg(x) FILTER (WHERE age < {FAULT_STEPS}) AS current_value FROM pp GROUP BY id),
piqr AS (SELECT id AS service, q1, q3, q3 + 3 * (q3 - q1) AS ub, q1 - 3 * (q3 - q1) AS lb, current_value,
           CASE WHEN current_value > q3 + 3 * (q3 - q1) THEN 'High'
                WHEN current_value < q1 - 3 * (q3 - q1) THEN 'Low' END AS anomaly_type FROM piqr0),
panom AS (SELECT service AS id FROM piqr WHERE anomaly_type IS NOT NULL),
psick AS (SELECT DISTINCT caller AS id FROM ledge WHERE callee IN (SELECT id FROM panom)),
pindeg AS (SELECT callee AS id, count(*) AS d FROM ledge GROUP BY callee),
prank AS (SELECT p.id AS root_cause, coalesce(i.d, 0) AS d, 1 AS f FROM panom p LEFT JOIN pindeg i USING (id)
          WHERE p.id NOT IN (SELECT id FROM psick) UNION ALL SELECT 'Not Found', 0, 0),
proot AS (SELECT root_cause FROM prank ORDER BY f DESC, d DESC, root_cause LIMIT 1),
pst AS (SELECT id, avg(x) AS m, stddev_samp(x) AS s FROM pp WHERE age >= {FAULT_STEPS} GROUP BY id),
pflag AS (SELECT id, ts, x, coalesce(abs(x - m) > 3 * s, false) AS bad FROM pp LEFT JOIN pst USING (id) WHERE age < {FAULT_STEPS}),
prate AS (SELECT id AS service_id, avg(CAST(bad AS DOUBLE)) AS anomaly_rate FROM pflag GROUP BY id),
pnext AS (SELECT caller AS a, callee AS b FROM ledge JOIN prate ON service_id = callee
          QUALIFY row_number() OVER (PARTITION BY caller ORDER BY anomaly_rate DESC, callee) = 1),
pwalk(start, chain, going) AS (
  SELECT service_id, [service_id], true FROM (SELECT * FROM prate ORDER BY anomaly_rate DESC, service_id LIMIT 5)
  UNION ALL SELECT start, list_append(chain, b), NOT list_contains(chain, b) FROM pwalk JOIN pnext ON a = chain[-1] WHERE going),
pchain AS (SELECT start AS service_id, max_by(chain, len(chain)) AS chain FROM pwalk GROUP BY start),
ptot AS (SELECT ts, sum(x) AS t FROM pflag GROUP BY ts),
pcorr AS (SELECT id AS service_id, covar_pop(x, t) / nullif(stddev_pop(x) * stddev_pop(t), 0) AS r FROM pflag JOIN ptot USING (ts)
          GROUP BY id HAVING count(*) = (SELECT count(*) FROM ptot)),
pranks AS (SELECT service_id, abs(r) * coalesce(len(chain), 1) AS rank_score FROM pcorr LEFT JOIN pchain USING (service_id)),
pworst AS (SELECT service_id, anomaly_rate, rank_score, array_to_string(chain, ' -> ') AS chain
           FROM prate FULL JOIN pranks USING (service_id) LEFT JOIN pchain USING (service_id))"""


def _sql(select):
    return f"WITH RECURSIVE {_PLANTED} {select}"


def _points(spark, sf_dir):
    return cut_lineage(planted_points(spark, sf_dir))


def _iqr(points):
    phase = F.when(F.col("age") < FAULT_STEPS, "current").otherwise("history")
    return detect.iqr_anomalies(points.select(F.col("id").alias("service"), phase.alias("phase"), F.col("x").alias("value")),
                                ["service"], "value")


def _edges(spark, sf_dir):
    """Who depends on whom, from the series without the fault."""
    return cut_lineage(_linked_edges(spark, sf_dir).select(F.col("caller").alias("src"), F.col("callee").alias("dst"), "r"))


def _flags(points):
    """(id, ts, x, bad): the scored steps, with the 3-sigma rule."""
    base, now = points.where(F.col("age") >= FAULT_STEPS), points.where(F.col("age") < FAULT_STEPS)
    st = normalize.baseline_stats(base, ["id"], ["x"], floor=None)
    bad = F.abs(F.col("x") - F.col("x_mean")) > F.lit(SIGMA_K) * F.col("x_std")
    return now.join(st, "id", "left").select("id", "ts", "x", F.coalesce(bad, F.lit(False)).alias("bad"))


def _ranking(spark, sf_dir):
    flags = cut_lineage(_flags(_points(spark, sf_dir)))
    rates = cut_lineage(detect.flag_rates(flags.withColumnRenamed("id", "service_id"), "service_id", {"bad": "anomaly_rate"}))
    causal = _edges(spark, sf_dir).select(F.col("src").alias("a"), F.col("dst").alias("b"))
    chains = cut_lineage(service.causal_chains(rates, causal))
    return rates, chains, series_vs_total(flags, "id", "ts", "x")


@register("det5_planted_anomalies", sql=_sql("SELECT *, anomaly_type IS NOT NULL AS is_anomalous FROM piqr"))
def det5_planted_anomalies(spark, sf_dir):
    """DET5 (+AGG10) on the planted fault: High, Low and quiet series."""
    return _iqr(_points(spark, sf_dir))


@register("fn7_planted_labels", sql=_sql("""SELECT service, anomaly_type || ' (' || CAST(CAST(round(CAST(round(current_value, 8)
    AS DECIMAL(38,8)), 2) AS DOUBLE) AS VARCHAR) || ')' AS label FROM piqr WHERE anomaly_type IS NOT NULL"""))
def fn7_planted_labels(spark, sf_dir):
    """FN7: the labels of anomalous services."""
    now = F.round(F.round("current_value", 8), 2)
    return _iqr(_points(spark, sf_dir)).where("is_anomalous").select(
        "service", F.concat("anomaly_type", F.lit(" ("), now.cast("string"), F.lit(")")).alias("label"))


@register("fn6_planted_labels", sql=_sql("""SELECT id, ts, CASE WHEN bad THEN -1 ELSE 1 END AS label,
    CASE WHEN bad THEN 1 ELSE 0 END AS anomaly_multi FROM pflag"""))
def fn6_planted_labels(spark, sf_dir):
    """FN6: detector labels 1 / -1 mapped to 0 / 1."""
    label = F.when(F.col("bad"), F.lit(-1)).otherwise(F.lit(1))
    return _flags(_points(spark, sf_dir)).select("id", "ts", label.alias("label"),
                                                 F.when(label == -1, 1).when(label == 1, 0).alias("anomaly_multi"))


@register("flt5_planted_services", sql=_sql(f"""SELECT DISTINCT id FROM pp LEFT JOIN pst USING (id)
WHERE age < {FAULT_STEPS} AND (s IS NULL OR s = 0)"""))
def flt5_planted_services(spark, sf_dir):
    """FLT5: services without a z-score: one that never changes, one that is new."""
    p = _points(spark, sf_dir)
    st = normalize.baseline_stats(p.where(F.col("age") >= FAULT_STEPS), ["id"], ["x"], floor=None)
    z = p.where(F.col("age") < FAULT_STEPS).join(st, "id", "left").withColumn(
        "z", safe_div(F.col("x") - F.col("x_mean"), F.col("x_std")))
    return z.where("z IS NULL").select("id").distinct()


@register("rca7_planted_root_cause", sql=_sql("SELECT root_cause FROM proot"))
def rca7_planted_root_cause(spark, sf_dir):
    """RCA7 (+JN10, AGG14, TOP6): the anomalous service whose callees are well."""
    anomalous = _iqr(_points(spark, sf_dir)).where("is_anomalous").select(F.col("service").alias("id"))
    return graph.downstream_root_cause(anomalous, _edges(spark, sf_dir))


@register("viz4_planted_labels", sql=_sql("""SELECT id, CASE WHEN id IN (SELECT root_cause FROM proot) THEN 'root'
    WHEN id IN (SELECT id FROM panom) THEN 'symptom' ELSE 'normal' END AS status
FROM (SELECT caller AS id FROM ledge UNION SELECT callee FROM ledge UNION SELECT id FROM panom)"""))
def viz4_planted_labels(spark, sf_dir):
    """VIZ4: root, symptoms and normal vertices of the planted fault."""
    edges = _edges(spark, sf_dir)
    anomalous = cut_lineage(_iqr(_points(spark, sf_dir)).where("is_anomalous").select(F.col("service").alias("id")))
    return graph.graph_labels(anomalous, edges, graph.downstream_root_cause(anomalous, edges))


@register("viz4_edge_widths", sql=f"""WITH {_LINKED_LAGS}
SELECT caller AS src, callee AS dst, 'Corr=' || printf('%.2f', CAST(round(CAST(round(r, 8) AS DECIMAL(38,8)), 2) AS DOUBLE)) AS label,
       r * 5 AS width FROM ledge""")
def viz4_edge_widths(spark, sf_dir):
    """VIZ4: label and width of every edge of the inferred graph."""
    return graph.graph_edge_widths(_edges(spark, sf_dir))


@register("agg13_planted_summary", sql=_sql("""SELECT id AS service_id, avg(x) AS value_mean, avg(hour(ts)) AS hour_mean,
    bool_or(bad) AS is_anomaly FROM pflag GROUP BY id"""))
def agg13_planted_summary(spark, sf_dir):
    """AGG13 with the rule flag: mean value, mean hour, any anomaly."""
    return _flags(_points(spark, sf_dir)).groupBy(F.col("id").alias("service_id")).agg(
        F.avg("x").alias("value_mean"), F.avg(F.hour("ts")).alias("hour_mean"), F.bool_or("bad").alias("is_anomaly"))


@register("rca1_planted_chains", sql=_sql("SELECT service_id, array_to_string(chain, ' -> ') AS chain FROM pchain"))
def rca1_planted_chains(spark, sf_dir):
    """RCA1: chains from the five worst services; the fault's run through all
    linked series."""
    return _ranking(spark, sf_dir)[1].select("service_id", F.array_join("chain", " -> ").alias("chain"))


@register("rca2_planted_ranks", sql=_sql("SELECT service_id, rank_score FROM pranks WHERE rank_score IS NOT NULL"))
def rca2_planted_ranks(spark, sf_dir):
    """RCA2 (+JN8, AGG6): |corr with the total| x chain length."""
    rates, chains, total = _ranking(spark, sf_dir)
    return service.worst_services(rates, chains, total).where("rank_score IS NOT NULL").select("service_id", "rank_score")


@register("rca3_planted_services", sql=_sql("SELECT * FROM pworst"))
def rca3_planted_services(spark, sf_dir):
    """RCA3 (+JN4, TOP3): the ranked services with rate and chain."""
    return service.worst_services(*_ranking(spark, sf_dir))


@register("viz2_planted_bars", sql=_sql("SELECT service_id, anomaly_rate, rank_score FROM pworst"))
def viz2_planted_bars(spark, sf_dir):
    """VIZ2: bars of the planted ranking."""
    return service.worst_services(*_ranking(spark, sf_dir)).select("service_id", "anomaly_rate", "rank_score")


@register("snk1_planted_csv", sql=_sql("SELECT * FROM pworst"))
def snk1_planted_csv(spark, sf_dir):
    """SNK1: the ranking with its chains as CSV with header, read back."""
    from tracewise.plans.queries_io import _path
    path = _path(spark, "worst-csv")
    t = service.worst_services(*_ranking(spark, sf_dir))
    t.write.mode("overwrite").option("header", True).csv(path)
    return spark.read.schema(t.schema).option("header", True).csv(path)
