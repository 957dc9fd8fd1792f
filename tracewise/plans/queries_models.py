"""Registered queries backed by models: isolation forest, Granger, PCA
sequences, one-class boundary.  These are not SQL-expressible; they are
checked by row counts here and by planted-fault unit tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewise.operators import forest
from tracewise.plans import mesh, service
from tracewise.registry import register
from tracewise.session import cut_lineage
from tracewise.sources.bindings import KEYS, metric_phases, with_service_id

Z_FEATS = [f"z_{f}" for f in ["connection_count", "rolling_mean", "diff", "rate_change", "over_max_count",
                              "over_avg_count", "delta_max", "delta_avg", "ratio_avg", "conn_log"]] + [
    "hour", "day_of_week"]


def _key(df):
    return df.withColumn("_key", F.concat_ws("|", *KEYS, F.col("ts").cast("string")))


def scored_services(spark, sf_dir, contamination=0.01, points=None):
    """Single-metric flow: features -> z -> forest fit on baseline -> score
    the problem window (s, decision, is_outlier, is_anomaly).  ``points``:
    the two phases, where the caller has them."""
    zb, zp, _ = service.scored_features(metric_phases(spark, sf_dir) if points is None else points)
    # fit, offset and scoring all read these: materialise once (small: one row
    # per service and bucket)
    zb, zp = cut_lineage(_key(zb)), cut_lineage(_key(zp))
    nodes = cut_lineage(forest.fit(zb, ["_key"], Z_FEATS, seed=42))
    train = cut_lineage(forest.score(zb, nodes, Z_FEATS))
    q = forest.offset(train, contamination)
    return forest.label(forest.score(zp, nodes, Z_FEATS), q)


@register("det6_forest_fit")
def det6_forest_fit(spark, sf_dir):
    """DET6: isolation forest nodes (100 trees, <= 256 rows each, seed 42)."""
    zb, _, _ = service.scored_features(metric_phases(spark, sf_dir))
    return forest.fit(_key(zb), ["_key"], Z_FEATS, seed=42)


@register("det7_forest_score")
def det7_forest_score(spark, sf_dir):
    """DET7 (+FN6): isolation score, decision value and labels of the problem rows."""
    s = scored_services(spark, sf_dir)
    return s.select(*KEYS, "ts", "anomaly_score", "decision", "is_outlier", "is_anomaly",
                    F.col("is_outlier").cast("int").alias("anomaly_multi"))


@register("agg5_anomaly_rates")
def agg5_anomaly_rates(spark, sf_dir):
    """AGG5: anomaly rate (forest) and sigma rate per service."""
    s = with_service_id(scored_services(spark, sf_dir))
    sig = with_service_id(service.sigma_flags_single(metric_phases(spark, sf_dir)))
    rates = s.groupBy("service_id").agg(F.avg(F.col("is_outlier").cast("double")).alias("anomaly_rate"))
    srates = sig.groupBy("service_id").agg(F.avg(F.col("sigma3").cast("double")).alias("sigma_rate"))
    return rates.join(srates, "service_id", "full")


def _health_frame(spark, sf_dir):
    """(ts, src, dst, latency_ms, error_rate) with errors left-joined (JN3);
    materialised: fits and scores read it several times."""
    e = mesh.counters_for(spark, sf_dir)
    lat = mesh.latency_quantile(e)
    err = mesh.error_rate(e)
    return cut_lineage(lat.join(err, on=["ts", "src", "dst"], how="left").fillna(0.0, subset=["error_rate"])
                       .withColumn("_key", F.concat_ws("|", "src", "dst", F.col("ts").cast("string"))))


def _labelled(frame, feats, contamination):
    """Forest fitted on a frame and its own rows scored, each once."""
    nodes = cut_lineage(forest.fit(frame, ["_key"], feats, seed=42))
    s = cut_lineage(forest.score(frame, nodes, feats))
    return forest.label(s, forest.offset(s, contamination))


@register("rca8_anomalous_minutes")
def rca8_anomalous_minutes(spark, sf_dir):
    """RCA8 (+JN3, AGG8, TOP4): per edge, how many evaluation steps the
    forest (contamination 0.05) labels anomalous, most first."""
    h = _health_frame(spark, sf_dir)
    lab = _labelled(h, ["latency_ms", "error_rate"], 0.05)
    return (lab.filter(F.col("is_outlier")).groupBy("src", "dst")
            .agg(F.count(F.lit(1)).alias("anomalous_minutes_count"))
            .orderBy(F.col("anomalous_minutes_count").desc(), "src", "dst"))


@register("det16_guarded_outliers")
def det16_guarded_outliers(spark, sf_dir):
    """DET16 (+FLT6, FLT1, TOP4): (latency, error) outliers per edge at the
    newest step, only when at least 5 rows exist; slowest first."""
    h = _health_frame(spark, sf_dir)
    end = h.select(F.max("ts")).scalar()
    now = h.filter(F.col("ts") == end)
    n = now.count()
    if n < 5:
        return now.select("src", "dst", "latency_ms", "error_rate").limit(0)
    lab = _labelled(now, ["latency_ms", "error_rate"], 0.1)
    return (lab.filter(F.col("is_outlier")).select("src", "dst", "latency_ms", "error_rate")
            .orderBy(F.col("latency_ms").desc(), "src", "dst"))


# ---------------------------------------------------------------- causality

def directions_of(base, corr):
    """COR3 of baseline points for the pairs over the threshold in ``corr``."""
    from tracewise.operators import granger
    from tracewise.operators.correlate import corr_graph, with_step_index
    from tracewise.functions.columns import CORR_THRESHOLD
    s = with_service_id(base).select(F.col("service_id").alias("id"), "ts", F.col("connection_count").alias("x"))
    series = service.densify(with_step_index(s, "ts", 6 * 3600), "id", "step", "x")
    return granger.granger(series, corr_graph(corr, CORR_THRESHOLD), maxlag=5)


def directions(spark, sf_dir, base=None):
    from tracewise.operators.correlate import corr_matrix
    base = cut_lineage(metric_phases(spark, sf_dir)[0]) if base is None else base
    s = with_service_id(base).select(F.col("service_id").alias("id"), "ts", F.col("connection_count").alias("x"))
    return directions_of(base, corr_matrix(s, "id", "ts", "x", 6 * 3600))


@register("cor3_granger_directions")
def cor3_granger_directions(spark, sf_dir):
    """COR3: Granger direction for every pair of the |r| > 0.7 graph."""
    return directions(spark, sf_dir)


def _chains(spark, sf_dir, points=None):
    points = tuple(cut_lineage(p) for p in metric_phases(spark, sf_dir)) if points is None else points
    rates = cut_lineage(with_service_id(scored_services(spark, sf_dir, points=points)).groupBy("service_id")
                        .agg(F.avg(F.col("is_outlier").cast("double")).alias("anomaly_rate")))
    causal = directions(spark, sf_dir, points[0]).filter("causes")
    return rates, service.causal_chains(rates, causal)


@register("rca1_propagation_chains")
def rca1_propagation_chains(spark, sf_dir):
    """RCA1: greedy propagation chains from the 5 most anomalous services."""
    _, chains = _chains(spark, sf_dir)
    return chains.select("service_id", F.array_join("chain", " -> ").alias("chain"))


@register("rca3_worst_services")
def rca3_worst_services(spark, sf_dir):
    """RCA2 + RCA3 (JOB2, VIZ2, JN4, TOP3): rates, rank score and chain."""
    from tracewise.operators.correlate import series_vs_total
    # both phases once: features, flags, correlations and totals all read them
    points = tuple(cut_lineage(p) for p in metric_phases(spark, sf_dir))
    rates, chains = _chains(spark, sf_dir, points)
    prob = points[1]
    sig = with_service_id(service.sigma_flags_single(points))
    srates = sig.groupBy("service_id").agg(F.avg(F.col("sigma3").cast("double")).alias("sigma_rate"))
    s = with_service_id(prob).select(F.col("service_id").alias("id"), "ts", F.col("connection_count").alias("x"))
    ct = series_vs_total(s, "id", "ts", "x")
    return service.worst_services(rates.join(srates, "service_id", "full"), chains, ct)


# ---------------------------------------------------------------- sequences

def _sequence_scores(spark, sf_dir):
    from tracewise.operators.sequence import sequence_anomalies
    from tracewise.sources.bindings import server_points
    srv = server_points(spark, sf_dir)
    return sequence_anomalies(srv, "type", "server_id", ["cpu_us", "cpu_sy", "mem_free", "io_bi"])


@register("det9_sequence_anomalies")
def det9_sequence_anomalies(spark, sf_dir):
    """DET9 (+WIN11, WIN12, AGG11, SET2): 10-step windows per server,
    reconstruction error against a per-type threshold."""
    return _sequence_scores(spark, sf_dir)


@register("det10_group_summary")
def det10_group_summary(spark, sf_dir):
    """DET10: threshold and anomaly count per server type."""
    from tracewise.operators.sequence import group_summary
    return group_summary(_sequence_scores(spark, sf_dir), "type")


# ---------------------------------------------------------- multi-metric flow

def _multi(spark, sf_dir, points=None):
    zb, zp, zf = service.multi_metric_features(metric_phases(spark, sf_dir) if points is None else points)
    return cut_lineage(_key(zb)), cut_lineage(_key(zp)), zf


@register("det8_oneclass_boundary")
def det8_oneclass_boundary(spark, sf_dir):
    """DET8 (+FN6): one-class boundary (nu = 0.01, RBF gamma = 1/27 via
    random Fourier features) on the 27 z-features; decision and label."""
    from tracewise.operators import oneclass
    zb, zp, zf = _multi(spark, sf_dir)
    model = oneclass.fit(zb, zf, nu=0.01)
    return oneclass.score(zp, model, zf).select(*KEYS, "ts", "score_multi", "anomaly_multi")


@register("rca3_worst_services_multi")
def rca3_worst_services_multi(spark, sf_dir):
    """Multi-metric ranking: forest on the 27 z-features (anomaly rate), 3-sigma
    rate over three metrics, qps correlation graph + Granger chains, rank by
    |corr(eps, total eps)| x chain length."""
    from tracewise.operators import granger
    from tracewise.operators.correlate import corr_graph, corr_matrix, series_vs_total, with_step_index
    from tracewise.functions.columns import CORR_THRESHOLD
    pts = tuple(cut_lineage(p) for p in metric_phases(spark, sf_dir))
    zb, zp, zf = _multi(spark, sf_dir, pts)
    nodes = cut_lineage(forest.fit(zb, ["_key"], zf, seed=42))
    train = cut_lineage(forest.score(zb, nodes, zf))
    lab = forest.label(forest.score(zp, nodes, zf), forest.offset(train, 0.01))
    rates = (with_service_id(lab).groupBy("service_id")
             .agg(F.avg(F.col("is_outlier").cast("double")).alias("anomaly_rate")))
    sig = with_service_id(service.sigma_flags_multi(pts))
    srates = sig.groupBy("service_id").agg(F.avg(F.col("sigma3").cast("double")).alias("sigma_rate"))
    base, prob = pts
    qb = with_service_id(base).select(F.col("service_id").alias("id"), "ts", F.col("qps").alias("x"))
    pairs = corr_graph(corr_matrix(qb, "id", "ts", "x", 6 * 3600), CORR_THRESHOLD)
    dense = service.densify(with_step_index(qb, "ts", 6 * 3600), "id", "step", "x")
    causal = granger.granger(dense, pairs).filter("causes")
    chains = service.causal_chains(rates, causal)
    ep = with_service_id(prob).select(F.col("service_id").alias("id"), "ts", F.col("eps").alias("x"))
    ct = series_vs_total(ep, "id", "ts", "x")
    return service.worst_services(rates.join(srates, "service_id", "full"), chains, ct)
