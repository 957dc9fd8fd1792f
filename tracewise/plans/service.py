"""Service-metric jobs: learn the baseline, score the problem window, rank.

These compose the operators into the reference's train / predict flows
(single metric ``connection_count`` and the multi-metric form).  Each
function returns a lazy DataFrame; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewise.operators.detect import flag_3sigma, flag_rates, top_k
from tracewise.operators.features import add_features
from tracewise.operators.normalize import baseline_stats, zscore
from tracewise.sources.bindings import KEYS, METRICS, as_phases, with_service_id


def with_diffs(df: DataFrame, keys, metrics, ts: str = "ts") -> DataFrame:
    """First differences per key, NULL -> 0 (as after the reference's fillna)."""
    wk = Window.partitionBy(*keys).orderBy(ts)
    return df.select("*", *[F.coalesce(F.col(m) - F.lag(m).over(wk), F.lit(0.0)).alias(f"{m}_diff")
                            for m in metrics])


def sigma_flags_multi(points: DataFrame) -> DataFrame:
    """DET4 multi-metric: baseline stats from the baseline phase, flags on
    the problem phase."""
    base, prob = as_phases(points)
    stats = baseline_stats(base, KEYS, METRICS, floor=None)
    return flag_3sigma(with_diffs(prob, KEYS, METRICS), stats, KEYS, METRICS, delta_basis="level")


def sigma_flags_single(points: DataFrame, metric: str = "connection_count") -> DataFrame:
    """DET4 single-metric: level vs floored baseline std, jump vs the std of
    the key's differences in the scored window."""
    base, prob = as_phases(points)
    stats = baseline_stats(base, KEYS, [metric])
    return flag_3sigma(with_diffs(prob, KEYS, [metric]), stats, KEYS, [metric], delta_basis="diff")


def worst_services_by_sigma(points: DataFrame, k: int = 5) -> DataFrame:
    """Minimum slice: 3-sigma flags -> sigma rate per service -> top k."""
    flagged = with_service_id(sigma_flags_multi(points))
    rates = flag_rates(flagged, "service_id", {"sigma3": "sigma_rate"})
    return top_k(rates, "sigma_rate", k, "service_id")


FEATURES = ["connection_count", "rolling_mean", "diff", "rate_change", "over_max_count", "over_avg_count",
            "delta_max", "delta_avg", "ratio_avg", "conn_log"]


def raw_features(points: DataFrame, metric: str = "connection_count") -> DataFrame:
    """Features of the single-metric flow, before any normalisation."""
    return add_features(points, KEYS, [metric], naming="plain", log1p=True)


def scored_features(points: DataFrame, metric: str = "connection_count"):
    """Feature + z pipeline of the single-metric flow for both phases.

    Returns (baseline rows, problem rows) with raw features, ``conn_zscore``,
    ``conn_log`` and ``z_<feature>`` columns, all from baseline statistics.
    """
    base, prob = as_phases(points)
    fb, fp = raw_features(base, metric), raw_features(prob, metric)
    stats = baseline_stats(fb, KEYS, FEATURES)
    return zscore(fb, stats, KEYS, FEATURES), zscore(fp, stats, KEYS, FEATURES), FEATURES


def densify(series: DataFrame, id_col: str, step: str, value: str) -> DataFrame:
    """Zero-fill every id onto the full step grid (first to last step of the
    frame), as the reference's pivot + ``fillna(0)`` does; the grid is
    generated per id with ``sequence``."""
    lo = series.select(F.min(step)).scalar()
    hi = series.select(F.max(step)).scalar()
    grid = series.select(id_col).distinct().select(id_col, F.explode(F.sequence(lo, hi)).alias(step))
    return (grid.join(series.select(id_col, step, value), [id_col, step], "left")
            .fillna(0.0, subset=[value]))


def causal_chains(rates: DataFrame, causal: DataFrame, k: int = 5) -> DataFrame:
    """RCA1: from the k services with the highest anomaly rate, repeatedly step
    to the causal neighbour with the highest rate (ties by name); stop at a
    dead end or at the first revisit (the repeated node is kept).

    ``rates(service_id, anomaly_rate)``, ``causal(a, b)``: b causes a.
    The next hop is a function of the node, so each round is one small join.
    Chains never repeat a node before they stop, so the loop ends by itself.
    """
    from tracewise.operators.detect import top_k
    from tracewise.session import cut_lineage
    nr = rates.select(F.col("service_id").alias("b"), F.col("anomaly_rate").alias("rb"))
    nh = causal.select("a", "b").distinct().join(nr, "b", "inner")
    w = Window.partitionBy("a").orderBy(F.col("rb").desc(), F.col("b"))
    nh = cut_lineage(nh.withColumn("_k", F.row_number().over(w)).filter("_k = 1")
                     .select(F.col("a").alias("cur"), F.col("b").alias("next")))
    starts = top_k(rates, "anomaly_rate", k, "service_id")
    state = cut_lineage(starts.select(F.col("service_id").alias("start"), F.array("service_id").alias("chain"),
                                      F.col("service_id").alias("cur"), F.lit(True).alias("active")))
    while not (act := state.filter("active")).isEmpty():
        j = act.join(nh, "cur", "left")
        step_ = j.select("start",
                         F.when(F.col("next").isNull(), F.col("chain"))
                         .otherwise(F.concat("chain", F.array("next"))).alias("chain"),
                         F.coalesce("next", "cur").alias("cur"),
                         (F.col("next").isNotNull() & ~F.array_contains("chain", F.col("next"))).alias("active"))
        state = cut_lineage(state.filter(~F.col("active")).unionByName(step_))
    return state.select(F.col("start").alias("service_id"), "chain")


def worst_services(rates: DataFrame, chains: DataFrame, corr_total: DataFrame) -> DataFrame:
    """RCA2 + RCA3: ``rank_score = |corr(service, total)| * (chain length or 1)``
    for services present at every timestamp, joined (full) with the rates;
    best first."""
    ranks = (corr_total.join(chains, corr_total.id == chains.service_id, "left")
             .select(F.col("id").alias("service_id"),
                     (F.abs("corr_total") * F.coalesce(F.size("chain"), F.lit(1))).alias("rank_score")))
    return (rates.join(ranks, "service_id", "full").join(chains, "service_id", "left")
            .select("service_id", *[c for c in rates.columns if c != "service_id"], "rank_score",
                    F.array_join("chain", " -> ").alias("chain"))
            .orderBy(F.col("rank_score").desc_nulls_last(), "service_id"))


def multi_metric_features(points: DataFrame):
    """Multi-metric flow (V2): z of each metric with baseline stats, the
    engineered features of every metric, and all 27 features z-normalised
    again with baseline stats (``z_<metric>_<feature>``, ``z_z_<metric>``).
    Returns (baseline rows, problem rows, z feature names)."""
    from tracewise.operators.features import FEATURES
    base, prob = as_phases(points)
    st = baseline_stats(base, KEYS, METRICS, floor=None)
    zb = zscore(base, st, KEYS, METRICS, prefix="z_").drop("is_new_key")
    zp = zscore(prob, st, KEYS, METRICS, prefix="z_").drop("is_new_key")
    fb = add_features(zb, KEYS, METRICS, calendar=False)
    fp = add_features(zp, KEYS, METRICS, calendar=False)
    feats = [f"{m}_{f}" for m in METRICS for f in FEATURES] + [f"z_{m}" for m in METRICS]
    st2 = baseline_stats(fb, KEYS, feats, floor=None)
    zzb = zscore(fb, st2, KEYS, feats, prefix="z_")
    zzp = zscore(fp, st2, KEYS, feats, prefix="z_")
    return zzb, zzp, [f"z_{f}" for f in feats]
