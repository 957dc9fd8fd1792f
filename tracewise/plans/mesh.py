"""Mesh reports over call-edge counters (PQL9, RCA9, TOP5, AGG12).

Time parameters are scaled to the data's density: the reference evaluates
``[5m]`` ranges every minute over 30 s scrapes; the driver data has about one
call per edge and hour, so ranges are 6 h evaluated every 3 h over an hourly
scrape grid, and the 1 h baseline sub-query becomes 1 day.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewise.operators import promql
from tracewise.session import cut_lineage
from tracewise.sources.bindings import BUCKETS, DURATION_SUM, duration_counters, hourly_edge_stats, requests_total

EDGE = ["src", "dst"]


@dataclass(frozen=True)
class MeshParams:
    range_: str = "6 hours"       # rate range (reference: 5m / 1m)
    step: str = "3 hours"         # evaluation step (reference: 1m)
    step_seconds: int = 3 * 3600
    baseline_seconds: int = 24 * 3600   # avg_over_time range (reference: 1h)
    quantile: float = 0.95
    ratio_factor: float = 2.0     # latency_now > factor * latency_avg


P = MeshParams()


def counters_for(spark, sf_dir: str) -> DataFrame:
    """Hourly edge stats of the driver tables (call edges -> one aggregate)."""
    from tracewise.sources.bindings import edge_points
    return mesh_counters(edge_points(spark, sf_dir))


def mesh_counters(edges: DataFrame) -> DataFrame:
    """The hourly per-edge stats behind every counter, materialised once
    (reliable checkpoint) so the raw edges are scanned a single time."""
    return cut_lineage(hourly_edge_stats(edges))


def request_rates(hourly: DataFrame, p: MeshParams = P) -> DataFrame:
    return promql.increase_and_rate(requests_total(hourly), [*EDGE, "response_code"], p.range_, p.step)


def rps(hourly: DataFrame, p: MeshParams = P) -> DataFrame:
    """``sum(rate(requests_total[R])) by (src, dst)``."""
    return promql.sum_by(request_rates(hourly, p), EDGE, "rate", "rps")


def request_summary(hourly: DataFrame, p: MeshParams = P) -> DataFrame:
    """rps and 5xx share per edge and step from one aggregation over the
    request rates (``error_rate`` is NULL where no 5xx series exists, as in
    the PromQL vector ratio)."""
    r = request_rates(hourly, p)
    is5xx = F.col("response_code").rlike("^5..$")
    return (r.groupBy("ts", *EDGE)
            .agg(F.sum("rate").alias("rps"), F.sum(F.when(is5xx, F.col("rate"))).alias("_num"))
            .select("ts", *EDGE, "rps", F.try_divide("_num", "rps").alias("error_rate")))


def error_rate(hourly: DataFrame, p: MeshParams = P) -> DataFrame:
    """5xx share of the request rate per edge (PQL4)."""
    return promql.vector_ratio(request_rates(hourly, p), EDGE,
                               F.col("response_code").rlike("^5..$"), "rate", "error_rate")


def duration_rates(hourly: DataFrame, p: MeshParams = P) -> DataFrame:
    """Rates of all latency buckets and of the latency sum, one row per edge
    and step."""
    return promql.increase_and_rate_columns(duration_counters(hourly), EDGE, [*BUCKETS, DURATION_SUM], p.range_, p.step)


def _quantile(rates: DataFrame, q: float, out: str) -> DataFrame:
    return promql.histogram_quantile_columns(rates, q, EDGE, {f"{c}_rate": le for c, le in BUCKETS.items()}, out)


def latency_quantile(hourly: DataFrame, p: MeshParams = P, q: float | None = None,
                     out: str = "latency_ms") -> DataFrame:
    """``histogram_quantile(q, sum(rate(bucket[R])) by (le, src, dst))``."""
    return _quantile(duration_rates(hourly, p), q if q is not None else p.quantile, out)


def mean_latency(hourly: DataFrame, p: MeshParams = P, rates: DataFrame | None = None) -> DataFrame:
    """``sum(rate(duration_sum[R])) / sum(rate(requests_total[R]))`` by edge."""
    s = duration_rates(hourly, p) if rates is None else rates
    c = rps(hourly, p)
    return (s.select("ts", *EDGE, F.col(f"{DURATION_SUM}_rate").alias("sum_rate")).join(c, on=["ts", *EDGE], how="inner")
            .select("ts", *EDGE, F.try_divide("sum_rate", "rps").alias("mean_latency"))
            .filter(F.col("mean_latency").isNotNull()))


def service_health(hourly: DataFrame, p: MeshParams = P) -> DataFrame:
    """PQL9: rps, error rate (missing -> 0, left join) and P95 latency per
    edge and evaluation time; latency inner-joined with health."""
    health = request_summary(hourly, p).fillna(0.0, subset=["error_rate"])
    lat = latency_quantile(hourly, p)
    return lat.join(health, on=["ts", *EDGE], how="inner").select(
        "ts", *EDGE, "latency_ms", "rps", "error_rate")


def latency_report(hourly: DataFrame, p: MeshParams = P) -> DataFrame:
    """RCA9: P95 now against the 1-day mean of the mean latency; 2x flag."""
    rates = cut_lineage(duration_rates(hourly, p))   # edges x steps, read twice
    now = _quantile(rates, p.quantile, "latency_now")
    base = promql.avg_over_time(mean_latency(hourly, p, rates), EDGE, "mean_latency",
                                p.baseline_seconds, p.step_seconds, out="latency_avg")
    j = now.join(base, on=["ts", *EDGE], how="inner")
    return j.withColumn("is_anomaly", F.col("latency_now") > F.lit(p.ratio_factor) * F.col("latency_avg"))


def busiest_destination(hourly: DataFrame, p: MeshParams = P) -> DataFrame:
    """TOP5: ``topk(1, sum(rate(requests_total[R])) by (dst))`` per
    evaluation time; ties (equal up to float summation noise, compared at
    12 decimals) by name."""
    by_dst = promql.sum_by(request_rates(hourly, p), ["dst"], "rate", "rps")
    w = Window.partitionBy("ts").orderBy(F.round("rps", 12).desc(), F.col("dst"))
    return by_dst.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def discover_edges(hourly: DataFrame) -> DataFrame:
    """AGG12 / PQL6: edges whose request counter increased over the scanned
    range (one aggregation instead of N^2 existence queries)."""
    inc = promql.total_increase(requests_total(hourly), [*EDGE, "response_code"], EDGE)
    return inc.filter(F.col("increase") > 0)
