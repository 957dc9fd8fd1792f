"""Updatable baseline statistics (JOB1, AGG2-4).

A period (a day) of points becomes one row per key and metric: count, mean and
the second to fourth central moment sums.  Such rows merge exactly, so the
baseline of any span is a small aggregate over the stored rows, and a new period
is folded in without reading the earlier points again.  Quantiles are kept as a
mergeable sketch per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.functions.columns import MIN_STD, floor_std

SKETCH_K = 200      # accuracy of the quantile sketch: exact up to so many points, then about 1.3 % in rank


def period_state(points: DataFrame, keys: Sequence[str], cols: Sequence[str], period: str) -> DataFrame:
    """(keys, metric, period, n, mean, m2, m3, m4, sketch) of the points;
    ``period`` is a column.  Nulls do not count."""
    x = points.select(*keys, period, F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("v")) for c in cols])).alias("s"))
    x = x.select(*keys, period, "s.metric", "s.v").where("v IS NOT NULL")
    g = x.groupBy(*keys, "metric", period).agg(
        F.count("v").alias("n"), F.avg("v").alias("mean"), F.var_pop("v").alias("_v"), F.skewness("v").alias("_s"),
        F.kurtosis("v").alias("_k"), F.kll_sketch_agg_double("v", F.lit(SKETCH_K)).alias("sketch"))
    m2 = F.col("_v") * F.col("n")
    # a constant has no skewness and no kurtosis, and its moments are zero
    m3 = F.coalesce(F.nanvl("_s", F.lit(0.0)), F.lit(0.0)) * F.col("n") * F.pow("_v", F.lit(1.5))
    m4 = F.when(F.col("_v") > 0, (F.col("_k") + 3) * F.col("n") * F.col("_v") * F.col("_v")).otherwise(0.0)
    return g.select(*keys, "metric", period, "n", "mean", m2.alias("m2"), m3.alias("m3"), m4.alias("m4"), "sketch")


def merged(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, metric, n, mean, m2, m3, m4) over all given state rows."""
    by = [*keys, "metric"]
    centre = states.groupBy(*by).agg(F.sum("n").alias("_n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_m"))
    j = states.join(centre, by)
    d, n, m2, m3, m4 = F.col("mean") - F.col("_m"), F.col("n"), F.col("m2"), F.col("m3"), F.col("m4")
    return j.groupBy(*by).agg(
        F.sum("n").alias("n"), F.first("_m").alias("mean"), F.sum(m2 + n * d * d).alias("m2"),
        F.sum(m3 + 3 * d * m2 + n * d * d * d).alias("m3"),
        F.sum(m4 + 4 * d * m3 + 6 * d * d * m2 + n * d * d * d * d).alias("m4"))


def statistics(state: DataFrame, keys: Sequence[str], floor: float | None = MIN_STD) -> DataFrame:
    """(keys, metric, n, mean, std, skew, kurt) as of AGG2 and AGG4: sample
    std (NULL for one point), population skewness and excess kurtosis."""
    var = F.col("m2") / F.col("n")
    std = F.when(F.col("n") > 1, F.sqrt(F.try_divide(F.col("m2"), F.col("n") - 1)))
    return state.select(*keys, "metric", "n", "mean", (floor_std(std, floor) if floor is not None else std).alias("std"),
                        F.try_divide(F.col("m3") / F.col("n"), F.pow(var, F.lit(1.5))).alias("skew"),
                        (F.try_divide(F.col("m4") / F.col("n"), var * var) - 3).alias("kurt"))


def wide_statistics(state: DataFrame, keys: Sequence[str], cols: Sequence[str], floor: float | None = MIN_STD) -> DataFrame:
    """The same as ``normalize.baseline_stats`` gives: <col>_mean, <col>_std."""
    st = statistics(state, keys, floor)
    return st.groupBy(*keys).agg(*[F.max(F.when(F.col("metric") == c, F.col(v))).alias(f"{c}_{v}")
                                   for c in cols for v in ("mean", "std")])


def quantiles(states: DataFrame, keys: Sequence[str], qs: Sequence[float]) -> DataFrame:
    """(keys, metric, q<percent>) from the merged sketches."""
    g = states.groupBy(*keys, "metric").agg(F.kll_merge_agg_double("sketch").alias("s"))
    return g.select(*keys, "metric", *[F.kll_sketch_get_quantile_double("s", F.lit(float(q))).alias(f"q{round(100 * q)}")
                                       for q in qs])
