"""Rule detectors: three-sigma, IQR fences, rates and rankings
(DET4, DET5, AGG5, AGG10, TOP2-3, FLT4-5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.functions.columns import IQR_K, MIN_STD, SIGMA_K, floor_std


def flag_3sigma(df: DataFrame, stats: DataFrame, keys: Sequence[str], metrics: Sequence[str],
                diff_suffix: str = "_diff", delta_basis: str = "level",
                out: str = "sigma3", k: float = SIGMA_K) -> DataFrame:
    """DET4: ``|x - mean| > k*std`` or a jump ``|diff| > k*s``.

    ``delta_basis="level"`` (multi-metric form): s = baseline std of the
    metric.  ``delta_basis="diff"`` (single-metric form): s = std of the
    key's first differences in the scored data itself, floored.
    One ``<out>_<metric>`` 0/1 column per metric plus ``out`` = max of them.
    """
    keys = list(keys)
    j = df.join(stats, on=keys, how="left")
    if delta_basis == "diff":
        dstd = df.groupBy(*keys).agg(*[floor_std(F.stddev_samp(f"{m}{diff_suffix}"), MIN_STD)
                                        .alias(f"_{m}_dstd") for m in metrics])
        j = j.join(dstd, on=keys, how="left")
    flags = []
    for m in metrics:
        mean, std = F.col(f"{m}_mean"), F.col(f"{m}_std")
        level = F.abs(F.col(m) - mean) > F.lit(k) * std
        s = std if delta_basis == "level" else F.col(f"_{m}_dstd")
        jump = F.abs(F.col(f"{m}{diff_suffix}")) > F.lit(k) * s
        flags.append((F.coalesce(level, F.lit(False)) | F.coalesce(jump, F.lit(False)))
                     .cast("int").alias(f"{out}_{m}"))
    sel = [F.col(c) for c in df.columns] + flags
    res = j.select(*sel)
    if len(metrics) > 1:
        res = res.withColumn(out, F.greatest(*[F.col(f"{out}_{m}") for m in metrics]))
    else:
        res = res.withColumn(out, F.col(f"{out}_{metrics[0]}"))
    return res


def flag_rates(df: DataFrame, key: str, flags: dict[str, str]) -> DataFrame:
    """AGG5: mean of 0/1 (or boolean) flags per key, e.g. anomaly and sigma rate."""
    return df.groupBy(key).agg(*[F.avg(F.col(c).cast("double")).alias(a) for c, a in flags.items()])


def top_k(df: DataFrame, score: str, k: int, tie: str) -> DataFrame:
    """TOP2: the k highest scores, ties broken by name (the reference's sort
    is unstable).  A limit is the feature here."""
    return df.orderBy(F.col(score).desc_nulls_last(), F.col(tie)).limit(k)


def quartiles(df: DataFrame, keys: Sequence[str], value: str, exact: bool = True) -> DataFrame:
    """AGG10: Q1 and Q3 with linear interpolation (``exact``) or the
    mergeable sketch ``percentile_approx`` for very large groups."""
    if exact:
        q = F.percentile(value, F.array(F.lit(0.25), F.lit(0.75)))
    else:
        q = F.percentile_approx(value, F.array(F.lit(0.25), F.lit(0.75)), 10000)
    return (df.groupBy(*keys).agg(q.alias("_q"))
            .select(*keys, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("q3")))


def iqr_anomalies(df: DataFrame, keys: Sequence[str], value: str = "value", phase: str = "phase",
                  history: str = "history", current: str = "current", k: float = IQR_K) -> DataFrame:
    """DET5: current mean against ``[Q1 - k*IQR, Q3 + k*IQR]`` of history.

    One row per key (e.g. service, metric): q1, q3, ub, lb, current_value,
    anomaly_type High/Low/NULL and is_anomalous.  Quartiles and the current
    mean come from one aggregation pass with conditional inputs.
    """
    hist_v = F.when(F.col(phase) == history, F.col(value))
    cur_v = F.when(F.col(phase) == current, F.col(value))
    agg = (df.groupBy(*keys)
           .agg(F.percentile(hist_v, F.array(F.lit(0.25), F.lit(0.75))).alias("_q"),
                F.avg(cur_v).alias("current_value")))
    q1, q3 = F.col("_q")[0], F.col("_q")[1]
    iqr = q3 - q1
    ub, lb = q3 + F.lit(k) * iqr, q1 - F.lit(k) * iqr
    typ = (F.when(F.col("current_value") > ub, F.lit("High"))
           .when(F.col("current_value") < lb, F.lit("Low")))
    return agg.select(*keys, q1.alias("q1"), q3.alias("q3"), ub.alias("ub"), lb.alias("lb"),
                      "current_value", typ.alias("anomaly_type"),
                      typ.isNotNull().alias("is_anomalous"))


def min_rows(df: DataFrame, keys: Sequence[str], k: int, count_col: str | None = None) -> DataFrame:
    """FLT6: keep the rows of keys that have at least ``k`` rows (the
    reference skips detection below that).  Counted with a grouped
    aggregate and a semi join, so a large key is never gathered."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= k)
    if count_col:
        return df.join(counts.withColumnRenamed("_n", count_col), list(keys), "inner")
    return df.join(counts.select(*keys), list(keys), "left_semi")
