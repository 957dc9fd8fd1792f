"""Baseline statistics, z-scores and moments (AGG2-4, AGG11, DET1, DET3).

Stats are one row per key.  The join back onto the rows is a plain equi-join:
AQE sees the real size of the stats table after its shuffle and turns the
join into a broadcast when it is small, and keeps a shuffle join when the
key count is large, so no unchecked broadcast hint is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.functions.columns import MIN_STD, floor_std, safe_div


def baseline_stats(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
                   floor: float | None = MIN_STD) -> DataFrame:
    """AGG2/AGG3: per key mean and sample std (ddof 1) of every column in one
    pass; std floored at ``floor`` (NULL std stays NULL)."""
    aggs = []
    for c in cols:
        aggs.append(F.avg(c).alias(f"{c}_mean"))
        s = F.stddev_samp(c)
        aggs.append((floor_std(s, floor) if floor is not None else s).alias(f"{c}_std"))
    return df.groupBy(*keys).agg(*aggs)


def zscore(df: DataFrame, stats: DataFrame, keys: Sequence[str], cols: Sequence[str],
           prefix: str = "z_", fill: float | None = 0.0, keep_stats: bool = False) -> DataFrame:
    """DET1/DET3: ``z = (x - mean) / std`` with the key's baseline stats.

    A key absent from the stats (the reference raises) gets z = ``fill`` and
    ``is_new_key = true``; NULL z (single-row key, zero std) is ``fill``.
    """
    keys = list(keys)
    marked = stats.withColumn("_seen", F.lit(True))
    j = df.join(marked, on=keys, how="left")
    out = [F.col(c) for c in df.columns]
    for c in cols:
        z = safe_div(F.col(c) - F.col(f"{c}_mean"), F.col(f"{c}_std"))
        out.append((F.coalesce(z, F.lit(fill)) if fill is not None else z).alias(f"{prefix}{c}"))
    out.append(F.col("_seen").isNull().alias("is_new_key"))
    if keep_stats:
        for c in cols:
            out += [F.col(f"{c}_mean"), F.col(f"{c}_std")]
    return j.select(*out)


def fit_zscore(df: DataFrame, keys: Sequence[str], cols: Sequence[str], **kw):
    """Train mode of DET1: stats from ``df`` itself, then score ``df``."""
    stats = baseline_stats(df, keys, cols)
    return zscore(df, stats, keys, cols, **kw), stats


def moments(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """AGG4: mean, sample std, population skewness and excess kurtosis."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std"),
                 F.skewness(c).alias(f"{c}_skew"), F.kurtosis(c).alias(f"{c}_kurt")]
    return df.groupBy(*keys).agg(*aggs)


def minmax_scale(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
                 ranges: DataFrame | None = None) -> DataFrame:
    """AGG11: per-group min-max scaling; a constant column scales to 0.

    ``ranges`` (keys, c_min, c_max) lets scoring reuse the baseline scaler.
    """
    keys = list(keys)
    if ranges is None:
        ranges = df.groupBy(*keys).agg(*[F.min(c).alias(f"{c}_min") for c in cols],
                                       *[F.max(c).alias(f"{c}_max") for c in cols])
    j = df.join(ranges, on=keys, how="left")
    scaled = [F.coalesce(safe_div(F.col(c) - F.col(f"{c}_min"), F.col(f"{c}_max") - F.col(f"{c}_min")),
                         F.lit(0.0)).alias(c) for c in cols]
    return j.select(*[F.col(c) for c in df.columns if c not in cols], *scaled)
