"""Rolling, lagged and block features per key (WIN1-13, DET2, FN1-2).

All features of all metrics are written in a few ``select`` stages over one
window spec ``partitionBy(keys).orderBy(ts)``, so Spark plans one exchange on
the keys and one sort; the frames differ, the ordering is shared.

pandas' ``rolling(n)`` is NULL until n rows exist while Spark frames yield
partial results, so every rolling value is guarded by its row count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewise.functions.columns import safe_div, weekday_mon0

SHORT_WINDOW = 5    # rolling_mean
LONG_WINDOW = 10    # rolling max / mean, blocks, deltas

FEATURES = ["rolling_mean", "diff", "rate_change", "over_max_count", "over_avg_count",
            "delta_max", "delta_avg", "ratio_avg"]


def _guarded(agg, c, w, n):
    return F.when(F.count(c).over(w) == n, agg(c).over(w))


def add_features(df: DataFrame, keys: Sequence[str], metrics: Sequence[str], ts: str = "ts",
                 window: int = LONG_WINDOW, short: int = SHORT_WINDOW,
                 naming: str = "suffix", fill: float | None = 0.0,
                 calendar: bool = True, log1p: bool = False, block_scope: str = "key") -> DataFrame:
    """DET2: engineered features for each metric.

    ``block_scope="key"`` counts rows above the previous rolling max / mean
    per key and block of ``window`` rows; ``"all"`` sums each block number
    over all keys (the reference groups by block number only), computed as
    a ``groupBy(block)`` aggregate joined back, never a single-partition
    window.

    ``naming="suffix"`` gives ``<metric>_<feature>`` (multi-metric form);
    ``naming="plain"`` gives ``<feature>`` (single metric form, one metric).
    """
    keys = list(keys)
    wk = Window.partitionBy(*keys).orderBy(ts)
    name = (lambda m, f: f"{m}_{f}") if naming == "suffix" else (lambda m, f: f)

    # stage 1: ordinals, lags, rolling aggregates (one Window node)
    s1 = [F.col(c) for c in df.columns]
    s1.append((F.row_number().over(wk) - 1).alias("_ord"))
    for m in metrics:
        s1 += [
            _guarded(F.avg, m, wk.rowsBetween(-(short - 1), 0), short).alias(name(m, "rolling_mean")),
            F.lag(m).over(wk).alias(f"_{m}_prev"),
            _guarded(F.max, m, wk.rowsBetween(-(window - 1), 0), window).alias(f"_{m}_rmax"),
            _guarded(F.avg, m, wk.rowsBetween(-(window - 1), 0), window).alias(f"_{m}_rmean"),
        ]
    x = df.select(*s1)

    # stage 2: lags of the rolling values (same spec, no new exchange)
    s2 = [F.col(c) for c in x.columns]
    for m in metrics:
        rmax, rmean = F.col(f"_{m}_rmax"), F.col(f"_{m}_rmean")
        prev_rmax, prev_rmean = F.lag(rmax).over(wk), F.lag(rmean).over(wk)
        s2 += [
            (F.col(m) - F.col(f"_{m}_prev")).alias(name(m, "diff")),
            safe_div(F.col(m) - F.col(f"_{m}_prev"), F.col(f"_{m}_prev")).alias(name(m, "rate_change")),
            F.coalesce(F.col(m) > prev_rmax, F.lit(False)).cast("int").alias(f"_{m}_gmax"),
            F.coalesce(F.col(m) > prev_rmean, F.lit(False)).cast("int").alias(f"_{m}_gavg"),
            (rmax - F.lag(rmax, window).over(wk)).alias(name(m, "delta_max")),
            (rmean - F.lag(rmean, window).over(wk)).alias(name(m, "delta_avg")),
            safe_div(F.col(m), prev_rmean).alias(name(m, "ratio_avg")),
        ]
    y = x.select(*s2)

    # stage 3: per-block counts (keys + block extend the existing clustering)
    block = F.floor(F.col("_ord") / window)
    y = y.withColumn("_block", block)
    wb = Window.partitionBy(*keys, "_block")
    if block_scope == "all":
        totals = y.groupBy("_block").agg(*[F.sum(f"_{m}_g{k}").alias(f"_{m}_t{k}")
                                           for m in metrics for k in ("max", "avg")])
        y = y.join(totals, "_block", "left")

    def block_count(m, k):
        if block_scope == "all":
            return F.col(f"_{m}_t{k}").cast("double")
        return F.sum(f"_{m}_g{k}").over(wb).cast("double")

    s3 = [F.col(c) for c in df.columns]
    feats = []
    for m in metrics:
        s3 += [block_count(m, "max").alias(name(m, "over_max_count")),
               block_count(m, "avg").alias(name(m, "over_avg_count"))]
        s3 += [F.col(name(m, f)) for f in FEATURES if f not in ("over_max_count", "over_avg_count")]
        feats += [name(m, f) for f in FEATURES]
        if log1p:
            s3.append(F.log1p(m).alias(name(m, "log") if naming == "suffix" else "conn_log"))
    if calendar:
        s3 += [F.hour(ts).alias("hour"), weekday_mon0(ts).alias("day_of_week")]
    z = y.select(*s3)
    if fill is not None:
        z = z.fillna(fill, subset=feats)
    # fixed column order: inputs, then features in FEATURES order per metric
    ordered = list(df.columns)
    for m in metrics:
        ordered += [name(m, f) for f in FEATURES]
        if log1p:
            ordered.append(name(m, "log") if naming == "suffix" else "conn_log")
    if calendar:
        ordered += ["hour", "day_of_week"]
    return z.select(*ordered)


def rolling(df: DataFrame, keys: Sequence[str], metric: str, ts: str = "ts", window: int = LONG_WINDOW) -> DataFrame:
    """WIN4: trailing max and mean over ``window`` rows, NULL until full."""
    wk = Window.partitionBy(*keys).orderBy(ts).rowsBetween(-(window - 1), 0)
    return df.select(*keys, ts, _guarded(F.max, metric, wk, window).alias("rolling_max"),
                     _guarded(F.avg, metric, wk, window).alias("rolling_mean"))


def sequences(df: DataFrame, keys: Sequence[str], metrics: Sequence[str], ts: str = "ts",
              length: int = LONG_WINDOW) -> DataFrame:
    """WIN11: overlapping windows of ``length`` rows, stride 1; the final
    window (no row ``length`` ahead) is dropped as in the reference."""
    wk = Window.partitionBy(*keys).orderBy(ts)
    frame = wk.rowsBetween(0, length - 1)
    return (df.select(*keys, ts,
                      F.collect_list(F.array(*[F.col(m).cast("double") for m in metrics])).over(frame).alias("seq"),
                      F.lead(ts, length).over(wk).alias("_next"))
            .filter(F.col("_next").isNotNull())
            .drop("_next"))


def split_by_fraction(df: DataFrame, keys: Sequence[str], ts: str = "ts",
                      fraction: float = 0.7) -> DataFrame:
    """WIN12: ``phase`` = baseline for the first ``fraction`` of each key's rows
    in time order, else current."""
    wk = Window.partitionBy(*keys).orderBy(ts)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return df.withColumn(
        "phase", F.when(F.row_number().over(wk) <= F.floor(n * fraction), F.lit("baseline"))
        .otherwise(F.lit("current")))


def split_last_n(df: DataFrame, keys: Sequence[str], ts: str = "ts", n: int = 20) -> DataFrame:
    """WIN12 (second form): the last ``n`` rows of each key are current."""
    wk = Window.partitionBy(*keys).orderBy(F.col(ts).desc())
    return df.withColumn("phase", F.when(F.row_number().over(wk) <= n, F.lit("current"))
                         .otherwise(F.lit("history")))
