"""Sequence reconstruction anomalies per group (DET9, DET10).

Per group (server type): time split per server (first 70 % baseline),
min-max scaling with the baseline's per-group range, overlapping windows of
10 steps per server, a linear reconstructor (principal components of the
centred baseline windows), and per window the mean squared reconstruction
error.  Threshold = mean + 3 * population std of the baseline errors of the group.
The windows are materialised once.  One grouped aggregate gives the second
moments of all groups (window length x metrics squared numbers a group); their
eigenvectors are found on the driver, a small matrix per group, and broadcast for
scoring all groups in one pass.  The number of groups is small (a list of types).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.functions.columns import SIGMA_K
from tracewise.operators.features import sequences, split_by_fraction
from tracewise.operators.normalize import minmax_scale
from tracewise.session import cut_lineage


def _moments(group: str):
    def fn(batches):
        for pdf in batches:
            for g, part in pdf.groupby(group, sort=False):
                X = np.vstack(part["flat"].to_numpy()).astype(float)
                v = np.concatenate([[len(X)], X.sum(axis=0), (X.T @ X).ravel()])
                yield pd.DataFrame({"grp": str(g), "i": np.arange(len(v)), "v": v})
    return fn


def components(windows: DataFrame, group: str, k: int) -> dict:
    """{group: (mean, first k principal components)} of the ``flat`` vectors."""
    sums = windows.select(group, "flat").mapInPandas(_moments(group), "grp string, i int, v double") \
        .groupBy("grp", "i").agg(F.sum("v").alias("v")).toPandas()
    out = {}
    for g, part in sums.groupby("grp"):
        v = part.sort_values("i")["v"].to_numpy()
        d = int(round((np.sqrt(4 * len(v) - 3) - 1) / 2))
        mu = v[1:d + 1] / v[0]
        cov = v[d + 1:].reshape(d, d) / v[0] - np.outer(mu, mu)
        _, vec = np.linalg.eigh(cov)
        out[g] = (mu, vec[:, ::-1][:, :k])
    return out


def sequence_anomalies(df: DataFrame, group: str, entity: str, metrics: Sequence[str], ts: str = "ts",
                       length: int = 10, k: int = 4, fraction: float = 0.7) -> DataFrame:
    """Rows (group, entity, ts, phase, error, threshold, is_anomaly) for every
    window; ts is the window's first step."""
    metrics = list(metrics)
    x = split_by_fraction(df, [entity], ts, fraction)
    base = x.filter(F.col("phase") == "baseline")
    ranges = base.groupBy(group).agg(*[F.min(m).alias(f"{m}_min") for m in metrics],
                                     *[F.max(m).alias(f"{m}_max") for m in metrics])
    scaled = minmax_scale(x, [group], metrics, ranges)
    seqs = cut_lineage(sequences(scaled, [group, entity, "phase"], metrics, ts, length)
                       .select(group, entity, ts, "phase", F.flatten("seq").alias("flat")))
    models = components(seqs.filter(F.col("phase") == "baseline"), group, min(k, length * len(metrics)))
    bc = df.sparkSession.sparkContext.broadcast(models)

    @F.pandas_udf("double")
    def recon_error(grp: pd.Series, flat: pd.Series) -> pd.Series:
        res = np.full(len(grp), np.nan)
        names = grp.to_numpy()
        for g, (mu, p) in bc.value.items():
            at = np.flatnonzero(names == g)
            if len(at):
                X = np.vstack(flat.to_numpy()[at]).astype(float) - mu
                R = X - (X @ p) @ p.T
                res[at] = (R * R).mean(axis=1)
        return pd.Series(res)

    error = recon_error(F.col(group).cast("string"), "flat")
    out = cut_lineage(seqs.select(group, entity, ts, "phase", error.alias("error")).filter(~F.isnan("error")))
    thr = (out.filter(F.col("phase") == "baseline").groupBy(group)
           .agg((F.avg("error") + F.lit(SIGMA_K) * F.stddev_pop("error")).alias("threshold")))
    return (out.join(thr, group, "left")
            .withColumn("is_anomaly", (F.col("phase") == "current") & (F.col("error") > F.col("threshold"))))


def group_summary(scored: DataFrame, group: str) -> DataFrame:
    """DET10: per group threshold and number of anomalous current windows."""
    return (scored.filter(F.col("phase") == "current").groupBy(group)
            .agg(F.first("threshold").alias("threshold"), F.count_if("is_anomaly").alias("anomalies"),
                 F.count(F.lit(1)).alias("windows")))
