"""One-class boundary (DET8): random Fourier features + distributed
sub-gradient, an approximation of the RBF one-class SVM.

Features x are mapped by ``phi(x) = sqrt(2/D) cos(x W + b)`` with
``W ~ N(0, 2 gamma)`` and ``b ~ U(0, 2 pi)`` (D = 256, seeded), which
approximates the RBF kernel ``exp(-gamma |x - y|^2)``.  The nu-objective

    1/2 |w|^2 - rho + 1/(nu n) * sum_i max(0, rho - w . phi(x_i))

is minimised by full-batch sub-gradient steps, so the result does not depend
on how the rows are partitioned.  rho is set each round to its optimum for that w,
the exact nu-quantile of the training scores.  A round takes two passes over
the rows: one counts the scores in bins (more than one only while the bin of
the quantile holds over FEW rows), and one sums phi over the rows below that bin
and fetches the few rows in it.  These give the quantile and, at the same
time, the sum over the rows that violate the margin, i.e. the next step.  Per
round the driver sees the counts, D sums and at most FEW rows.
Decision value ``w . phi(x) - rho``; negative = outlier.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.session import cut_lineage

BINS = 4096
FEW = 512


@dataclass
class OneClassModel:
    W: np.ndarray
    b: np.ndarray
    w: np.ndarray
    rho: float

    def phi(self, X: np.ndarray) -> np.ndarray:
        D = self.W.shape[1]
        return np.sqrt(2.0 / D) * np.cos(X @ self.W + self.b)

    def decision(self, X: np.ndarray) -> np.ndarray:
        return self.phi(X) @ self.w - self.rho


def _phi(pdf: pd.DataFrame, features, W, b) -> np.ndarray:
    return np.sqrt(2.0 / W.shape[1]) * np.cos(pdf[features].to_numpy(dtype=float) @ W + b)


def _bin_counts(features, state, lo: float, hi: float):
    """Scores counted in BINS bins of [lo, hi]; bin -1 holds the lower ones."""
    def fn(batches):
        W, b, w = state.value
        for pdf in batches:
            s = _phi(pdf, features, W, b) @ w
            at = np.floor((s - lo) * (BINS / (hi - lo))).clip(-1, BINS).astype(np.int64)
            at[s == hi] = BINS - 1
            bins, counts = np.unique(at, return_counts=True)
            yield pd.DataFrame({"bin": bins, "n": counts})
    return fn


def _sums_below(features, state, lo: float, hi: float):
    """Row -1: count and sum of phi over the scores below ``lo``; then phi of
    every row with a score in [lo, hi]."""
    def fn(batches):
        W, b, w = state.value
        for pdf in batches:
            P = _phi(pdf, features, W, b)
            s = P @ w
            below = s < lo
            yield pd.DataFrame({"kind": [-1], "score": [float(below.sum())], "phi": [P[below].sum(axis=0)]})
            inside = np.flatnonzero((s >= lo) & (s <= hi))
            if len(inside):
                yield pd.DataFrame({"kind": 0, "score": s[inside], "phi": list(P[inside])})
    return fn


def _summed(rows: DataFrame, D: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(count below, sum below, scores, phis) of the rows of _sums_below."""
    rows = cut_lineage(rows)
    sums = rows.where("kind = -1").select("score", F.posexplode("phi")).groupBy("pos").agg(
        F.sum("col").alias("s"), F.sum("score").alias("n")).collect()
    total = np.zeros(D)
    for r in sums:
        total[r["pos"]] = r["s"]
    near = sorted(((r["score"], tuple(r["phi"])) for r in rows.where("kind = 0").collect()))
    return (int(sums[0]["n"]) if sums else 0, total, np.array([x[0] for x in near]),
            np.array([x[1] for x in near]).reshape(-1, D))


def _quantile_round(data: DataFrame, features, model: tuple, nu: float, n: int, span: tuple) -> tuple:
    """(rho, sum of phi over the rows below rho, range of the scores) for w."""
    W, b, w = model
    sc = data.sparkSession.sparkContext
    state = sc.broadcast(model)
    at = nu * (n - 1)
    ranks = (math.floor(at), min(math.floor(at) + 1, n - 1))
    # no score lies outside the bound, whatever the rows
    bound = np.sqrt(2.0 / len(w)) * np.abs(w).sum() + 1e-12
    lo, hi = max(span[0], -bound), min(span[1], bound)
    if lo >= hi:
        lo, hi = -bound, bound
    while True:
        counts = {r["bin"]: r["n"] for r in data.mapInPandas(_bin_counts(features, state, lo, hi), "bin long, n long")
                  .groupBy("bin").agg(F.sum("n").alias("n")).collect()}
        below, held = counts.get(-1, 0), []
        if not below <= ranks[0] or ranks[1] >= n - counts.get(BINS, 0):  # outside the guessed range
            lo, hi = -bound, bound
            continue
        for k in range(BINS):
            m = counts.get(k, 0)
            if m and below <= ranks[1] and below + m > ranks[0]:
                held.append((k, m))
            below += m
        width = (hi - lo) / BINS
        # a little wider than the bins: rounding must not lose a row at their borders
        new_lo, new_hi = lo + (held[0][0] - 0.01) * width, lo + (held[-1][0] + 1.01) * width
        done = sum(m for _, m in held) <= FEW or new_hi - new_lo >= hi - lo or new_lo + width / BINS <= new_lo
        lo, hi = new_lo, new_hi
        if done:
            break
    count, total, scores, phis = _summed(
        data.mapInPandas(_sums_below(features, state, lo, hi), "kind int, score double, phi array<double>"), len(w))
    state.unpersist()
    low, high = (scores[min(max(k - count, 0), len(scores) - 1)] for k in ranks)
    rho = float(low + (at - ranks[0]) * (high - low))
    spread = hi - lo
    return rho, total + phis[scores < rho].sum(axis=0), (rho - 64 * spread, rho + 64 * spread)


def fit(df: DataFrame, features: Sequence[str], nu: float = 0.01, D: int = 256, gamma=None,
        rounds: int = 12, seed: int = 42) -> OneClassModel:
    """DET8 fit; ``gamma`` None means 1 / n_features (the reference's 'auto')."""
    features = list(features)
    d = len(features)
    g = (1.0 / d) if gamma is None else float(gamma)
    rng = np.random.default_rng(seed)
    W = rng.normal(0.0, np.sqrt(2.0 * g), size=(d, D))
    b = rng.uniform(0.0, 2.0 * np.pi, size=D)
    data = cut_lineage(df.select(*[F.col(f).cast("double").alias(f) for f in features]))
    # start with every row violating (w = 0 < rho = 1): the first step goes to
    # the data's mean feature map
    w, rho, span = np.zeros(D), 1.0, (-np.inf, np.inf)
    state = df.sparkSession.sparkContext.broadcast((W, b, w))
    n, total, _, _ = _summed(data.mapInPandas(_sums_below(features, state, np.inf, np.inf),
                                              "kind int, score double, phi array<double>"), D)
    state.unpersist()
    for t in range(1, rounds + 1 if n else 1):
        w = w - (w - total / (nu * n)) / t     # strongly convex in w: step 1/t
        rho, total, span = _quantile_round(data, features, (W, b, w), nu, n, span)
    return OneClassModel(W, b, w, rho)


def score(df: DataFrame, model: OneClassModel, features: Sequence[str], out: str = "score_multi") -> DataFrame:
    """DET8 scoring: decision value and ``anomaly_multi`` (1 = outlier)."""
    # plain arrays only: the broadcast needs no project class on the workers
    bc = df.sparkSession.sparkContext.broadcast((model.W, model.b, model.w, model.rho))

    @F.pandas_udf("double")
    def decision(*cols: pd.Series) -> pd.Series:
        W, b, w, rho = bc.value
        X = np.column_stack([c.to_numpy(dtype=float) for c in cols])
        P = np.sqrt(2.0 / W.shape[1]) * np.cos(X @ W + b)
        return pd.Series(P @ w - rho)

    s = df.withColumn(out, decision(*[F.col(f).cast("double") for f in features]))
    return s.withColumn("anomaly_multi", (F.col(out) < 0).cast("int"))
