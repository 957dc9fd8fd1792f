"""Isolation forest: distributed fit and Arrow-batched scoring (DET6, DET7).

Fit
  1. Every row is a candidate for every tree: ``xxhash64(key, tree, seed)``
     orders the whole table once per tree.  A row is emitted for a tree only
     if that hash lies under a bound chosen so that several times
     ``max_samples`` rows per tree are expected (one count); if some tree got
     too few, the bound is widened and the step repeated.
  2. Per tree the ``max_samples`` rows with the smallest hash are its sample:
     exactly the smallest of all rows, whatever the bound or partitioning.
  3. ``groupBy(tree).applyInPandas`` grows each tree (random feature,
     uniform split between the node's min and max, depth limit
     ``ceil(log2(max_samples))``) and emits its nodes.
  The model is the ``forest_nodes`` table: at most trees x (2*max_samples-1)
  rows whatever the data size, so broadcasting it for scoring is bounded.

Score
  ``s = 2 ** (-E[h(x)] / c(n))``; a leaf of size m adds ``c(m)``.  With
  contamination c the offset q is the (1 - c) quantile of the training
  scores; ``decision = q - s`` (negative = outlier).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewise.operators.ranks import exact_quantile
from tracewise.session import cut_lineage

EULER = 0.5772156649
NODE_SCHEMA = ("tree int, node int, feature int, threshold double, left int, right int, "
               "size int, depth int")


def c_factor(n):
    """Average path length of an unsuccessful BST search over n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


def _grow(features: list[str], max_depth: int, seed: int):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        X = pdf[features].to_numpy(dtype=float)
        rng = np.random.default_rng([seed, tree])
        rows = []
        stack = [(0, np.arange(len(X)), 0)]
        next_id = 1
        while stack:
            nid, idx, depth = stack.pop()
            feat, thr, left, right = -1, 0.0, -1, -1
            if depth < max_depth and len(idx) > 1:
                sub = X[idx]
                lo, hi = sub.min(axis=0), sub.max(axis=0)
                usable = np.nonzero(hi > lo)[0]
                if len(usable):
                    feat = int(rng.choice(usable))
                    thr = float(rng.uniform(lo[feat], hi[feat]))
                    go_left = sub[:, feat] < thr
                    left, right = next_id, next_id + 1
                    next_id += 2
                    stack.append((left, idx[go_left], depth + 1))
                    stack.append((right, idx[~go_left], depth + 1))
            rows.append((tree, nid, feat, thr, left, right, len(idx), depth))
        return pd.DataFrame(rows, columns=["tree", "node", "feature", "threshold", "left", "right",
                                           "size", "depth"])
    return fn


def tree_samples(df: DataFrame, key_cols: Sequence[str], features: Sequence[str], n_trees: int, max_samples: int,
                 seed: int, n: int, oversample: int = 8) -> DataFrame:
    """(tree, features): for each tree the ``max_samples`` rows of all of
    ``df`` whose hash is smallest.  Every row could be in every sample; only
    about ``oversample * max_samples`` rows per tree are moved."""
    key = F.xxhash64(*[F.col(k).cast("string") for k in key_cols], F.lit(seed))
    rows = df.select(key.alias("_k"), *[F.col(f).cast("double").alias(f) for f in features])
    share = oversample * max_samples / max(n, 1)
    while True:
        bound = F.lit(min(-(1 << 63) + int(share * (1 << 64)), (1 << 63) - 1) if share < 1 else (1 << 63) - 1)
        trees = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)),
                         lambda t: F.xxhash64(F.col("_k"), t, F.lit(seed)) <= bound)
        found = cut_lineage(rows.select(F.explode(trees).alias("tree"), "_k", *features))
        if share >= 1:
            break
        got = found.groupBy("tree").count().agg(F.min("count"), F.count(F.lit(1))).first()
        if got[1] == n_trees and got[0] >= min(max_samples, n):
            break
        share *= 8
    w = Window.partitionBy("tree").orderBy(F.xxhash64(F.col("_k"), F.col("tree"), F.lit(seed)), F.col("_k"))
    return found.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= max_samples) \
        .select("tree", *features)


def fit(df: DataFrame, key_cols: Sequence[str], features: Sequence[str], n_trees: int = 100,
        max_samples: int = 256, seed: int = 42) -> DataFrame:
    """DET6: fit an isolation forest; returns the ``forest_nodes`` table."""
    features = list(features)
    n = df.count()
    sample = tree_samples(df, key_cols, features, n_trees, max_samples, seed, n)
    m = min(max_samples, n)
    depth = int(math.ceil(math.log2(max(m, 2))))
    nodes = sample.groupBy("tree").applyInPandas(
        _grow(features, depth, seed), NODE_SCHEMA)
    return nodes.withColumn("n_samples", F.lit(m))


def _arrays(nodes_pdf: pd.DataFrame):
    """Dense per-tree node arrays for vectorised traversal."""
    t = nodes_pdf["tree"].to_numpy()
    trees = np.unique(t)
    width = int(nodes_pdf["node"].max()) + 1
    shape = (len(trees), width)
    feat = np.full(shape, -1, dtype=np.int64)
    thr = np.zeros(shape)
    left = np.full(shape, -1, dtype=np.int64)
    right = np.full(shape, -1, dtype=np.int64)
    size = np.zeros(shape)
    depth = np.zeros(shape)
    ti = np.searchsorted(trees, t)
    nd = nodes_pdf["node"].to_numpy()
    feat[ti, nd] = nodes_pdf["feature"].to_numpy()
    thr[ti, nd] = nodes_pdf["threshold"].to_numpy()
    left[ti, nd] = nodes_pdf["left"].to_numpy()
    right[ti, nd] = nodes_pdf["right"].to_numpy()
    size[ti, nd] = nodes_pdf["size"].to_numpy()
    depth[ti, nd] = nodes_pdf["depth"].to_numpy()
    return feat, thr, left, right, size, depth, int(nodes_pdf["n_samples"].iloc[0])


def path_lengths(X: np.ndarray, arrays) -> np.ndarray:
    """Mean path length over trees for every row of X."""
    feat, thr, left, right, size, depth, _ = arrays
    n_trees = feat.shape[0]
    total = np.zeros(len(X))
    rows = np.arange(len(X))
    for t in range(n_trees):
        node = np.zeros(len(X), dtype=np.int64)
        while True:
            f = feat[t, node]
            inner = f >= 0
            if not inner.any():
                break
            fi = np.where(inner, f, 0)
            go_left = X[rows, fi] < thr[t, node]
            nxt = np.where(go_left, left[t, node], right[t, node])
            node = np.where(inner, nxt, node)
        total += depth[t, node] + c_factor(size[t, node])
    return total / n_trees


def score(df: DataFrame, nodes: DataFrame, features: Sequence[str], out: str = "anomaly_score") -> DataFrame:
    """DET7: isolation score ``s`` per row, Arrow-batched.  The node table is
    bounded by trees x (2 * max_samples - 1) rows, so it is broadcast."""
    features = list(features)
    pdf = nodes.toPandas()
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast(_arrays(pdf))

    @F.pandas_udf("double")
    def iso_score(*cols: pd.Series) -> pd.Series:
        arrays = bc.value
        X = np.column_stack([c.to_numpy(dtype=float) for c in cols])
        h = path_lengths(X, arrays)
        return pd.Series(np.power(2.0, -h / c_factor(np.array([arrays[6]]))[0]))

    return df.withColumn(out, iso_score(*[F.col(f).cast("double") for f in features]))


def offset(train_scores: DataFrame, contamination, col: str = "anomaly_score"):
    """Threshold q on the score scale: the (1 - contamination) quantile of
    the training scores (exact), or 0.5 for ``"auto"``."""
    if contamination == "auto":
        return F.lit(0.5)
    return F.lit(exact_quantile(train_scores, col, 1.0 - float(contamination)))


def label(scored: DataFrame, q, col: str = "anomaly_score", threshold: float = 0.7) -> DataFrame:
    """decision = q - s (negative = outlier); ``is_outlier`` from the
    contamination offset, ``is_anomaly`` from the fixed 0.7 threshold."""
    return (scored.withColumn("decision", q - F.col(col))
            .withColumn("is_outlier", F.col("decision") < 0)
            .withColumn("is_anomaly", F.col(col) > F.lit(threshold)))


# ------------------------------------------------------------ many forests

def _grow_array(max_depth: int, seed: int):
    grow = _grow

    def fn(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        X = np.vstack(pdf["x"].to_numpy()).astype(float)
        names = [f"f{i}" for i in range(X.shape[1])]
        wide = pd.DataFrame(X, columns=names).assign(tree=int(key[1]))
        return grow(names, max_depth, seed)(wide).assign(grp=key[0])
    return fn


def fit_groups(df: DataFrame, group: str, key_cols: Sequence[str], features: str, n_trees: int = 100,
               max_samples: int = 256, seed: int = 42) -> DataFrame:
    """DET6 for many models in one distributed fit: a forest for every value
    of ``group`` (a small, known set such as anomaly kinds) on the array column
    ``features``.  Samples are drawn as in :func:`tree_samples`; every (group,
    tree) grows in its own task.  Returns the node table with the group."""
    key = F.xxhash64(*[F.col(k).cast("string") for k in key_cols], F.lit(seed))
    rows = cut_lineage(df.select(F.col(group).cast("string").alias("grp"), key.alias("_k"), F.col(features).alias("x")))
    sizes = rows.groupBy("grp").agg(F.count(F.lit(1)).alias("_n"))
    # about 8 times the wanted sample is moved; a small group moves whole
    share = F.least(F.lit(1.0), F.lit(8.0 * max_samples) / F.col("_n"))
    bound = F.when(share >= 1, F.lit((1 << 63) - 1)).otherwise(
        (F.lit(float(-(1 << 63))) + share * F.lit(float(1 << 64))).cast("long"))
    sized = rows.join(sizes.select("grp", "_n", bound.alias("_bound")), "grp")
    h = F.xxhash64("_k", "tree", F.lit(seed))
    dealt = sized.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1)))) \
        .withColumn("_h", h).where(F.col("_h") <= F.col("_bound"))
    w = Window.partitionBy("grp", "tree").orderBy("_h", "_k")
    sample = dealt.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= max_samples).select("grp", "tree", "x")
    depth = int(math.ceil(math.log2(max_samples)))
    nodes = sample.groupBy("grp", "tree").applyInPandas(_grow_array(depth, seed), NODE_SCHEMA + ", grp string")
    return nodes.join(sizes.select("grp", F.least(F.col("_n"), F.lit(max_samples)).cast("int").alias("n_samples")), "grp")


def score_groups(df: DataFrame, group: str, nodes: DataFrame, features: str, out: str = "anomaly_score") -> DataFrame:
    """DET7 with the forest of each row's group; NULL for a group without a
    forest.  The node table is bounded by groups x trees x (2 * max_samples - 1)."""
    pdf = nodes.toPandas()
    models = {g: _arrays(part) for g, part in pdf.groupby("grp")}
    bc = df.sparkSession.sparkContext.broadcast(models)

    @F.pandas_udf("double")
    def iso_score(grp: pd.Series, x: pd.Series) -> pd.Series:
        res = np.full(len(grp), np.nan)
        names = grp.to_numpy()
        for g, arrays in bc.value.items():
            at = np.flatnonzero(names == g)
            if len(at):
                X = np.vstack(x.to_numpy()[at]).astype(float)
                res[at] = np.power(2.0, -path_lengths(X, arrays) / c_factor(np.array([arrays[6]]))[0])
        return pd.Series(res)

    s = iso_score(F.col(group).cast("string"), F.col(features))
    return df.withColumn(out, F.when(~F.isnan(s), s))


def group_offsets(train_scores: DataFrame, group: str, contamination: float,
                  col: str = "anomaly_score") -> dict[str, float]:
    """The (1 - contamination) quantile of each group's scores."""
    groups = [r[0] for r in train_scores.select(group).distinct().collect()]
    return {g: exact_quantile(train_scores.where(F.col(group) == g), col, 1.0 - contamination) for g in groups}
