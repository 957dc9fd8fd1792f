"""Pairwise and lagged correlation without a pivot (COR1, COR2, COR4-6, AGG7).

Correlation between every pair of series is a Gram product
``sum_t z_a(t) * z_b(t - L)`` of standardised series: centring first keeps
the result exact for series far from zero, and a series without variance is
known before any product is formed.  Series are dealt to blocks of about
``BLOCK`` ids and time to chunks of ``CHUNK`` steps.  One task multiplies two
blocks over one chunk, so its memory does not depend on the number of series,
and without a lag only the pairs a < b are formed and shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewise.functions.columns import CORR_THRESHOLD, epoch_seconds, pearson_from_sums
from tracewise.session import cut_lineage

BLOCK = 512
CHUNK = 1024
BAND = 0.125    # width of a bucket on the log scale of disjoint_pairs
# relative size below which a spread is rounding, not variance
MIN_SPREAD = 1e-12

_MOMENTS = ["n", "sx", "sy", "sxx", "syy", "sxy"]
_SCHEMA = "a string, b string, lag int, " + ", ".join(f"{c} double" for c in _MOMENTS)


def _grid(ids: pd.Series, values: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Sorted names, and the rows x names matrix with NaN for absent cells."""
    names, pos = np.unique(np.concatenate(ids.to_list()).astype(object), return_inverse=True)
    out = np.full((len(ids), len(names)), np.nan)
    rows = np.repeat(np.arange(len(ids)), ids.map(len).to_numpy())
    out[rows, pos] = np.concatenate(values.to_list())
    return names, out


def _block_moments(g: pd.DataFrame) -> pd.DataFrame:
    """Co-moments of the pairs of two blocks over one chunk of steps, over the
    steps where both values are present."""
    lag = int(g["lag"].iloc[0])
    an, A = _grid(g["cur_ids"], g["cur_x"])
    bn, B = _grid(g["prev_ids"], g["prev_x"])
    ma, mb = (~np.isnan(A)).astype(float), (~np.isnan(B)).astype(float)
    A, B = np.nan_to_num(A), np.nan_to_num(B)
    n = ma.T @ mb
    # without a lag the pair is unordered: each is wanted once, and within a
    # pair of different blocks either name may come first
    want = (n > 0) & (an[:, None] != bn[None, :])
    if lag == 0 and g["ba"].iloc[0] == g["bb"].iloc[0]:
        want &= an[:, None] < bn[None, :]
    i, j = np.nonzero(want)
    found = {"n": n, "sx": A.T @ mb, "sy": ma.T @ B, "sxx": (A * A).T @ mb, "syy": ma.T @ (B * B), "sxy": A.T @ B}
    out = pd.DataFrame({"a": an[i], "b": bn[j], "lag": np.full(len(i), lag, np.int32)}
                       | {c: v[i, j] for c, v in found.items()})
    if lag == 0:
        turn = (out["a"] > out["b"]).to_numpy()
        for x, y in (("a", "b"), ("sx", "sy"), ("sxx", "syy")):
            out.loc[turn, [x, y]] = out.loc[turn, [y, x]].to_numpy()
    return out


def comoments(df: DataFrame, id_col: str, step_col: str, value: str, lags: Sequence[int],
              wanted: DataFrame | None = None) -> DataFrame:
    """Co-moments of ``x_a(t)`` with ``x_b(t - L)`` for pairs of different
    ids, summed over the steps where both values exist.  For lag 0 only the
    pairs a < b, for other lags (in units of ``step_col``, an integer time
    index) every ordered pair.  ``wanted`` (a, b) leaves only those pairs."""
    blocks = max(1, -(-df.select(id_col).distinct().count() // BLOCK))
    per_step = (df.groupBy(step_col, F.pmod(F.xxhash64(id_col), F.lit(blocks)).alias("block"))
                .agg(F.collect_list(F.struct(F.col(id_col).alias("id"), F.col(value).cast("double").alias("x")))
                     .alias("s"))
                .select(step_col, "block", F.col("s.id").alias("ids"), F.col("s.x").alias("xs")))
    cur = per_step.select(F.col(step_col).alias("_t"), F.col("block").alias("ba"), F.col("ids").alias("cur_ids"),
                          F.col("xs").alias("cur_x"))
    prev = (per_step.select(F.explode(F.array(*[F.lit(int(L)) for L in lags])).alias("lag"), step_col, "block",
                            "ids", "xs")
            .select((F.col(step_col) + F.col("lag")).alias("_t"), "lag", F.col("block").alias("bb"),
                    F.col("ids").alias("prev_ids"), F.col("xs").alias("prev_x")))
    frames = (cur.join(prev, on="_t", how="inner").filter((F.col("lag") != 0) | (F.col("ba") <= F.col("bb")))
              .withColumn("chunk", F.floor(F.col("_t") / CHUNK)))
    parts = frames.groupBy("ba", "bb", "lag", "chunk").applyInPandas(_block_moments, _SCHEMA)
    if wanted is not None:
        parts = parts.join(wanted, ["a", "b"], "left_semi")
    return parts.groupBy("a", "b", "lag").agg(*[F.sum(c).alias(c) for c in _MOMENTS])


def standardised(df: DataFrame, id_col: str, value: str, n_steps=None) -> DataFrame:
    """Per id: mean, std (NULL if the series has no variance) and the
    largest absolute value.  With ``n_steps`` absent steps count as zeros."""
    x = F.col(value).cast("double")
    s = df.groupBy(id_col).agg(F.count(x).alias("_n"), F.avg(x).alias("_m"), F.var_pop(x).alias("_v"),
                               F.max(F.abs(x)).alias("_top"))
    if n_steps is not None:
        share = F.col("_n") / F.lit(float(n_steps))
        # variance of the zero-filled series from that of the present part
        s = s.withColumn("_v", share * F.col("_v") + share * (1 - share) * F.col("_m") * F.col("_m")) \
            .withColumn("_m", share * F.col("_m"))
    std = F.sqrt("_v")
    return s.select(id_col, F.col("_m").alias("mean"),
                    F.when(std > F.lit(MIN_SPREAD) * F.col("_top"), std).alias("std"), F.col("_n").alias("present"))


def with_step_index(df: DataFrame, ts: str, step_seconds: int, out: str = "step") -> DataFrame:
    """Integer time index ``(ts - first ts) / step`` (the first ts is a
    one-row scalar subquery; no global window)."""
    t0 = df.select(F.min(ts)).scalar()
    return df.withColumn(out, ((epoch_seconds(ts) - epoch_seconds(t0)) / F.lit(step_seconds)).cast("long"))


def corr_state(df: DataFrame, id_col: str, ts: str, value: str, step_seconds: int,
               threshold: float = CORR_THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """COR1: (pairs, series).  ``pairs`` (a, b, r) with ``a < b``: Pearson r on
    the zero-filled time x series grid (the pivot + ``fillna(0)`` + ``corr`` of
    the reference) of every pair that shares a timestamp, and of every other
    pair with ``|r| > threshold``; NULL for a constant series.  ``series``
    (id, gap, steps): ``gap`` is a series' value at an absent step (NULL without
    variance), from which r of any pair without a common timestamp follows.

    Present cells are standardised by the zero-filled mean and std; an absent
    cell is then the constant ``-mean / std`` of its series, so the cells
    where one or both are absent follow from counts and sums."""
    # the series feeds several branches and a scalar bound: read it once (it
    # is an aggregate, far smaller than the raw scan behind it)
    x = with_step_index(cut_lineage(df.select(id_col, ts, value)), ts, step_seconds)
    n = float(x.select(F.count_distinct("step")).first()[0] or 0)
    st = cut_lineage(standardised(x, id_col, value, n))
    z = x.join(st, id_col).select(id_col, "step", F.coalesce(
        (F.col(value) - F.col("mean")) / F.col("std"), F.lit(0.0)).alias("z"))
    m = comoments(z, id_col, "step", "z", [0])
    per = cut_lineage(z.groupBy(id_col).agg(F.sum("z").alias("sum")).join(st, id_col)
                      .select(id_col, "sum", "present", (-F.col("mean") / F.col("std")).alias("gap"), "std"))
    ja = per.select(F.col(id_col).alias("a"), *[F.col(c).alias(f"{c}_a") for c in per.columns[1:]])
    jb = per.select(F.col(id_col).alias("b"), *[F.col(c).alias(f"{c}_b") for c in per.columns[1:]])
    j = m.join(ja, "a").join(jb, "b")
    total = (F.col("sxy") + (F.col("sum_a") - F.col("sx")) * F.col("gap_b")
             + (F.col("sum_b") - F.col("sy")) * F.col("gap_a")
             + (F.lit(n) - F.col("present_a") - F.col("present_b") + F.col("n")) * F.col("gap_a") * F.col("gap_b"))
    r = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), total / F.lit(n)))
    met = cut_lineage(j.select("a", "b", F.when(F.col("std_a").isNotNull() & F.col("std_b").isNotNull(), r).alias("r")))
    apart = disjoint_pairs(per, id_col, n, met, threshold)
    return met.unionByName(apart), per.select(F.col(id_col).alias("id"), "gap", F.lit(n).alias("steps"))


def corr_matrix(df: DataFrame, id_col: str, ts: str, value: str, step_seconds: int,
                threshold: float = CORR_THRESHOLD) -> DataFrame:
    """COR1: the pairs of :func:`corr_state`."""
    return corr_state(df, id_col, ts, value, step_seconds, threshold)[0]


def _gap_corr(gap_a, gap_b):
    """r of two series without a common step.  Each is the constant ``gap``
    wherever the other is present, and a standardised series sums to zero, so
    the cross sum is ``-n * gap_a * gap_b``."""
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), -gap_a * gap_b))


def disjoint_pairs(per: DataFrame, id_col: str, n: float, met: DataFrame, threshold: float) -> DataFrame:
    """(a, b, r) of the pairs that never share a step and have
    ``|r| > threshold``, for the series ``per`` (id, present, gap) on ``n`` steps;
    ``met`` holds the pairs that do.

    As ``|r| = |gap_a| * |gap_b|`` lies between the threshold and 1, a partner's
    gap lies in a narrow band on the log scale: series are sorted into buckets of
    that scale and meet only the few buckets of their band, dealt to blocks."""
    s = per.where("gap IS NOT NULL AND gap <> 0").select(
        F.col(id_col).alias("id"), "present", "gap", F.ln(F.abs("gap")).alias("l"))
    blocks = max(1, -(-s.count() // BLOCK))
    low = (F.lit(float(np.log(threshold))) - F.col("l")) / BAND
    left = s.select(F.col("id").alias("a"), F.col("present").alias("present_a"), F.col("gap").alias("gap_a"),
                    F.explode(F.sequence(F.floor(low), F.floor((1e-9 - F.col("l")) / BAND))).alias("bucket"))
    left = left.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    right = s.select(F.col("id").alias("b"), F.col("present").alias("present_b"), F.col("gap").alias("gap_b"),
                     F.floor(F.col("l") / BAND).alias("bucket"),
                     F.pmod(F.xxhash64("id"), F.lit(blocks).cast("long")).alias("block"))
    pairs = left.join(right, ["bucket", "block"]).where(
        (F.col("a") < F.col("b")) & (F.col("present_a") + F.col("present_b") <= n)
        & (F.abs(F.col("gap_a") * F.col("gap_b")) > threshold))
    return pairs.join(met.select("a", "b"), ["a", "b"], "left_anti") \
        .select("a", "b", _gap_corr(F.col("gap_a"), F.col("gap_b")).alias("r"))


def corr_graph(corr: DataFrame, threshold: float) -> DataFrame:
    """COR2: undirected threshold graph ``|r| > threshold`` as directed
    edges in both directions (no self loops)."""
    kept = corr.filter(F.abs("r") > threshold)
    return kept.select("a", "b", "r").unionByName(kept.select(F.col("b").alias("a"), F.col("a").alias("b"), "r"))


def corr_diff(problem: DataFrame, normal: DataFrame, problem_series: DataFrame | None = None,
              normal_series: DataFrame | None = None) -> DataFrame:
    """COR4: problem - normal correlation per pair, aligned by labels (full
    outer join).  A pair that one side does not list has no common step there:
    with that side's series (as of :func:`corr_state`) its r follows from the
    gaps; it is NULL if a series is absent there or no series are given."""
    j = problem.select("a", "b", F.col("r").alias("r_problem"), F.lit(True).alias("_p")).join(
        normal.select("a", "b", F.col("r").alias("r_normal"), F.lit(True).alias("_n")), on=["a", "b"], how="full")
    for listed, r, series in (("_p", "r_problem", problem_series), ("_n", "r_normal", normal_series)):
        if series is not None:
            j = j.join(series.select(F.col("id").alias("a"), F.col("gap").alias("_ga")), "a", "left") \
                .join(series.select(F.col("id").alias("b"), F.col("gap").alias("_gb")), "b", "left") \
                .withColumn(r, F.when(F.col(listed), F.col(r)).otherwise(_gap_corr(F.col("_ga"), F.col("_gb")))) \
                .drop("_ga", "_gb")
    return j.select("a", "b", "r_problem", "r_normal", (F.col("r_problem") - F.col("r_normal")).alias("diff"))


def lagged_corr_edges(df: DataFrame, id_col: str, ts: str, value: str, step_seconds: int,
                      lag_max: int = 5, threshold: float = 0.6) -> DataFrame:
    """COR5: for every ordered pair, corr(caller(t), callee(t - lag)) for lag
    1..lag_max; keep the best lag (highest r, smallest lag on ties) when
    r >= threshold.  Edge (caller -> callee, r, lag)."""
    x = with_step_index(cut_lineage(df.select(id_col, ts, value)), ts, step_seconds)
    # a series without variance has no correlation with anything
    st = standardised(x, id_col, value).filter(F.col("std").isNotNull())
    z = cut_lineage(x.join(st, id_col).select(id_col, "step", ((F.col(value) - F.col("mean")) / F.col("std")).alias("z")))
    m = comoments(z, id_col, "step", "z", range(1, lag_max + 1))
    r = (m.select(F.col("a").alias("caller"), F.col("b").alias("callee"), "lag",
                  pearson_from_sums("n", "sx", "sy", "sxx", "syy", "sxy").alias("r"))
         .filter(F.col("r").isNotNull() & (F.col("r") > -1)))
    w = Window.partitionBy("caller", "callee").orderBy(F.col("r").desc(), F.col("lag"))
    best = r.withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_k")
    return best.filter(F.col("r") >= threshold).select("caller", "callee", "r", "lag")


def series_vs_total(df: DataFrame, id_col: str, ts: str, value: str) -> DataFrame:
    """AGG6 + JN8 + AGG7: correlation of each series with the system total
    per timestamp, for series present at every timestamp."""
    total = df.groupBy(ts).agg(F.sum(value).alias("_total"))
    n_ts = total.select(F.count(F.lit(1))).scalar()
    j = df.join(total, on=ts, how="inner")
    return (j.groupBy(id_col)
            .agg(F.count(F.lit(1)).alias("_n"),
                 F.try_divide(F.covar_pop(value, "_total"),
                              F.stddev_pop(value) * F.stddev_pop("_total")).alias("corr_total"))
            .filter(F.col("_n") == n_ts)
            .drop("_n"))


def edge_pair_corr(series: DataFrame, value: str, pairs: DataFrame | None = None) -> DataFrame:
    """COR6: correlation of consecutive edges (a->b, b->c) on a metric's
    step series ``(ts, src, dst, value)``.

    ``pairs`` (e1_src, e1_dst, e2_src, e2_dst) restricts the work to the
    pairs that matter (the root-cause search passes only anomalous edges of
    one kind); otherwise every consecutive pair of observed edges is used.
    Series with different numbers of points are not comparable: r = 0.
    """
    n = Window.partitionBy("src", "dst")
    s = series.select("ts", "src", "dst", F.col(value).alias("v"), F.count(F.lit(1)).over(n).alias("len"))
    e1 = s.select("ts", F.col("src").alias("e1_src"), F.col("dst").alias("mid"), F.col("v").alias("x"),
                  F.col("len").alias("len_x"))
    e2 = s.select("ts", F.col("src").alias("mid"), F.col("dst").alias("e2_dst"), F.col("v").alias("y"),
                  F.col("len").alias("len_y"))
    if pairs is not None:
        # prune both sides to the wanted edges before the (ts, node) join
        e1 = e1.join(pairs.select("e1_src", F.col("e1_dst").alias("mid")).distinct(), ["e1_src", "mid"], "left_semi")
        e2 = e2.join(pairs.select(F.col("e1_dst").alias("mid"), "e2_dst").distinct(), ["mid", "e2_dst"], "left_semi")
    j = e1.join(e2, on=["ts", "mid"], how="inner").filter(F.col("e1_src") != F.col("e2_dst"))
    if pairs is not None:
        j = j.join(pairs.select("e1_src", F.col("e1_dst").alias("mid"), "e2_dst"),
                   on=["e1_src", "mid", "e2_dst"], how="left_semi")
    return (j.groupBy("e1_src", "mid", "e2_dst")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.when(F.first("len_x") != F.first("len_y"), F.lit(0.0)).otherwise(
                     F.try_divide(F.covar_pop("x", "y"), F.stddev_pop("x") * F.stddev_pop("y"))).alias("r"))
            .select(F.col("e1_src").alias("a"), F.col("mid").alias("b"), F.col("e2_dst").alias("c"), "n", "r"))
