"""Granger causality F-tests, distributed (COR3).

For a kept pair (a, b) the question is whether b's past helps predict a.
For each lag L: regress a_t on (1, a_{t-1..t-L}) (restricted) and on
(1, a_{t-1..t-L}, b_{t-1..t-L}) (unrestricted) over t = L..T-1;
``F = ((SSR_r - SSR_u) / L) / (SSR_u / (T - L - 2L - 1))``.

Every entry of the normal equations is a sum of lagged products of two
series, ``sum_t x(t-i) y(t-j)`` over t = L..T-1.  For all t these are the
lagged co-moments of the block product of ``operators.correlate``; what the
sum over L..T-1 leaves out are at most ``maxlag`` products at each end, which
follow from the first and last values of the series.  So there are no
pairs x time rows: products are formed block by block, a pair is one row with
some 30 numbers, and only systems of at most 11 x 11 are solved.  The F test
does not change when a series is shifted or scaled, so the series are
standardised first.  The F tail uses the regularized incomplete beta function
(continued fraction), so no SciPy is needed.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewise.operators.correlate import comoments, standardised
from tracewise.session import cut_lineage


def _betacf(a, b, x, itmax=300, eps=3e-16):
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
    h = d
    for m in range(1, itmax + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
        c = 1.0 + aa / c
        c = c if abs(c) > 1e-300 else 1e-300
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
        c = 1.0 + aa / c
        c = c if abs(c) > 1e-300 else 1e-300
        de = d * c
        h *= de
        if abs(de - 1.0) < eps:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1.0 - x) / b


def f_sf(f: float, d1: float, d2: float) -> float:
    """Survival function of the F distribution, P(F > f)."""
    if not np.isfinite(f):
        return 0.0 if f > 0 else 1.0
    if f <= 0:
        return 1.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def _lagged(full: np.ndarray, x: dict, y: dict, i: int, j: int, L: int) -> float:
    """``sum over t = L..T-1 of x(t-i) y(t-j)`` for ``i >= j``; ``full[d]`` is
    ``sum_t x(t-d) y(t)`` over all t, ``head`` and ``tail`` are the first and
    the last values of a series."""
    d = i - j
    m = len(x["head"])
    first = sum(x["head"][u - d] * y["head"][u] for u in range(d, L - j))
    last = sum(x["tail"][m - k - d] * y["tail"][m - k] for k in range(1, j + 1))
    return full[d] - first - last


def _moment(s: dict, i: int, L: int) -> float:
    """``sum over t = L..T-1 of x(t-i)``."""
    return s["total"] - sum(s["head"][:L - i]) - (sum(s["tail"][-i:]) if i else 0.0)


def f_test(a: dict, b: dict, auto_a, auto_b, cross_ab, cross_ba, n: int, L: int) -> float | None:
    """F of "b's past helps predict a" at lag L; None if it is not defined.
    ``auto[d]`` = sum x(t-d) x(t), ``cross_ab[d]`` = sum a(t-d) b(t),
    ``cross_ba[d]`` = sum b(t-d) a(t)."""
    def product(p, i, q, j):
        if p == q:
            s, auto = (a, auto_a) if p == "a" else (b, auto_b)
            return _lagged(auto, s, s, max(i, j), min(i, j), L)
        if p == "b":
            return product(q, j, p, i)
        return _lagged(cross_ab, a, b, i, j, L) if i >= j else _lagged(cross_ba, b, a, j, i, L)

    terms = [("a", i) for i in range(1, L + 1)] + [("b", i) for i in range(1, L + 1)]
    k = 2 * L + 1
    left, right = np.empty((k, k)), np.empty(k)
    left[0, 0], right[0] = n - L, _moment(a, 0, L)
    for r, (p, i) in enumerate(terms, 1):
        left[0, r] = left[r, 0] = _moment(a if p == "a" else b, i, L)
        right[r] = product(p, i, "a", 0)
        for c, (q, j) in enumerate(terms, 1):
            left[r, c] = product(p, i, q, j)
    yy = product("a", 0, "a", 0)
    rest = n - L - k
    if rest <= 0:
        return None
    try:
        full = np.linalg.solve(left, right)
        part = np.linalg.solve(left[:L + 1, :L + 1], right[:L + 1])
    except np.linalg.LinAlgError:
        return None
    ssr_full = max(yy - full @ right, 0.0)
    ssr_part = max(yy - part @ right[:L + 1], 0.0)
    return None if ssr_full <= 0 else ((ssr_part - ssr_full) / L) / (ssr_full / rest)


def _tests(maxlag: int):
    def fn(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                n = int(r.n)
                a = {"total": r.total_a, "head": r.head_a, "tail": r.tail_a}
                b = {"total": r.total_b, "head": r.head_b, "tail": r.tail_b}
                for L in range(1, maxlag + 1):
                    f = None if n < 3 * maxlag + 2 else f_test(a, b, r.auto_a, r.auto_b, r.cross_ab, r.cross_ba, n, L)
                    p = None if f is None else f_sf(f, L, n - 3 * L - 1)
                    out.append((r.a, r.b, L, f, p))
            yield pd.DataFrame(out, columns=["a", "b", "lag", "f", "p"]).astype({"f": float, "p": float})
    return fn


def _series_state(z: DataFrame, maxlag: int) -> DataFrame:
    """(id, n, total, auto, head, tail) of (id, step, x) series on the steps
    0..n-1."""
    w = Window.partitionBy("id").orderBy("step")
    x = z.select("id", "step", "x", F.count(F.lit(1)).over(Window.partitionBy("id")).alias("n"),
                 (F.row_number().over(w) - 1).alias("k"),
                 *[F.lag("x", d).over(w).alias(f"x{d}") for d in range(1, maxlag + 1)])
    auto = [F.sum(F.col("x") * F.col("x")), *[F.sum(F.col("x") * F.col(f"x{d}")) for d in range(1, maxlag + 1)]]

    def ends(which):
        got = F.array_sort(F.collect_list(F.when(which, F.struct("k", "x"))))
        return F.transform(got, lambda v: v["x"])

    return x.groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("x").alias("total"),
        F.array(*[F.coalesce(c, F.lit(0.0)) for c in auto]).alias("auto"),
        ends(F.col("k") < maxlag).alias("head"), ends(F.col("k") >= F.col("n") - maxlag).alias("tail"))


def granger_tests(series: DataFrame, pairs: DataFrame, id_col: str = "id", step: str = "step", value: str = "x",
                  maxlag: int = 5) -> DataFrame:
    """(a, b, lag, f, p) for each pair and lag 1..maxlag; f and p are NULL
    where the test is not defined (too short, singular).  ``series`` must be
    dense on one step grid (zero-filled like the reference's pivot)."""
    raw = series.select(F.col(id_col).alias("id"), F.col(step).alias("step"), F.col(value).cast("double").alias("v"))
    st = standardised(raw, "id", "v").where("std IS NOT NULL").select("id", "mean", "std")
    z = cut_lineage(raw.join(st, "id").select("id", "step", ((F.col("v") - F.col("mean")) / F.col("std")).alias("x")))
    p = cut_lineage(pairs.select("a", "b").distinct())
    both = p.unionByName(p.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    # x_a(t) x_b(t - lag) of ordered pairs; without a lag one order is enough
    found = comoments(z, "id", "step", "x", range(maxlag + 1), wanted=both).select("a", "b", "lag", "sxy")
    found = found.unionByName(found.where("lag = 0").select(F.col("b").alias("a"), F.col("a").alias("b"), "lag", "sxy"))
    per = found.groupBy("a", "b").agg(F.map_from_entries(F.collect_list(F.struct("lag", "sxy"))).alias("m")).select(
        "a", "b", F.array(*[F.coalesce(F.col("m")[d], F.lit(0.0)) for d in range(maxlag + 1)]).alias("c"))
    per = cut_lineage(per)
    state = cut_lineage(_series_state(z, maxlag))

    def of(side):
        return state.select(F.col("id").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("total", "auto", "head", "tail")],
                            *([F.col("n")] if side == "a" else []))

    # cross_ab[d] = sum a(t-d) b(t) is the row (b, a)
    rows = p.join(of("a"), "a").join(of("b"), "b") \
        .join(per.select("a", "b", F.col("c").alias("cross_ba")), ["a", "b"]) \
        .join(per.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("c").alias("cross_ab")), ["a", "b"])
    tests = rows.mapInPandas(_tests(maxlag), "a string, b string, lag int, f double, p double")
    return tests.select("a", "b", "lag", *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("f", "p")])


def granger(series: DataFrame, pairs: DataFrame, id_col: str = "id", step: str = "step", value: str = "x",
            maxlag: int = 5, alpha: float = 0.05) -> DataFrame:
    """COR3: for each pair (a, b): does b Granger-cause a at some lag
    1..maxlag (p < alpha)?  A pair with a failed test (too short, singular
    design, a series without variance) gives ``causes = false``, as the
    reference's ``except`` does."""
    p = pairs.select("a", "b").distinct()
    res = granger_tests(series, p, id_col, step, value, maxlag).groupBy("a", "b").agg(
        F.min("p").alias("min_p"), (F.count("p") == maxlag).alias("_whole"))
    return p.join(res, ["a", "b"], "left").select(
        "a", "b", "min_p", F.coalesce(F.col("_whole") & (F.col("min_p") < alpha), F.lit(False)).alias("causes"))
