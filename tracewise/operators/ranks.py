"""Exact ranks and quantiles of a whole column without gathering its values.

A global ``percentile`` keeps every distinct value in one task.  Here the range
that holds the wanted ranks is narrowed by histograms instead: one scan
counts the values in ``BINS`` equal bins, and all wanted ranks are narrowed in the
same scan, until few values are left in their bins; only those are fetched.
A quantile (two neighbouring ranks) thus takes a scan for the range, one or more
histograms and one fetch; three scans in all for up to some ten million
values."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 4096
FEW = 4096


class _Range:
    """Part of the value range that holds some of the wanted ranks: values in
    [lo, hi], ``n`` of them, and ``below`` smaller ones."""

    def __init__(self, lo: float, hi: float, below: int, n: int, ranks: list[int]):
        self.lo, self.hi, self.below, self.n, self.ranks = lo, hi, below, n, ranks

    def width(self) -> float:
        return (self.hi - self.lo) / BINS

    def known(self) -> bool:
        return self.lo == self.hi

    def inside(self):
        return (F.col("v") >= F.lit(self.lo)) & (F.col("v") <= F.lit(self.hi))


def _narrow(x: DataFrame, ranges: list[_Range]) -> list[_Range]:
    """One scan: every range cut down to the bins of its ranks."""
    ranges = sorted(ranges, key=lambda r: r.lo)
    code = None
    for k, r in enumerate(ranges):
        # neighbouring floating-point numbers have no bins between them
        width = r.width() if r.lo + r.width() > r.lo else 0.0
        bin_ = F.least(F.floor((F.col("v") - F.lit(r.lo)) / F.lit(width)), F.lit(BINS - 1)) if width \
            else F.when(F.col("v") == F.lit(r.lo), 0).otherwise(1)
        at = F.lit(k * BINS) + bin_
        code = F.when(r.inside(), at) if code is None else code.when(r.inside(), at)
    rows = x.select("v", code.cast("int").alias("b")).filter("b IS NOT NULL").groupBy("b").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("b").collect()
    out = []
    for k, r in enumerate(ranges):
        below, wanted = r.below, sorted(r.ranks)
        for row in (row for row in rows if row["b"] // BINS == k):
            held = [w for w in wanted if below <= w < below + row["n"]]
            if held:
                out.append(_Range(row["lo"], row["hi"], below, row["n"], held))
            below += row["n"]
    return out


def exact_ranks(df: DataFrame, col: str, ranks: Sequence[int], bounds: tuple | None = None) -> dict[int, float]:
    """The values at ``ranks`` (from 0) among the values of ``col``, which must
    have no NULL or NaN.  ``bounds`` (least, greatest, count) saves a scan."""
    x = df.select(F.col(col).cast("double").alias("v"))
    if bounds is None:
        s = x.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n")).first()
        bounds = s["lo"], s["hi"], s["n"]
    lo, hi, n = bounds
    ranges = [_Range(lo, hi, 0, n, sorted(set(ranks)))]
    while (open_ := [r for r in ranges if not r.known()]) and sum(r.n for r in open_) > FEW:
        ranges = [r for r in ranges if r.known()] + _narrow(x, open_)
    found = {w: r.lo for r in ranges if r.known() for w in r.ranks}
    if open_:
        inside = open_[0].inside()
        for r in open_[1:]:
            inside = inside | r.inside()
        values = sorted(row["v"] for row in x.filter(inside).collect())
        for r in open_:
            own = [v for v in values if r.lo <= v <= r.hi]
            found |= {w: own[w - r.below] for w in r.ranks}
    return found


def exact_quantiles(df: DataFrame, col: str, qs: Sequence[float]) -> list[float | None]:
    """Quantiles with linear interpolation (as ``percentile``), all narrowed
    together; None without values.  NULL and NaN are ignored."""
    x = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    s = x.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    if not s["n"]:
        return [None] * len(qs)
    at = [q * (s["n"] - 1) for q in qs]
    ranks = {math.floor(a) for a in at} | {min(math.ceil(a), s["n"] - 1) for a in at}
    v = exact_ranks(x, "v", sorted(ranks), (s["lo"], s["hi"], s["n"]))
    out = []
    for a in at:
        low, high = v[math.floor(a)], v[min(math.ceil(a), s["n"] - 1)]
        out.append(low + (a - math.floor(a)) * (high - low))
    return out


def exact_quantile(df: DataFrame, col: str, q: float) -> float | None:
    """One quantile, see :func:`exact_quantiles`."""
    return exact_quantiles(df, col, [q])[0]
