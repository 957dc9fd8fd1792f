"""Counter and histogram operators with PromQL range-vector semantics
(PQL1-8).

A range selector ``v[R]`` evaluated every ``S`` is a sliding window, so each
counter sample is assigned to the evaluation times whose range contains it
with ``F.window``; everything after that is an ordinary aggregation.

* Windows are left-open, right-closed: sample t belongs to evaluation time T
  when ``T - R < t <= T`` (``F.window`` is ``[start, end)``, so it is fed
  ``t - 1 microsecond`` and labelled by its end).
* ``rate`` is the reset-aware increase between the first and the last sample
  of the range divided by their distance (no edge extrapolation).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewise.functions.columns import epoch_seconds, safe_div, seconds_between


def _shifted(ts: str) -> Column:
    return F.col(ts) - F.expr("INTERVAL 1 MICROSECOND")


def counter_deltas(counter: DataFrame, series: Sequence[str], ts: str = "ts",
                   value: str = "value") -> DataFrame:
    """Reset-aware increase between consecutive samples of each series: a
    drop means the counter restarted from 0, so the increase is the new value."""
    w = Window.partitionBy(*series).orderBy(ts)
    prev = F.lag(value).over(w)
    return (counter.select(*series, ts, F.lag(ts).over(w).alias("prev_ts"), prev.alias("prev_value"),
                           F.when(F.col(value) < prev, F.col(value))
                           .otherwise(F.col(value) - prev).alias("d"))
            .filter(F.col("prev_ts").isNotNull()))


def increase_and_rate(counter: DataFrame, series: Sequence[str], range_: str, step: str,
                      ts: str = "ts", value: str = "value", extrapolate: bool = False) -> DataFrame:
    """PQL1: ``increase(v[range])`` and ``rate(v[range])`` at every step.

    Output: series labels, ``ts`` (evaluation time), ``increase``, ``rate``
    (per second).  Needs two samples inside the range, as PromQL does.

    ``extrapolate`` stretches the increase to the range's borders as PromQL
    does: to a border that is nearer than 1.1 mean sample distances, else by
    half a distance, and at the start never below a counter of zero; the rate
    is then the stretched increase over the whole range.
    """
    d = counter_deltas(counter, series, ts, value)
    win = F.window(_shifted(ts), range_, step)
    x = (d.select(*series, ts, "prev_ts", "prev_value", "d", win.alias("w"))
         .filter(F.col("prev_ts") > F.col("w.start")))
    if extrapolate:
        return _extrapolated(x, series, ts)
    return (x.groupBy(*series, F.col("w.end").alias("eval_ts"))
            .agg(F.sum("d").alias("increase"),
                 F.max(ts).alias("_last"), F.min("prev_ts").alias("_first"))
            .select(*series, F.col("eval_ts").alias("ts"), "increase",
                    safe_div(F.col("increase"), seconds_between("_last", "_first")).alias("rate")))


def _extrapolated(x: DataFrame, series: Sequence[str], ts: str) -> DataFrame:
    g = (x.groupBy(*series, F.col("w.start").alias("_start"), F.col("w.end").alias("eval_ts"))
         .agg(F.sum("d").alias("_inc"), F.count(F.lit(1)).alias("_gaps"), F.max(ts).alias("_last"),
              F.min(F.struct("prev_ts", "prev_value")).alias("_f")))
    span = seconds_between("_last", "_f.prev_ts")
    gap = span / F.col("_gaps")
    to_start, to_end = seconds_between("_f.prev_ts", "_start"), seconds_between("eval_ts", "_last")
    start = F.when(to_start < 1.1 * gap, to_start).otherwise(gap / 2)
    to_zero = F.when((F.col("_inc") > 0) & (F.col("_f.prev_value") >= 0), span * F.col("_f.prev_value") / F.col("_inc"))
    start = F.least(start, to_zero)     # NULLs are skipped
    end = F.when(to_end < 1.1 * gap, to_end).otherwise(gap / 2)
    stretched = F.col("_inc") * safe_div(span + start + end, span)
    return g.select(*series, F.col("eval_ts").alias("ts"), stretched.alias("increase"),
                    safe_div(stretched, seconds_between("eval_ts", "_start")).alias("rate"))


def increase_and_rate_columns(counters: DataFrame, series: Sequence[str], values: Sequence[str], range_: str,
                              step: str, ts: str = "ts") -> DataFrame:
    """PQL1 for several counters that are sampled together (the buckets and
    the sum of a histogram): one row per series and step with ``<v>_rate`` for
    every value, from one window and one aggregation."""
    w = Window.partitionBy(*series).orderBy(ts)

    def delta(v):
        prev = F.lag(v).over(w)
        return F.when(F.col(v) < prev, F.col(v)).otherwise(F.col(v) - prev)

    d = counters.select(*series, ts, F.lag(ts).over(w).alias("prev_ts"), *[delta(v).alias(v) for v in values]) \
        .filter(F.col("prev_ts").isNotNull())
    x = d.select("*", F.window(_shifted(ts), range_, step).alias("w")).filter(F.col("prev_ts") > F.col("w.start"))
    g = x.groupBy(*series, F.col("w.end").alias("eval_ts")).agg(
        *[F.sum(v).alias(v) for v in values], F.max(ts).alias("_last"), F.min("prev_ts").alias("_first"))
    span = seconds_between("_last", "_first")
    return g.select(*series, F.col("eval_ts").alias("ts"), *[safe_div(F.col(v), span).alias(f"{v}_rate") for v in values])


def sum_by(df: DataFrame, by: Sequence[str], value: str = "rate", out: str | None = None) -> DataFrame:
    """PQL2: ``sum(v) by (labels)`` at each evaluation time."""
    return df.groupBy("ts", *by).agg(F.sum(value).alias(out or value))


def histogram_quantile(bucket_rates: DataFrame, q: float, by: Sequence[str],
                       le: str = "le", value: str = "rate", out: str = "quantile") -> DataFrame:
    """PQL3: quantile from cumulative bucket rates, linear inside a bucket.

    The first bucket's lower bound is 0; when the rank falls in the +Inf
    bucket the highest finite bound is returned; no observations -> no row.
    Each (ts, labels) group is a short array of buckets handled with array
    functions in one aggregation (no sort of the whole table).
    """
    g = (bucket_rates.groupBy("ts", *by)
         .agg(F.array_sort(F.collect_list(F.struct(F.col(le).alias("le"),
                                                   F.col(value).alias("c")))).alias("bk")))
    return _quantile_of_buckets(g, q, by, out)


def histogram_quantile_columns(rates: DataFrame, q: float, by: Sequence[str], buckets: dict[str, float],
                               out: str = "quantile") -> DataFrame:
    """PQL3 where the buckets are columns: ``buckets`` maps a cumulative rate's
    column to its upper bound."""
    listed = [F.struct(F.lit(le).alias("le"), F.col(c).alias("c")) for c, le in sorted(buckets.items(), key=lambda x: x[1])]
    return _quantile_of_buckets(rates.select("ts", *by, F.array(*listed).alias("bk")), q, by, out)


def _quantile_of_buckets(g: DataFrame, q: float, by: Sequence[str], out: str) -> DataFrame:
    """The quantile of (ts, labels, bk) rows; ``bk`` holds the sorted buckets."""
    total = F.element_at("bk", -1)["c"]
    rank = F.lit(q) * total
    below = F.size(F.filter("bk", lambda b: b["c"] < rank))
    upper = F.element_at("bk", below + 1)
    lower = F.when(below > 0, F.element_at("bk", F.greatest(below, F.lit(1))))
    lo_le = F.coalesce(lower["le"], F.lit(0.0))
    lo_c = F.coalesce(lower["c"], F.lit(0.0))
    finite_top = F.element_at("bk", -2)["le"]
    val = (F.when(upper["le"] == F.lit(float("inf")), finite_top)
           .otherwise(lo_le + (upper["le"] - lo_le) * safe_div(rank - lo_c, upper["c"] - lo_c)))
    return (g.filter(total > 0)
            .select("ts", *by, val.alias(out)))


def vector_ratio(df: DataFrame, by: Sequence[str], numerator: Column, value: str = "rate",
                 out: str = "ratio") -> DataFrame:
    """PQL4: ``sum(v{match}) by (l) / sum(v) by (l)`` in one pass (conditional
    aggregation).  Like PromQL, no row when the numerator side has no
    series."""
    return (df.groupBy("ts", *by)
            .agg(F.sum(F.when(numerator, F.col(value))).alias("_num"), F.sum(value).alias("_den"))
            .filter(F.col("_num").isNotNull())
            .select("ts", *by, safe_div("_num", "_den").alias(out))
            .filter(F.col(out).isNotNull()))


def avg_over_time(df: DataFrame, by: Sequence[str], value: str, range_seconds: int,
                  step_seconds: int, out: str | None = None) -> DataFrame:
    """PQL5: ``avg_over_time(expr[range:step])`` for an ``expr`` already
    evaluated on the ``step`` grid: mean of the points in ``(T - range, T]``."""
    w = (Window.partitionBy(*by).orderBy(epoch_seconds("ts"))
         .rangeBetween(-(range_seconds - step_seconds), 0))
    return df.select("ts", *by, F.avg(value).over(w).alias(out or value))


def total_increase(counter: DataFrame, series: Sequence[str], by: Sequence[str],
                   ts: str = "ts", value: str = "value") -> DataFrame:
    """PQL6 / AGG12: increase of each series over the whole scanned range,
    summed by ``by``; rows with traffic are the observed edges."""
    d = counter_deltas(counter, series, ts, value)
    return d.groupBy(*by).agg(F.sum("d").alias("increase"))
