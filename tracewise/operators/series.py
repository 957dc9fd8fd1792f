"""Lag over ordered series that stays parallel on skewed keys.

A window ``partitionBy(key).orderBy(ts)`` puts every row of one key into one
task.  Keys that hold more than a small share of all rows (there can only be few)
take another way: their rows are range-partitioned by key and order, the lag
runs inside each range, and the first row of a key in a range takes the last
one of the range before from a small table (one row per key and range).  So a
key with all rows, even at one instant, is spread over all tasks, and the answer is
that of the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewise.session import cut_lineage


HEAVY_SHARE = 2.0 ** -14    # so at most 16,384 keys are heavy


def previous_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column | None = None,
                 cols: Sequence[str] = (), prefix: str = "prev_", heavy_share: float = HEAVY_SHARE) -> DataFrame:
    """Add ``prefix + c`` = value of ``c`` on the previous row of the same key.

    Equivalent to ``lag(c).over(partitionBy(keys).orderBy(order))``; ``order``
    must be a total order within a key.  ``bucket`` (a column that does not
    fall along the order) names the ranges; else the rows of keys with more than
    ``heavy_share`` of all rows are dealt to ranges by key and order.
    """
    keys, order, cols = list(keys), list(order), list(cols)
    if bucket is not None:
        return _lag_in_ranges(df.withColumn("_range", bucket), keys, order, cols, prefix)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(
        F.col("_n") > F.lit(heavy_share * df.count())).select(*keys)
    # bounded by 1 / heavy_share rows, so it may be broadcast
    heavy = F.broadcast(cut_lineage(heavy))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"d.{k}").eqNullSafe(F.col(f"h.{k}"))
    light = df.alias("d").join(heavy.alias("h"), same, "left_anti")
    w = Window.partitionBy(*keys).orderBy(*order)
    light = light.select(*df.columns, *[F.lag(c).over(w).alias(prefix + c) for c in cols])
    hot = df.alias("d").join(heavy.alias("h"), same, "left_semi")
    hot = hot.repartitionByRange(parts, *keys, *order).withColumn("_range", F.spark_partition_id())
    return light.unionByName(_lag_in_ranges(cut_lineage(hot), keys, order, cols, prefix))


def _lag_in_ranges(data: DataFrame, keys: list[str], order: list[str], cols: list[str], prefix: str) -> DataFrame:
    """The lag for rows dealt to consecutive ranges ``_range`` of each key."""
    w = Window.partitionBy(*keys, "_range").orderBy(*order)
    inner = data.select("*", *[F.lag(c).over(w).alias(prefix + c) for c in cols],
                        (F.row_number().over(w) == 1).alias("_first"))
    # one row per (key, range), aggregated map-side before its (small) shuffle
    last = data.groupBy(*keys, "_range").agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_last"))
    carry = last.select(*[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_range").alias("_at"),
                        F.lag("_last").over(Window.partitionBy(*keys).orderBy("_range")).alias("_carry"))
    same = F.col("_range") == F.col("_at")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    joined = inner.join(carry.where("_carry IS NOT NULL"), same, "left")
    return joined.select(
        *[F.col(c) for c in data.columns if c != "_range"],
        *[F.when(F.col("_first"), F.col(f"_carry.{c}")).otherwise(F.col(prefix + c)).alias(prefix + c) for c in cols])
