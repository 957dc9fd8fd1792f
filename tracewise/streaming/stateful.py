"""Keyed event-time state: trailing features and counter rates on streams
(STR3, STR4).

Both are ``transformWithState`` operators with event-time timers, chained with
ordinary streaming aggregates in append mode:

* STR3: events -> bucket points (aggregate) -> the eight trailing features of
  ``operators.features`` per key.  The state of a key is its last
  ``2 * window`` values and the open block of at most ``window`` points.
* STR4: counter samples -> reset-aware increases per series, merged in time
  order -> rate over sliding windows (aggregate).  The state of a series is its
  last sample and the samples inside the watermark delay.

A point leaves an operator only when the watermark has passed it, so late and
replayed rows inside the delay give the same result as the batch operators.

State lives in the RocksDB store of the executors (``transformWithState``
needs it) and in the checkpoint folder."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tracewise.functions.columns import seconds_between, weekday_mon0
from tracewise.operators.features import FEATURES, LONG_WINDOW, SHORT_WINDOW

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def with_rocksdb(spark, start):
    """Call ``start()`` (which starts a query) with the RocksDB state store;
    the setting is taken back, a running query keeps it."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return start()
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def _full(values: list, n: int, fn):
    """``fn`` of the last ``n`` values; None until there are n, or with a gap."""
    last = values[-n:]
    return fn(last) if len(last) == n and None not in last else None


def _mean(values: list[float]) -> float:
    return sum(values) / len(values)


def point_features(trail: list, v, window: int, short: int) -> dict:
    """Features of one point after the values in ``trail`` (the last
    2 * window - 1 at least), and whether it is above the previous rolling max
    and mean; the block counts are not known yet."""
    now = [*trail, v]
    prev = trail[-1] if trail else None
    rmax, rmean = _full(now, window, max), _full(now, window, _mean)
    prev_max, prev_mean = _full(trail, window, max), _full(trail, window, _mean)
    old_max, old_mean = (_full(now[:-window], window, f) for f in (max, _mean))
    diff = None if v is None or prev is None else v - prev
    return {"rolling_mean": _full(now, short, _mean), "diff": diff,
            "rate_change": None if diff is None or not prev else diff / prev,
            "delta_max": None if rmax is None or old_max is None else rmax - old_max,
            "delta_avg": None if rmean is None or old_mean is None else rmean - old_mean,
            "ratio_avg": None if v is None or not prev_mean else v / prev_mean,
            "above_max": float(v is not None and prev_max is not None and v > prev_max),
            "above_avg": float(v is not None and prev_mean is not None and v > prev_mean)}


_HELD = ["rolling_mean", "diff", "rate_change", "delta_max", "delta_avg", "ratio_avg"]


class TrailingFeatures(StatefulProcessor):
    """Points of a key in time order -> points with features.

    A block of ``window`` points leaves when it is full, because its counts
    belong to all its points.  A key that gets no point for ``idle_ms`` of
    event time gives up its open block with the counts so far."""

    def __init__(self, keys: Sequence[str], window: int = LONG_WINDOW, short: int = SHORT_WINDOW, idle_ms: int = 0):
        self.n_keys, self.window, self.short, self.idle_ms = len(keys), window, short, idle_ms
        self.row = Row(*keys, "us", "v", *FEATURES)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState(
            "points", "n bigint, trail array<double>, above_max double, above_avg double, "
                      "us array<bigint>, v array<double>, held array<array<double>>")

    def _load(self) -> list:
        if self.state.exists():
            n, trail, above_max, above_avg, us, v, held = self.state.get()
            return [n, list(trail), above_max, above_avg, list(us), list(v), [list(h) for h in held]]
        return [0, [], 0.0, 0.0, [], [], []]

    def _emit(self, key: tuple, s: list) -> Iterator[Row]:
        for us, v, held in zip(s[4], s[5], s[6], strict=True):
            f = dict(zip(_HELD, held, strict=True)) | {"over_max_count": s[2], "over_avg_count": s[3]}
            yield self.row(*key[:self.n_keys], us, v, *[f[c] for c in FEATURES])
        s[4], s[5], s[6] = [], [], []

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        s = self._load()
        # the points that the watermark has just passed: a few buckets of one key
        points = sorted((r["us"], r["v"]) for r in rows)
        for us, v in points:
            f = point_features(s[1], v, self.window, self.short)
            s[0] += 1
            s[1] = [*s[1], v][-2 * self.window:]
            s[2] += f["above_max"]
            s[3] += f["above_avg"]
            s[4].append(us)
            s[5].append(v)
            s[6].append([f[c] for c in _HELD])
            if s[0] % self.window == 0:
                yield from self._emit(key, s)
                s[2], s[3] = 0.0, 0.0
        self.state.update(tuple(s))
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if points and s[4]:
            self.handle.registerTimer(points[-1][0] // 1000 + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        s = self._load()
        yield from self._emit(key, s)
        self.state.update(tuple(s))

    def close(self) -> None:
        pass


def trailing_features(points: DataFrame, keys: Sequence[str], metric: str, idle: str, window: int = LONG_WINDOW,
                      short: int = SHORT_WINDOW) -> DataFrame:
    """STR3 / DET2 on a stream of (string keys, ts, metric) points that arrive
    in time order per key (as an append-mode aggregate emits them).  ``ts``
    carries the watermark.  Same columns as ``operators.features.add_features``
    in its plain naming, NULL features filled with 0."""
    idle_ms = points.sparkSession.sql(f"SELECT unix_millis(timestamp_seconds(0) + INTERVAL {idle}) AS x").first()["x"]
    rows = points.select(*keys, "ts", F.unix_micros("ts").alias("us"), F.col(metric).cast("double").alias("v"))
    schema = ", ".join([*[f"{k} string" for k in keys], "us bigint", "v double", *[f"{c} double" for c in FEATURES]])
    out = rows.groupBy(*keys).transformWithState(
        TrailingFeatures(keys, window, short, idle_ms), schema, "Append", "EventTime")
    ts = F.timestamp_micros("us")
    return out.select(*keys, ts.alias("ts"), F.col("v").alias(metric), *[F.coalesce(c, F.lit(0.0)).alias(c) for c in FEATURES],
                      F.log1p("v").alias("conn_log"), F.hour(ts).alias("hour"), weekday_mon0(ts).alias("day_of_week"))


class CounterDeltas(StatefulProcessor):
    """Samples of a counter series, in any order inside the watermark delay ->
    the reset-aware increase between consecutive samples, in time order."""

    def __init__(self, keys: Sequence[str]):
        self.n_keys = len(keys)
        self.row = Row(*keys, "ev", "prev_us", "us", "d")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "us bigint, v double")
        self.open = handle.getValueState("open", "us array<bigint>, ev array<timestamp>, v array<double>")

    def _waiting(self) -> list[tuple]:
        return list(zip(*self.open.get(), strict=True)) if self.open.exists() else []

    def _keep(self, waiting: list[tuple]) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if waiting:
            waiting.sort(key=lambda w: w[0])
            self.open.update(tuple(list(c) for c in zip(*waiting, strict=True)))
            self.handle.registerTimer(waiting[0][0] // 1000)
        else:
            self.open.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        self._keep([*self._waiting(), *((r["us"], r["ev"], r["v"]) for r in rows)])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs()
        waiting = self._waiting()
        last = self.last.get() if self.last.exists() else None
        for us, ev, v in (w for w in waiting if w[0] // 1000 <= passed):
            if last is not None and us <= last[0]:
                continue  # the same sample again
            if last is not None:
                yield self.row(*key[:self.n_keys], ev, last[0], us, v if v < last[1] else v - last[1])
            last = (us, v)
        if last is not None:
            self.last.update(last)
        self._keep([w for w in waiting if w[0] // 1000 > passed])

    def close(self) -> None:
        pass


def counter_deltas(samples: DataFrame, keys: Sequence[str], ts: str = "ts", value: str = "value") -> DataFrame:
    """(keys, ev, prev_us, us, d) of a stream of counter samples with a
    watermark on ``ts``; ``ev``, just before the sample, is the event time."""
    rows = samples.select(*keys, F.col(ts), (F.col(ts) - F.expr("INTERVAL 1 MICROSECOND")).alias("ev"),
                          F.unix_micros(ts).alias("us"), F.col(value).cast("double").alias("v"))
    schema = ", ".join([*[f"{k} string" for k in keys], "ev timestamp", "prev_us bigint", "us bigint", "d double"])
    return rows.groupBy(*keys).transformWithState(
        CounterDeltas(keys), schema, "Append", "EventTime", eventTimeColumnName="ev")


def sliding_rates(samples: DataFrame, keys: Sequence[str], range_: str, step: str, ts: str = "ts",
                  value: str = "value") -> DataFrame:
    """STR4 / PQL1 on a stream: ``increase`` and ``rate`` of each series over
    the last ``range_`` at every ``step`` (as ``promql.increase_and_rate``)."""
    d = counter_deltas(samples, keys, ts, value)
    x = d.select(*keys, "prev_us", "us", "d", F.window("ev", range_, step).alias("w")) \
        .where(F.col("prev_us") > F.unix_micros("w.start"))
    g = x.groupBy(*keys, "w").agg(F.sum("d").alias("increase"), F.max("us").alias("_last"), F.min("prev_us").alias("_first"))
    return g.select(*keys, F.col("w.end").alias("ts"), "increase",
                    F.try_divide("increase", (F.col("_last") - F.col("_first")) / F.lit(1e6)).alias("rate"))
