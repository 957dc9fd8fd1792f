"""Structured Streaming jobs (STR1-6, SNK2).

* STR1: tumbling bucket mean per service with a watermark.
* STR2 + STR6: per micro-batch scoring (``foreachBatch``) against static
  baseline statistics, one idempotent Parquet folder per batch.
* STR3: all trailing features of the bucket points per service, and
* STR4: counter rates over sliding windows; see ``streaming.stateful``.
* STR5: duplicates dropped within the watermark.

Production runs use ``trigger(processingTime="30 seconds")``; tests and the
registered queries use ``availableNow`` so a stream processes the whole input
and stops.  Output and checkpoints live under the cluster's checkpoint
folder (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewise.functions.columns import SIGMA_K, as_utc_instant, epoch_seconds, to_naive
from tracewise.session import ensure_checkpoint_dir
from tracewise.streaming import stateful

EVENTS_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                 "value double, props string")


def _scratch(spark: SparkSession, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), f"stream-{name}-{uuid.uuid4().hex[:8]}")


def read_events(spark: SparkSession, source_dir: str, pattern: str = "*.parquet",
                watermark: str = "1 day", max_files: int | None = None) -> DataFrame:
    """File stream of events from a folder; ``ts`` cast to ``timestamp``
    (watermarks need it) and duplicates within the watermark dropped (STR5)."""
    r = spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", pattern)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    s = r.parquet(source_dir)
    return (s.withColumn("ts", as_utc_instant("ts"))
            .withWatermark("ts", watermark)
            .dropDuplicatesWithinWatermark(["event_id"]))


def bucket_means(events: DataFrame, bucket: str = "6 hours") -> DataFrame:
    """STR1: streaming form of the service bucket aggregate."""
    return (events.groupBy(
        F.concat(F.lit("10.0.0."), (F.col("user_id") % 2).cast("string"), F.lit(":8080")).alias("ip_port"),
        F.concat(F.lit("svc_"), (F.col("user_id") % 5).cast("string")).alias("server_name"),
        F.window("ts", bucket).alias("w"))
        .agg(F.count(F.lit(1)).cast("double").alias("connection_count"),
             F.avg("value").alias("response_time"),
             F.count_if(F.col("event_type") == "error").cast("double").alias("eps")))


def _run_versions(stream: DataFrame, name: str, prepare=lambda batch: batch) -> DataFrame:
    """Run an update-mode stream; every micro-batch is written to its own
    ``batch=<id>`` folder by overwriting, so a replayed batch replaces its
    first try.  Returns all versions, with the batch that wrote them."""
    spark = stream.sparkSession
    out, ckpt = _scratch(spark, name), _scratch(spark, name + "-ckpt")

    def write(batch: DataFrame, batch_id: int):
        prepare(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    q = (stream.writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


def newest_versions(log: DataFrame, keys: list[str]) -> DataFrame:
    """The last written version of each key."""
    values = [c for c in log.columns if c not in (*keys, "batch")]
    latest = log.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col("batch")).alias("_v"))
    return latest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])


def run_upsert_log(agg: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Run an aggregation stream in update mode and return the latest version
    of each key - equal to the batch aggregate once the input is consumed."""
    return newest_versions(_run_versions(agg, name), keys)


def score_stream(events: DataFrame, stats: DataFrame, name: str, bucket: str = "6 hours") -> DataFrame:
    """STR2 + STR6 + SNK2: every micro-batch's bucket aggregates are joined
    with the static baseline stats and 3-sigma flagged.  A bucket that gets
    more events later is scored again; the newest version of each counts."""
    def scored(batch: DataFrame) -> DataFrame:
        j = batch.join(stats, ["ip_port", "server_name"], "left")
        flag = (F.abs(F.col("connection_count") - F.col("connection_count_mean"))
                > F.lit(SIGMA_K) * F.col("connection_count_std"))
        return j.select("ip_port", "server_name", to_naive("w.start").alias("ts"), "connection_count",
                        F.coalesce(flag, F.lit(False)).alias("is_anomaly"))

    return newest_versions(_run_versions(bucket_means(events, bucket), name, scored), ["ip_port", "server_name", "ts"])


STAGE_FILES = 8


def stage_rows(rows: DataFrame, name: str, parts: int = 4, late_by: str | None = None) -> tuple[str, int]:
    """``rows`` (with a ``ts``) as ``parts`` consecutive time ranges of up to
    ``STAGE_FILES`` files, written one range after the other, and the length
    of a range in seconds.  A file stream that takes ``STAGE_FILES`` files per
    trigger sees the ranges in order.

    With ``late_by``, a column that identifies a row, a tenth of the rows (by
    hash) comes one range late and another tenth comes a second time one range
    later; else no row is later than a range."""
    out = _scratch(rows.sparkSession, name)
    b = rows.select(F.min("ts"), F.max("ts"), F.min(epoch_seconds("ts")), F.max(epoch_seconds("ts"))).first()
    if b[0] is None:
        rows.write.parquet(out)
        return out, 1
    width = (b[3] - b[2]) // parts + 1

    def border(k):
        return F.lit(b[0]).cast("timestamp_ntz") + F.expr(f"INTERVAL {k * width} SECONDS")

    # the bounds are plain comparisons with ts, so that each range reads only its own part of the table
    for k in range(parts):
        part = rows.filter(F.col("ts") < border(k + 1)) if k < parts - 1 else rows
        if late_by is None:
            part = part.filter(F.col("ts") >= border(k)) if k else part
        else:
            part = part.filter(F.col("ts") >= border(k - 1)) if k > 1 else part
            late = F.pmod(F.xxhash64(late_by), F.lit(10))
            own, before = F.col("ts") >= border(k), F.col("ts") < border(k)
            last = k == parts - 1
            part = part.filter((own & (F.lit(last) | (late != 3))) | (before & late.isin(3, 7)))
        part.repartition(STAGE_FILES).write.mode("append").parquet(out)
    return out, width


def stage_events(spark: SparkSession, sf_dir: str, parts: int = 4, late: bool = False) -> tuple[str, int]:
    """The events table as a source of a stream, see :func:`stage_rows`."""
    events = spark.read.parquet(os.path.join(sf_dir, "events.parquet")) \
        .select("event_id", "ts", "user_id", "event_type", "value", "props")
    return stage_rows(events, "events", parts, "event_id" if late else None)


def close_stage(folder: str, like: DataFrame, after_seconds: int) -> None:
    """End a staged stream: one row with the last ``ts`` plus ``after_seconds``
    and nulls otherwise moves the watermark past all others.  Its own group
    is never complete, so it shows up nowhere."""
    end = like.select((F.max("ts") + F.expr(f"INTERVAL {after_seconds} SECONDS")).alias("ts"))
    cols = [F.col("ts") if c == "ts" else F.lit(None).cast(like.schema[c].dataType).alias(c) for c in like.columns]
    end.where("ts IS NOT NULL").select(*cols).coalesce(1).write.mode("append").parquet(folder)


def run_appended(stream: DataFrame, name: str) -> DataFrame:
    """Run an append-mode stream into Parquet files until its input is
    consumed, and read them."""
    spark = stream.sparkSession
    out, ckpt = _scratch(spark, name), _scratch(spark, name + "-ckpt")
    q = stateful.with_rocksdb(spark, lambda: stream.writeStream.outputMode("append").format("parquet").option("path", out)
                              .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def service_points(events: DataFrame, bucket: str = "6 hours") -> DataFrame:
    """Bucket points (keys, ts, connection_count) of an event stream as an
    append-mode aggregate emits them; ``ts`` is the end of the bucket, minus
    a microsecond, and keeps the watermark."""
    return bucket_means(events, bucket).select("ip_port", "server_name", F.window_time("w").alias("ts"), "connection_count")


def read_samples(spark: SparkSession, folder: str, schema: str, keys: list[str], watermark: str) -> DataFrame:
    """File stream of counter samples (keys, ts, value); samples that come
    again within the watermark are dropped (STR5)."""
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", STAGE_FILES).parquet(folder)
    return s.withColumn("ts", as_utc_instant("ts")).withWatermark("ts", watermark) \
        .dropDuplicatesWithinWatermark([*keys, "at"])


def sliding_counts(events: DataFrame, length: str = "6 hours", slide: str = "3 hours") -> DataFrame:
    """STR4: sliding-window request counts per event type."""
    return events.groupBy(F.window("ts", length, slide).alias("w"), "event_type").agg(
        F.count(F.lit(1)).alias("n"))
