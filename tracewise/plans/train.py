"""Stored train state and prediction from it (JOB1, JOB2, SNK5, SRC8).

``train`` writes one Parquet table per part of the state into a folder of its
own, a generation.  A generation counts only once its row is in the manifest,
and that row, a single small file, is written last.  ``predict`` and ``cycle``
look up the newest generation once and read all tables from it, so they see one
whole generation while a train runs or after one has died; they fit nothing.

Baseline points are folded in period by period (``fold``): each day's
mergeable statistics replace that day's rows and nothing else."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewise.operators import baseline, correlate, forest, normalize
from tracewise.operators.detect import flag_3sigma, flag_rates
from tracewise.plans import service
from tracewise.session import cut_lineage, ensure_checkpoint_dir
from tracewise.sources.bindings import KEYS, METRICS, metric_phases, metric_points, with_service_id

TABLES = ["baseline_stats", "feature_stats", "forest_nodes", "offset", "corr", "corr_series", "directions"]
CONTAMINATION = 0.01
STEP = 6 * 3600


def new_root(spark: SparkSession) -> str:
    """A folder for a train state, below the cluster's checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), f"train-{uuid.uuid4().hex[:8]}")


def _manifest(spark: SparkSession, root: str) -> DataFrame | None:
    from pyspark.errors import AnalysisException
    try:
        return spark.read.schema("generation long, folder string, tables array<string>").parquet(f"{root}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def newest(spark: SparkSession, root: str) -> str | None:
    """Folder of the newest whole generation."""
    m = _manifest(spark, root)
    row = None if m is None else m.orderBy(F.desc("generation")).select("folder").first()
    return row and f"{root}/{row['folder']}"


def publish(spark: SparkSession, root: str, folder: str, tables: list[str]) -> None:
    """Make a written folder the newest generation."""
    m = _manifest(spark, root)
    last = 0 if m is None else m.agg(F.max("generation")).first()[0] or 0
    spark.createDataFrame([(last + 1, folder, tables)], "generation long, folder string, tables array<string>") \
        .coalesce(1).write.mode("append").parquet(f"{root}/manifest")


def train(spark: SparkSession, sf_dir: str, tables: list[str] | None = None, root: str | None = None) -> str:
    """Fit on the baseline and store ``tables`` (all by default) as the next
    generation of ``root`` (a new folder by default); the root."""
    from tracewise.plans.queries_models import Z_FEATS, _key, directions_of
    root = root or new_root(spark)
    folder = f"generation-{uuid.uuid4().hex[:8]}"
    tables = tables or TABLES
    base = cut_lineage(metric_phases(spark, sf_dir)[0])

    def put(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{root}/{folder}/{name}")
        return spark.read.parquet(f"{root}/{folder}/{name}")

    if "baseline_stats" in tables:
        put("baseline_stats", normalize.baseline_stats(base, KEYS, ["connection_count"]))
    if {"feature_stats", "forest_nodes", "offset"} & set(tables):
        raw = cut_lineage(service.raw_features(base))
        stats = put("feature_stats", normalize.baseline_stats(raw, KEYS, service.FEATURES))
    if {"forest_nodes", "offset"} & set(tables):
        z = cut_lineage(_key(normalize.zscore(raw, stats, KEYS, service.FEATURES)))
        nodes = put("forest_nodes", forest.fit(z, ["_key"], Z_FEATS, seed=42))
        if "offset" in tables:
            q = forest.offset(cut_lineage(forest.score(z, nodes, Z_FEATS)), CONTAMINATION)
            put("offset", spark.range(1).select(F.lit(CONTAMINATION).alias("contamination"),
                                                q.cast("double").alias("offset")))
    if {"corr", "corr_series", "directions"} & set(tables):
        pairs, series = _corr(base)
        corr = put("corr", pairs)
        put("corr_series", series)
        if "directions" in tables:
            put("directions", directions_of(base, corr))
    publish(spark, root, folder, tables)
    return root


def _corr(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    s = with_service_id(points).select(F.col("service_id").alias("id"), "ts", F.col("connection_count").alias("x"))
    return correlate.corr_state(s, "id", "ts", "x", STEP)


def load(spark: SparkSession, root: str, name: str, generation: str | None = None) -> DataFrame:
    """A table of the newest (or the named) generation."""
    return spark.read.parquet(f"{generation or newest(spark, root)}/{name}")


def predict(spark: SparkSession, sf_dir: str, root: str, generation: str | None = None,
            points: DataFrame | None = None) -> DataFrame:
    """Scores and labels of the problem window from the stored state."""
    from tracewise.plans.queries_models import Z_FEATS
    at = generation or newest(spark, root)
    prob = metric_phases(spark, sf_dir)[1] if points is None else points
    z = normalize.zscore(service.raw_features(prob), load(spark, root, "feature_stats", at), KEYS, service.FEATURES)
    q = load(spark, root, "offset", at).first()["offset"]
    s = forest.label(forest.score(z, load(spark, root, "forest_nodes", at), Z_FEATS), F.lit(q))
    return s.select(*KEYS, "ts", "connection_count", "hour", "anomaly_score", "decision", "is_outlier", "is_anomaly",
                    F.col("is_outlier").cast("int").alias("anomaly_multi"))


def cycle(spark: SparkSession, sf_dir: str, root: str) -> dict[str, DataFrame]:
    """JOB2, a whole scoring cycle from one stored generation: ``scores``,
    ``flags`` (three-sigma), ``corr_change``, ``worst`` (ranked services with
    rates and chains) and the plot tables ``scatter`` and ``bars``."""
    at = newest(spark, root)
    prob = cut_lineage(metric_phases(spark, sf_dir)[1])
    scores = cut_lineage(predict(spark, sf_dir, root, at, prob))
    metric = "connection_count"
    flags = flag_3sigma(service.with_diffs(prob, KEYS, [metric]), load(spark, root, "baseline_stats", at), KEYS, [metric],
                        delta_basis="diff")
    now, series = _corr(prob)
    change = correlate.corr_diff(now, load(spark, root, "corr", at), series, load(spark, root, "corr_series", at))
    rates = cut_lineage(flag_rates(with_service_id(scores), "service_id", {"is_outlier": "anomaly_rate"}))
    chains = service.causal_chains(rates, load(spark, root, "directions", at).filter("causes"))
    total = correlate.series_vs_total(
        with_service_id(prob).select(F.col("service_id").alias("id"), "ts", F.col(metric).alias("x")), "id", "ts", "x")
    sigma = flag_rates(with_service_id(flags), "service_id", {"sigma3": "sigma_rate"})
    worst = service.worst_services(rates.join(sigma, "service_id", "full"), chains, total)
    scatter = with_service_id(scores).select("service_id", "ts", F.col(metric).alias("value"), "is_anomaly", "is_outlier")
    return {"scores": scores, "flags": flags, "corr_change": change, "worst": worst, "scatter": scatter,
            "bars": worst.select("service_id", "anomaly_rate", "rank_score")}


def fold(spark: SparkSession, sf_dir: str, root: str, start: str | None, end: str | None) -> None:
    """Fold the days of [start, end) into the stored baseline: only their raw
    points are read, and only their rows replaced."""
    points = metric_points(spark, sf_dir, start=start, end=end).withColumn("day", F.to_date("ts"))
    state = baseline.period_state(points, KEYS, ["connection_count", *METRICS], "day")
    state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{root}/baseline")


def folded(spark: SparkSession, root: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """The stored state rows of the days in [start, end)."""
    rows = spark.read.parquet(f"{root}/baseline")
    if start is not None:
        rows = rows.where(F.col("day") >= F.lit(start).cast("date"))
    return rows if end is None else rows.where(F.col("day") < F.lit(end).cast("date"))
