"""Spark session and lineage helpers.

Cluster settings (executor sizes, the shared checkpoint folder) come from
whoever launches the job; this module only fills in what is unset so that
tests and the local bench behave like a small cluster.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession

# Settings every job wants; applied only where the launcher left them unset.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "tracewise",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """A prepared session.  What the caller names here is set; the defaults
    only fill in what neither the launcher nor a running session has set."""
    named = dict(extra or {})
    if shuffle_partitions:
        named["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    running = SparkSession.getActiveSession()
    if running is None:
        launch = SparkConf(loadDefaults=False).setAll(list(named.items()))
        SparkContext._ensure_initialized(conf=launch)  # starts the JVM, which knows the launcher's settings
        known = dict(SparkConf().getAll())
        named = {k: v for k, v in _DEFAULTS.items() if k not in known} | named
    for k, v in named.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Make a session ready for tracewise jobs: checkpoint folder known and
    the package importable by the Python workers."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Ship this package to the executors' Python workers (``addPyFile``)
    once per SparkContext, so grouped-map / pandas UDF code and broadcast
    helpers import on any cluster, whatever the driver's working folder."""
    import zipfile

    import tracewise

    sc = spark.sparkContext
    if getattr(sc, "_tracewise_shipped", False):
        return
    pkg_dir = os.path.dirname(os.path.abspath(tracewise.__file__))
    out_dir = tempfile.mkdtemp(prefix="tracewise-pyfiles-")
    zpath = os.path.join(out_dir, "tracewise.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(zpath)
    sc._tracewise_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the one the launcher gave the context,
    else the one named by ``spark.checkpoint.dir``.

    Only in local mode, where one machine sees everything, is a scratch folder
    made if neither is set (tests, local bench); on a cluster that raises.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None)
    given = sc.getCheckpointDir()
    if given is not None:
        # Spark puts a folder of its own below the one it was given
        return path if path and _inside(given, path) else given
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to storage that all executors share")
        path = tempfile.mkdtemp(prefix="tracewise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def _inside(given: str, path: str) -> bool:
    def bare(p):
        return re.sub(r"^file:/*", "/", p).rstrip("/")
    return bare(given).startswith(bare(path))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
