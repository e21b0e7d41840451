"""K9: session factory.

No host names or credentials are baked in.  What the launcher set
(``spark-submit --conf``, a properties file) stays: the defaults below fill
in only keys it left unset, and a session that already runs is taken as it
is.  Settings passed in ``conf`` are the caller's and are applied.
"""
from __future__ import annotations

import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Defaults chosen for correctness first (UTC, ANSI on) and then for scale:
# AQE re-plans joins/partition counts from runtime statistics, splits
# skewed join partitions and coalesces small shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    # checkpoints are removed when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    app_name: str = "strata",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(conf or {})
    if SparkSession.getActiveSession() is None:
        SparkContext._ensure_initialized()  # so that SparkConf sees what the launcher passed
        launched = SparkConf()
        settings = {k: v for k, v in DEFAULT_CONF.items() if not launched.contains(k)} | settings
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where the session leaves it unset a local master gets a private
    temporary folder; on a cluster that would be another disk on each
    machine, so it is an error there.
    """
    return ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
