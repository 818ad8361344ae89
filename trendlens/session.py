"""Session construction and cluster-wide settings."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every trendlens job relies on.  UTC pins hour/day-of-week of
# zoned timestamps; AQE coalesces small shuffles and splits skewed joins.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "trendlens",
                  shuffle_partitions: int | None = None,
                  conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the trendlens defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only where none is set.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS, S3, ...)
    and is used as is.  Only a ``local`` master without it (a unit test) gets a
    fresh local folder; any other master raises, since executors could not see it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="trendlens-chk-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, "trendlens", *parts])


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a written intermediate that is no longer read."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def new_scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder (one per call)."""
    import uuid
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


__all__ = ["build_session", "ensure_checkpoint_dir", "scratch_path",
           "new_scratch_path", "remove_path", "DEFAULT_CONF"]
