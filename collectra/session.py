"""Spark session defaults and the shared output folder.

Cluster jobs write intermediate tables and sinks under the folder the cluster
names in ``spark.checkpoint.dir``.  Only when that is unset (local runs, tests)
do we create one of our own.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "collectra", partition_mb: int = 128) -> SparkSession:
    """Session with AQE (coalescing + skew-join splitting) and UTC time.

    Settings given to the cluster (spark-submit ``--conf``, spark-defaults)
    win over ours; we fill only the ones left unset.  Arguments passed here
    explicitly (tests, bench) are applied as given.

    ``shuffle_partitions`` is the pre-AQE upper bound: it should be about the
    largest shuffle stage's bytes / ``partition_mb`` (a stage shuffling 10 TB
    at 128 MB needs ~80k).  When neither the cluster nor the caller sets it,
    we use four per core (at least 200); AQE then coalesces small partitions
    towards ``partition_mb`` and splits skewed join partitions at runtime.
    Scan splits follow ``spark.sql.files.maxPartitionBytes`` (same size).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
        if master.startswith("local"):  # nothing but this process sets these
            b = (b.config("spark.ui.enabled", "false")
                 .config("spark.ui.showConsoleProgress", "false")
                 .config("spark.driver.memory", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    cluster = spark.sparkContext.getConf()
    cores = spark.sparkContext.defaultParallelism
    defaults = {
        "spark.sql.shuffle.partitions": str(max(200, 4 * cores)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{partition_mb}m",
        "spark.sql.files.maxPartitionBytes": f"{partition_mb}m",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in defaults.items():
        if not cluster.contains(key):
            spark.conf.set(key, value)
    if shuffle_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    # results must not depend on the cluster's locale: dates are cut in UTC
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder shared by all executors; taken from ``spark.checkpoint.dir``.

    If a local session has none (local runs, tests) a fresh private folder is
    created and registered as the checkpoint dir, so ``checkpoint()`` and our
    written tables land in the same place.  On a cluster that would be one
    folder per machine, so there a missing setting is an error.
    """
    root = spark.conf.get(_CKPT_KEY, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir is unset on {master}: name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="collectra-")
        spark.conf.set(_CKPT_KEY, root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, *parts: str) -> str:
    return "/".join([shared_root(spark), "collectra", *parts])


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Remove ``path`` when the application ends."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)


def fresh_path(spark: SparkSession, *parts: str) -> str:
    """A new, unused scratch path under the shared root; it goes when the application ends."""
    scratch = shared_path(spark, "scratch", spark.sparkContext.applicationId)
    p = spark._jvm.org.apache.hadoop.fs.Path(scratch)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)
    delete_on_exit(spark, scratch)
    return "/".join([scratch, *parts, uuid.uuid4().hex])

