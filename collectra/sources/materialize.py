"""Write-once intermediate tables in the shared folder.

A derived table used by many downstream outputs (the cleaned portfolio,
the attributed contact log) is written once as parquet under the shared
root and re-read; this cuts lineage, and unlike ``cache()`` the result
survives the loss of the executors that computed it.
"""

from __future__ import annotations

import hashlib
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

from collectra.session import delete_on_exit, shared_path

_RUN = uuid.uuid4().hex[:12]  # distinguishes processes sharing the folder
_DONE: dict = {}
_LOCKS: dict = {}
_GUARD = threading.Lock()


def input_version(spark: SparkSession, folder: str) -> str:
    """Digest of the files under an input folder: paths, lengths, times of change."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    seen = []
    while files.hasNext():
        f = files.next()
        seen.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha1("\n".join(sorted(seen)).encode()).hexdigest()[:16]


def _hash(name: str, key: str) -> str:
    return hashlib.sha1(f"{name}|{key}".encode()).hexdigest()[:16]


def _memo(spark: SparkSession, name: str, key: str) -> tuple:
    return id(spark), name, _hash(name, key)


def prepared(spark: SparkSession, name: str, key: str, make, version: str = ""):
    """``make(path)`` once per session and input version under ``views/<name>-<hash>``.

    What it returns is kept; the folder is removed when the application ends."""
    h, memo = _hash(name, key), _memo(spark, name, key)
    with _GUARD:
        lock = _LOCKS.setdefault(memo, threading.Lock())
    with lock:  # concurrent callers wait for one writer
        done = _DONE.get(memo)
        if done is None or done[1] != version:
            path = shared_path(spark, "views", f"{name}-{h}-{version}-{_RUN}-{id(spark):x}")
            done = _DONE[memo] = (make(path), version)
            delete_on_exit(spark, path)
    return done[0]


def materialized(spark: SparkSession, name: str, key: str, build, version: str = "") -> DataFrame:
    """``build()`` written once per session and input version."""
    def make(path):
        build().write.mode("overwrite").parquet(path)
        # the table is immutable once written: resolve its scan once
        return spark.read.parquet(path)
    return prepared(spark, name, key, make, version)


def stored(spark: SparkSession, name: str, key: str, build, version: str = "") -> DataFrame:
    """The table that :func:`materialized` has written, if it has; else ``build()``, not written.

    For a query that reads the table once: writing all its columns would cost it
    more than the few that it asks for, which Spark prunes the plan to."""
    done = _DONE.get(_memo(spark, name, key))
    return done[0] if done is not None and done[1] == version else build()


def forget(spark: SparkSession | None = None):
    """Drop the memo (e.g. after the input folder changed)."""
    for k in list(_DONE):
        if spark is None or k[0] == id(spark):
            del _DONE[k]
