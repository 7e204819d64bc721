"""Spark session defaults and the shared working folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import SparkSession

# Settings every job here relies on. Time zone must be UTC: all instants are
# compared and bucketed as UTC and dates are UTC calendar dates.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # reliable checkpoints (prepared inputs, gold rows, new fact rows) are
    # removed from the shared folder once their DataFrames are collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "squall",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    On a cluster, ``master`` is left to spark-submit and the cluster's own
    settings (``spark.checkpoint.dir`` among them) are kept.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    conf.update(REQUIRED_CONF)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session-level settings to an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's shared checkpoint directory.

    The directory is read from the session (``spark.checkpoint.dir`` given at
    submit time, or one set earlier with ``setCheckpointDir``). Only when none
    is set and the master is local (local runs and tests) a private folder is
    created and registered, so later calls and ``DataFrame.checkpoint()``
    agree; on a cluster a missing setting is an error, never a machine-local
    folder.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if not base:
        base = sc.getConf().get("spark.checkpoint.dir", None)
        if not base:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder: checkpoints, fact "
                                   "staging and stream state must survive executor loss")
            base = tempfile.mkdtemp(prefix="squall-ckpt-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    return "/".join([base.rstrip("/"), *parts]) if parts else base


def fresh_dir(spark: SparkSession, prefix: str) -> str:
    """A new, unique folder under the shared directory, made through its own
    file system. It is removed when the driver process ends: DataFrames that
    read it lazily are in use until then."""
    path = shared_dir(spark, f"{prefix}-{uuid.uuid4().hex[:12]}")
    _file_system(spark, path).mkdirs(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path))
    atexit.register(_remove_at_exit, spark, path)
    return path


def _file_system(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(
        spark.sparkContext._jsc.hadoopConfiguration())


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a working folder that nothing reads any more."""
    _file_system(spark, path).delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path), True)


# Spark 4.1; other versions keep shuffle files until the driver collects its garbage
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(*sessions: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of an action go when it ends, on all executors.

    A frame that is run twice shuffles twice then; stage what is read again.
    Where several threads enter it for one session it may stay on, which only
    means that."""
    before = [(s, s.conf.get(_DROP_SHUFFLES, None)) for s in sessions]
    for s, _ in before:
        s.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        for s, value in reversed(before):
            s.conf.unset(_DROP_SHUFFLES) if value is None else s.conf.set(_DROP_SHUFFLES, value)


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    with suppress(Exception):  # the session may already be gone
        remove_dir(spark, path)


def spread(df, min_partitions: int | None = None):
    """Round-robin a frame whose source yields fewer splits than there are
    cores (e.g. one large file with few row groups), before CPU-heavy per-row
    work. A no-op when the source is already split wider (the cluster case)."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df
