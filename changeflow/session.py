"""Spark session defaults and the shared checkpoint location."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this library expects. Sizes are left to the cluster;
# only semantics-relevant options are forced here.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, app_name: str = "changeflow",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the library defaults applied.

    On a cluster, call without ``master`` so the launcher's settings win.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from ``spark.checkpoint.dir`` (set by the cluster). Only in local mode,
    as in tests, is a scratch folder made when it is unset: elsewhere executors could not see it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="changeflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:         # each call would make another folder
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system that Spark reads; none if it is missing."""
    at, fs = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def remove_folder(spark: SparkSession, path: str) -> None:
    at, fs = _file_system(spark, path)
    fs.delete(at, True)


def replace_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put the folder ``source`` in the place of ``target``."""
    at, fs = _file_system(spark, source)
    to = _file_system(spark, target)[0]
    fs.delete(to, True)
    fs.mkdirs(to.getParent())
    if not fs.rename(at, to):
        raise OSError(f"{source} could not be renamed to {target}")


def publish_folder(spark: SparkSession, source: str, target: str) -> None:
    """Rename the folder ``source`` to ``target``, unless that is there already: then it stays as it is."""
    at, fs = _file_system(spark, source)
    to = _file_system(spark, target)[0]
    if fs.exists(to):
        fs.delete(at, True)
        return
    fs.mkdirs(to.getParent())
    if not fs.rename(at, to):
        raise OSError(f"{source} could not be renamed to {target}")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint root."""
    root = checkpoint_root(spark)
    return os.path.join(root, f"{name}-{os.urandom(6).hex()}")
