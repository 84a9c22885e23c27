"""Session construction and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


UTC_NAMES = {"UTC", "Z", "GMT", "ETC/UTC", "ETC/GMT", "UCT", "ETC/UCT", "ZULU", "+00:00", "UNIVERSAL"}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tableflow", extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks; on a cluster use the provided session."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Check the setting the rules depend on; the session is the caller's and is not changed."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone.upper() not in UTC_NAMES:
        raise ValueError(f"spark.sql.session.timeZone is {zone!r}; the date rules need UTC")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting points at shared storage and is used as is; unset there, it
    is an error, since executors do not share local folders. Only in local mode (tests,
    a laptop) a fresh local folder is made and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        if not current:
            sc.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    if current:
        # setCheckpointDir appends a per-application uuid folder; use its parent
        return os.path.dirname(current.rstrip("/"))
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tableflow-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return "/".join([root, "tableflow", *parts, uuid.uuid4().hex])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does the path exist on its file system (local, HDFS, object store)?"""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))
