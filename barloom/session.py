"""Session settings and the shared scratch folder."""

from __future__ import annotations

import hashlib
import re
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "barloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch(spark: SparkSession, *parts: str) -> str:
    """A folder for written intermediate tables, under the cluster's `spark.checkpoint.dir`.

    Only a local session (tests) may name none: it gets a fresh local one, which is then
    stored in the session so that every later call agrees. On a cluster that is an error, as
    executors would not see the driver's folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="barloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    tail = [p if len(p) < 60 and "/" not in p else hashlib.sha1(p.encode()).hexdigest() for p in parts]
    return "/".join([base.rstrip("/"), spark.sparkContext.applicationId, *tail])


def hadoop_path(spark: SparkSession, path: str):
    """(FileSystem, Path) of the cluster's file system for `path`."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = hadoop_path(spark, path)
    return fs.exists(hpath)


def delete(spark: SparkSession, path: str) -> bool:
    fs, hpath = hadoop_path(spark, path)
    return fs.delete(hpath, True)
