"""Spark session helpers.

Library code never creates its own session: it receives one.  ``get_spark``
is for scripts and tests only.  ``checkpoint_dir`` reads the shared folder the
cluster names in ``spark.checkpoint.dir`` and only falls back to a local
folder when the setting is absent (tests on one machine).
"""

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
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app: str = "meterlake", extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    b = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("SPARK_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(checkpoint_dir(spark))
    return spark


_LOCAL_CKPT: str | None = None


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    Uses ``spark.checkpoint.dir`` when the cluster names one.  Where it is
    unset, a one-machine master (``local``, ``local[n]``) gets one fresh folder
    under the system temp dir; on a cluster that folder would be another one
    on every machine, so it is an error there.
    """
    global _LOCAL_CKPT
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if master.split("[")[0] != "local":
            raise RuntimeError(f"set spark.checkpoint.dir to a folder all executors share (master {master})")
        if _LOCAL_CKPT is None:
            _LOCAL_CKPT = tempfile.mkdtemp(prefix="meterlake-ckpt-")
            spark.sparkContext.setCheckpointDir(_LOCAL_CKPT)
        d = _LOCAL_CKPT
    return d


def scratch_root(spark: SparkSession) -> str:
    """This application's part of the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/meterlake/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared checkpoint folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables, when all results that
    read them have been written.  For the end of a job."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def forget(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more; none if "" is given."""
    if path:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def source_stamp(spark: SparkSession, path: str) -> tuple:
    """Names, lengths and times of the files behind a path: changes whenever
    the source is rewritten.  Reads metadata only, through the path's own
    file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = [fs.getFileStatus(p)]
    if files[0].isDirectory():
        files = list(fs.listStatus(p))
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))
