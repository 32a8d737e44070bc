"""Spark session helpers.

Scratch data (lake fixtures, staged loads) always lives under the shared folder that
the cluster names in ``spark.checkpoint.dir``.  Only when that is unset — local tests —
do we create one ourselves.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # splits small enough that a table keeps every core busy and a partition fits in memory
    "spark.sql.files.maxPartitionBytes": "32m",
    # the JVM never compiles methods above 8,000 bytes: stages whose generated code is longer run
    # as split projections instead of being interpreted
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", app: str = "tamarind", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, use the cluster's own session and conf."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("TAMARIND_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared scratch folder: the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting (tests) gets a fresh local folder; on a
    cluster a machine-local folder would lose data, so the missing setting is an error.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if not cur:
        cur = spark.conf.get("spark.checkpoint.dir", None)
        if not cur:
            if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            cur = tempfile.mkdtemp(prefix="tamarind-ckpt-")
        sc.setCheckpointDir(cur)
        cur = sc.getCheckpointDir() or cur
    return cur.rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists on its file system (Hadoop FS API, any scheme)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder (Hadoop FS API, any scheme)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [f.getPath().getName() for f in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)]


def file_count(spark: SparkSession, path: str) -> int:
    """Number of files in a folder and those below it (Hadoop FS API, any scheme); the names are not kept."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return int(p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getFileCount())


def create_file(spark: SparkSession, path: str, text: str) -> None:
    """A new small file (Hadoop FS API, any scheme); an error when it exists already."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, False)
    out.write(bytearray(text.encode()))
    out.close()


def read_file(spark: SparkSession, path: str) -> str:
    """The text of a small file (Hadoop FS API, any scheme)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def move_path(spark: SparkSession, path: str, to: str) -> None:
    """Moves a file to a new place on the same file system (Hadoop FS API, any scheme)."""
    a, b = (spark._jvm.org.apache.hadoop.fs.Path(x) for x in (path, to))
    fs = a.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"could not move {path} to {to}")


def remove_path(spark: SparkSession, path: str, on_exit: bool = False) -> None:
    """Delete a scratch path now, or when the driver ends (Hadoop FS API, any scheme)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if on_exit:
        fs.deleteOnExit(p)
    else:
        fs.delete(p, True)
