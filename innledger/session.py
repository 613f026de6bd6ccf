"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """Session for tests and benchmarks. On a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("innledger")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster.

    Only a single-machine session may fall back to a temporary folder of that machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="innledger-")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder, never used before."""
    return f"{shared_folder(spark)}/innledger/{purpose}-{uuid.uuid4().hex}"


def _hadoop_path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if it does not exist."""
    folder, fs = _hadoop_path(spark, path)
    if not fs.exists(folder):
        return []
    return [status.getPath().getName() for status in fs.listStatus(folder)]


def content_stamp(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Bytes, files and change time of a table: differs when its files were replaced."""
    folder, fs = _hadoop_path(spark, path)
    summary = fs.getContentSummary(folder)
    return summary.getLength(), summary.getFileCount(), fs.getFileStatus(folder).getModificationTime()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder that is no longer read, if it is there."""
    folder, fs = _hadoop_path(spark, path)
    fs.delete(folder, True)
