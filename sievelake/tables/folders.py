"""Folders on the cluster's file system, whichever it is."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _resolve(spark, path)
    return fs.exists(target)


def glob(spark: SparkSession, pattern: str, empty: bool = False) -> list[str]:
    """Paths that match, sorted; with ``empty`` only files without content."""
    target, fs = _resolve(spark, pattern)
    return sorted(
        found.getPath().toString()
        for found in fs.globStatus(target) or []
        if not empty or (found.isFile() and found.getLen() == 0)
    )


def modified(spark: SparkSession, path: str) -> float:
    """Last modification in seconds since the epoch."""
    target, fs = _resolve(spark, path)
    return fs.getFileStatus(target).getModificationTime() / 1000


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below the path."""
    target, fs = _resolve(spark, path)
    return fs.getContentSummary(target).getLength()


def touch(spark: SparkSession, path: str) -> None:
    """An empty file at the path."""
    target, fs = _resolve(spark, path)
    fs.create(target, True).close()


def move(spark: SparkSession, path: str, target: str) -> None:
    """Rename a folder; an error if the target is there."""
    source, fs = _resolve(spark, path)
    there, _ = _resolve(spark, target)
    fs.mkdirs(there.getParent())
    if fs.exists(there) or not fs.rename(source, there):
        raise OSError(f"cannot move {path} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    target, fs = _resolve(spark, path)
    fs.delete(target, True)


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one the cluster names in ``spark.checkpoint.dir``.

    Without that setting, as in local tests, a temporary folder takes its place.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="sievelake-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
