"""What lies at a path, asked of its own file system (an unreadable table is not an absent one)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def is_folder(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, sorted; none when it does not exist."""
    p, fs = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Move a file or folder within its file system, making the folder above it."""
    p, fs = _fs(spark, old)
    target, _ = _fs(spark, new)
    fs.mkdirs(target.getParent())
    if not fs.rename(p, target):
        raise OSError(f"cannot move {old} to {new}")
