"""Paths on the file system Spark writes to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a finished write lies there; a folder left by a lost run does not count."""
    fs, target = _fs(spark, path)
    return fs.exists(spark._jvm.org.apache.hadoop.fs.Path(target, "_SUCCESS"))


def replace_folder(spark: SparkSession, staged: str, path: str) -> None:
    """Put a staged write in the place of ``path``; the old table is set aside until the new one is in place."""
    fs, target = _fs(spark, path)
    source = spark._jvm.org.apache.hadoop.fs.Path(staged)
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.replaced")
    if not fs.exists(source):
        raise OSError(f"nothing is staged at {staged}")
    had = fs.exists(target)
    if had:
        if fs.exists(aside):
            fs.delete(aside, True)
        if not fs.rename(target, aside):
            raise OSError(f"cannot set {path} aside")
    if not fs.rename(source, target):
        if had:
            fs.rename(aside, target)
        raise OSError(f"cannot move {staged} to {path}")
    if had:
        fs.delete(aside, True)
