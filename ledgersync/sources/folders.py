"""Folders of batches, listed and removed through the file system that Spark writes to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):  # noqa: ANN202
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def names_below(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names, without ``prefix``, of the folders directly below ``path`` that begin with it; one listing, files unseen."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()]
    return sorted(n[len(prefix) :] for n in found if n.startswith(prefix))


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Move a finished folder to ``target`` in the same file system, in place of what lies there."""
    fs, where = _at(spark, target)
    fs.mkdirs(where.getParent())
    fs.delete(where, True)
    if not fs.rename(_at(spark, source)[1], where):
        raise OSError(f"{source} could not be moved to {target}")
