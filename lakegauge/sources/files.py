"""Small file-system helpers on the cluster's own file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, location: str) -> bool:
    fs, path = _path(spark, location)
    return fs.exists(path)


def names(spark: SparkSession, location: str) -> set[str]:
    """What lies in a folder; nothing if there is none."""
    fs, path = _path(spark, location)
    return {f.getPath().getName() for f in fs.listStatus(path)} if fs.exists(path) else set()


def make_dir(spark: SparkSession, location: str) -> None:
    fs, path = _path(spark, location)
    fs.mkdirs(path)


def delete(spark: SparkSession, location: str) -> None:
    fs, path = _path(spark, location)
    fs.delete(path, True)


def rename(spark: SparkSession, location: str, target: str) -> None:
    """One folder or file, within its file system."""
    fs, path = _path(spark, location)
    if not fs.rename(path, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"cannot rename {location} to {target}")


def has_parts(spark: SparkSession, location: str) -> bool:
    """Whether a folder holds a data file."""
    fs, path = _path(spark, location)
    return bool(fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, "part-*")))
