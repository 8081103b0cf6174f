"""The few file system calls the driver makes, through Hadoop's file system of
the path, so any store that Spark reaches works. Errors are raised."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a directory tree; nothing happens if it is not there."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def listed(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """(path, bytes) of the files that a glob pattern names."""
    fs, p = _fs(spark, pattern)
    return [(f.getPath().toString(), f.getLen()) for f in fs.globStatus(p) or []]


def size_of(spark: SparkSession, path: str) -> tuple[int, int]:
    """Data files that a write left below a folder, at any depth: their number
    and bytes. The store sums them, in one call."""
    fs, p = _fs(spark, path)
    found = fs.getContentSummary(p)
    marks = fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))  # empty
    return found.getFileCount() - int(marks), found.getLength()


def name_of(path: str) -> str:
    """A path without its scheme and host, to compare what a listing gives."""
    return re.sub(r"^[a-z][a-z0-9+.-]*:(//[^/]*)?", "", path).rstrip("/")


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)
