"""Folder operations on whatever file system a path names (Hadoop FileSystem API)."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def _children(spark: SparkSession, path: str):
    fs, target = _open(spark, path)
    return fs.listStatus(target) if fs.exists(target) else []


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders; none when the folder is missing."""
    return sorted(s.getPath().getName() for s in _children(spark, path) if s.isDirectory())


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder; none when it is missing."""
    return sorted(s.getPath().getName() for s in _children(spark, path) if s.isFile())


def remove(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.delete(target, True)


def length(spark: SparkSession, uri: str) -> int:
    """Bytes of a file under the name that Spark lists it by."""
    fs, target = _open(spark, spark._jvm.java.net.URI(uri))
    return fs.getFileStatus(target).getLen()


def age_hours(spark: SparkSession, path: str) -> float:
    fs, target = _open(spark, path)
    return time.time() / 3600 - fs.getFileStatus(target).getModificationTime() / 3_600_000


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    fs, target = _open(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, content: str) -> None:
    """A small file that appears whole, and never in the place of another one.

    The move into place is exclusive where the file system's rename is (HDFS); elsewhere two writers
    within the same moment are not told apart.
    """
    fs, target = _open(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.draft")
    stream = fs.create(draft, True)
    stream.write(bytearray(content.encode()))
    stream.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise FileExistsError(f"{path} was written by another run")
