"""Folders and files on any Hadoop-compatible file system, listed by the driver.

Only names and sizes pass through here; no table content does.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def any_file(spark: SparkSession, pattern: str) -> bool:
    """Whether a path or glob matches a file."""
    found = _fs(spark, pattern).globStatus(_path(spark, pattern)) or []
    return any(status.isFile() for status in found)


def holds_file(spark: SparkSession, path: str) -> bool:
    """Whether a folder, or one below it, holds a file that readers see; the search ends with the first."""
    if not exists(spark, path):
        return False
    found = _fs(spark, path).listFiles(_path(spark, path), True)
    while found.hasNext():
        if not found.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def files_below(spark: SparkSession, path: str) -> list[str]:
    """Full URIs of all files in a folder and below it; empty if absent."""
    if not exists(spark, path):
        return []
    found, names = _fs(spark, path).listFiles(_path(spark, path), True), []
    while found.hasNext():
        names.append(found.next().getPath().toString())
    return sorted(names)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``, in order; empty if absent."""
    if not exists(spark, path):
        return []
    found = _fs(spark, path).listStatus(_path(spark, path))
    return sorted(status.getPath().getName() for status in found if status.isDirectory())


def qualified(spark: SparkSession, path: str) -> str:
    """Absolute URI with scheme, so that executors resolve the same place."""
    return _fs(spark, path).makeQualified(_path(spark, path)).toString()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace one small text file."""
    stream = _fs(spark, path).create(_path(spark, path), True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)
