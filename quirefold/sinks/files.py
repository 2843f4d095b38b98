"""Small file operations on whatever file system the path is on."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def delete_matching(spark: SparkSession, pattern: str) -> None:
    """Delete what lies under a path with wildcards."""
    found = _fs(spark, pattern).globStatus(_path(spark, pattern))
    for status in found or []:
        delete(spark, status.getPath().toString())


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a partition column, from the names of its directories."""
    names = [status.getPath().getName() for status in _fs(spark, path).listStatus(_path(spark, path))]
    return sorted(name.split("=", 1)[1] for name in names if name.startswith(f"{column}="))


def modified_millis(spark: SparkSession, path: str) -> int:
    return _fs(spark, path).getFileStatus(_path(spark, path)).getModificationTime()


def touch(spark: SparkSession, path: str) -> None:
    """Set the time of modification to now."""
    _fs(spark, path).setTimes(_path(spark, path), int(time.time() * 1000), -1)


def read_text(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that must not exist yet; False if it does."""
    try:
        stream = _fs(spark, path).create(_path(spark, path), False)
    except Exception:
        if exists(spark, path):
            return False
        raise
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    return True


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file in one step: readers see the old or the new text.

    The step is a rename, atomic on HDFS and local disks; an object store needs one whose
    connector renames atomically.
    """
    jvm = spark._jvm
    fresh = f"{path}.{uuid.uuid4().hex}"
    create_new(spark, fresh, text)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _path(spark, path).toUri(), spark._jsc.hadoopConfiguration()
    )
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    source, target = (context.makeQualified(_path(spark, p)) for p in (fresh, path))
    context.rename(source, target, how)
