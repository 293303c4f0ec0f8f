"""The few file-system calls that DataFrames lack, on any file system that Spark reaches."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def located(spark: SparkSession, path: str):
    """The file system of a path, and the path as it names it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = located(spark, path)
    return files.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none of a folder that is not there."""
    files, where = located(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all it holds; no error if it is not there."""
    files, where = located(spark, path)
    files.delete(where, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    files, where = located(spark, path)
    stream = files.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file that must not exist yet; False if another writer made it."""
    files, where = located(spark, path)
    try:
        stream = files.create(where, False)
    except Py4JJavaError as problem:
        if files.exists(where) and "AlreadyExists" in str(problem.java_exception):
            return False
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True
