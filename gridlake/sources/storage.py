"""Questions about folders, asked of the file system that Spark uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def located(spark: SparkSession, path: str):
    """(file system, Hadoop path) of a URI or a pattern."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, pattern: str) -> bool:
    """Does anything match the path or pattern?"""
    fs, path = located(spark, pattern)
    return bool(fs.globStatus(path))


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder and all below it; False where there is none."""
    fs, folder = located(spark, path)
    return bool(fs.exists(folder) and fs.delete(folder, True))
