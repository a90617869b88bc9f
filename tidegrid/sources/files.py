"""Looking into folders of any store that Spark can open."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def file_exists(spark: SparkSession, path: str) -> bool:
    found, files = _opened(spark, path)
    return files.exists(found)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; nothing if there is no such folder."""
    found, files = _opened(spark, path)
    if not files.exists(found):
        return []
    return [status.getPath().getName() for status in files.listStatus(found)]
