"""Files that Python data sources open themselves, on any file system Hadoop's settings name."""

from __future__ import annotations

import pyarrow.fs
from pyspark.sql import SparkSession


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with scheme and authority, as Hadoop's configuration resolves it on the driver: a
    path without a scheme lies in the default file system, not on an executor's own disk."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def open_fs(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a qualified path, and the path in it."""
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return pyarrow.fs.LocalFileSystem(), "/" + (rest if colon else path).lstrip("/")
    return pyarrow.fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + colon + rest)
