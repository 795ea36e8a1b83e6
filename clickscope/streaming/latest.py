"""A small result that a stream replaces as a whole.

Every micro-batch writes a new version and marks it when it is complete;
readers take the newest marked one, and the one before stays for those that have begun. For
results whose size the data doesn't set, as the top ads of each day and area.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


class Latest:
    """The newest version of a table of ``schema`` (DDL) at ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def _fs(self, *place: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(self.path, *place))
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _marks(self) -> list[tuple[int, str]]:
        """(version, writer) of the complete versions, in order."""
        fs, p = self._fs("_complete")
        names = [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []
        return sorted((int(n.split("=", 1)[0]), n.split("=", 1)[1]) for n in names if "=" in n)

    def writer(self) -> str | None:
        """Who wrote the newest version."""
        marks = self._marks()
        return marks[-1][1] if marks else None

    def read(self) -> DataFrame:
        marks = self._marks()
        if not marks:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(os.path.join(self.path, f"version={marks[-1][0]}"))

    def replace(self, rows: DataFrame, writer: str) -> None:
        """Make ``rows``, which may come from :meth:`read`, the newest version."""
        marks = self._marks()
        new = marks[-1][0] + 1 if marks else 0
        rows.write.mode("overwrite").parquet(os.path.join(self.path, f"version={new}"))
        fs, p = self._fs("_complete", f"{new}={writer}")
        fs.create(p, True).close()
        for version, by in marks[:-1]:
            for place in (("_complete", f"{version}={by}"), (f"version={version}",)):
                fs, p = self._fs(*place)
                fs.delete(p, True)
