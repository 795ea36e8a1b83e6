"""Counters that micro-batches add to: a catalogue table bucketed by its key.

A batch's increments are one partition, ``run`` (the stream's checkpoint) and ``n`` (the batch), overwritten as
a whole, so a replay counts nothing twice and a new checkpoint adds to
what is stored. Every partition is bucketed alike: the counters are summed, and joined with a
batch's keys, without an exchange above their scan. :meth:`Counters.fold`
sums old batches into one partition now and then.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F


class Counters:
    """Summed ``value`` by ``keys`` (text columns) at ``path``; ``buckets`` stays as the table was made."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], value: str = "clicks", buckets: int = 32):
        self.spark, self.path, self.keys, self.value, self.buckets = spark, path, list(keys), value, buckets
        self._seen: set[str] = set()
        self.name = f"clickscope_counters_{hashlib.md5(path.encode()).hexdigest()[:16]}"

    def _open(self) -> None:
        spark = self.spark
        if not spark.catalog.tableExists(self.name):
            cols = ", ".join(f"`{k}` STRING" for k in self.keys)
            spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({cols}, `{self.value}` BIGINT, run STRING, kind STRING, n BIGINT) USING parquet "
                      f"PARTITIONED BY (run, kind, n) CLUSTERED BY ({', '.join(f'`{k}`' for k in self.keys)}) INTO {self.buckets} BUCKETS "
                      f"LOCATION '{self.path}'")
            fs, p = self._fs(self.path)
            fs.mkdirs(p)
            spark.sql(f"MSCK REPAIR TABLE {self.name}")  # what an earlier session stored

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _write(self, rows: DataFrame, how: str, run: str, kind: str, n: int) -> None:
        rows = rows.select(*self.keys, self.value).repartition(self.buckets, *self.keys)  # a file a bucket
        rows.sparkSession.sql(f"INSERT {how} TABLE {self.name} PARTITION (run = '{run}', kind = '{kind}', n = {int(n)}) SELECT * FROM {{rows}}",
                              rows=rows)

    def _drop(self, run: str, kind: str, n: int) -> None:
        self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION (run = '{run}', kind = '{kind}', n = {int(n)})")
        fs, p = self._fs(f"{self.path}/run={run}/kind={kind}/n={int(n)}")
        fs.delete(p, True)

    def add(self, run: str, batch_id: int, rows: DataFrame) -> None:
        """Store the increments of a batch, in place of those of an earlier try."""
        if run not in self._seen:  # the newest fold may be unfinished; what it covers is still there
            folds = [int(n) for r, kind, n in self._parts() if r == run and kind == "fold"]
            if folds:
                self._drop(run, "fold", max(folds))
            self._seen.add(run)
        self._write(rows, "OVERWRITE", run, "batch", batch_id)

    def _parts(self) -> list[tuple[str, str, int]]:
        self._open()
        return [tuple(x.split("=", 1)[1] for x in r[0].split("/")) for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()]

    def _rows(self, run: str | None = None, upto: int | None = None) -> DataFrame:
        """Of each run the newest fold and the batches behind it."""
        newest = {}
        for r, kind, n in self._parts():
            if kind == "fold":
                newest[r] = max(int(n), newest.get(r, -1))
        held = F.lit(True)
        for r, n in newest.items():
            held &= (F.col("run") != r) | ((F.col("kind") == "fold") & (F.col("n") == n)) | ((F.col("kind") == "batch") & (F.col("n") > n))
        rows = self.spark.table(self.name).where(held)
        if run is not None:
            rows = rows.where((F.col("run") == run) & (F.col("n") <= upto))
        return rows

    def totals(self, only: DataFrame | None = None) -> DataFrame:
        """The counters; with ``only``, those whose keys it holds (the one side that is exchanged)."""
        rows = self._rows()
        if only is not None:
            wanted = only.select(*self.keys).distinct()
            rows = rows.join(wanted.hint("merge"), self.keys, "left_semi")
        return rows.groupBy(*self.keys).agg(F.sum(self.value).cast("bigint").alias(self.value))

    def fold(self, run: str, upto: int) -> None:
        """Sum the run's batches up to ``upto``, which must be finished, into one partition. What an earlier fold
        covers is deleted; what only this one covers stays for readers that have begun."""
        parts = [(kind, int(n)) for r, kind, n in self._parts() if r == run]
        if ("fold", upto) in parts:
            return
        old = max((n for kind, n in parts if kind == "fold"), default=-1)
        total = self._rows(run, upto).groupBy(*self.keys).agg(F.sum(self.value).cast("bigint").alias(self.value))
        self._write(total, "INTO", run, "fold", upto)
        for kind, n in parts:
            if n <= old and (kind, n) != ("fold", old):
                self._drop(run, kind, n)
