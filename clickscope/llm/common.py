"""Helpers shared by the corpus operators: staging, free names, memory of workers, components."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickscope.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back.

    Cuts the lineage: a lost executor repeats tasks of later jobs only, and
    the files' known size lets the planner choose joins.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(names, *wanted: str) -> list[str]:
    """Column names like ``wanted`` that clash with none of ``names``."""
    taken = {n.lower() for n in names}
    out = []
    for w in wanted:
        while w.lower() in taken:
            w += "_"
        taken.add(w.lower())
        out.append(w)
    return out


def crc_mod(col, m: int):
    """crc32 of the id written as text, modulo ``m`` (null id: null)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % m


def release() -> None:
    """Gives freed memory of this process back to the system; without it, Arrow and the C library keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph ``(a long, b long)`` -> ``(node, root)``.

    ``root`` is the component's smallest node; only nodes with an edge to
    another node are returned. Alternating large-star and small-star rounds:
    each links neighbours to the smallest one nearby, and a chain of n nodes
    needs about log2(n) rounds. A round keeps at most as many edges as it got
    and only shuffles (node, smallest neighbour) pairs; minima are aggregated
    before the shuffle and staged, so a star's hot centre meets a join that
    the planner can split. Loops, repeats and an empty input are fine.
    """
    def minima(e):  # smallest neighbour-or-self of every node
        return stage(e.groupBy("u").agg(F.min("v").alias("m"))
                     .select("u", F.least("u", "m").alias("m")), "cc_min")

    def digest(e):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1000003)).first()

    e = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
              .distinct(), "cc_edges")
    seen = digest(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(minima(both), "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        low = minima(large)
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))))
        e = stage(small.where("u <> v").distinct(), "cc_edges")
        now = digest(e)
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
