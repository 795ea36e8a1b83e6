"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule, a piecewise linear function of training time from 0 to 1.
Its integral is the source's weight, which sets its target; the integral
up to a time, scaled to the target, is the source's cumulative demand. A document takes a stretch
of its source's demand, in an order fixed by a hash, and the inverse of the demand
gives its training position. Rows are range-sorted by position.

Cumulative sizes come from two levels: sums by (source, hash bucket), staged, and a
window within a bucket, so that a source with any share of the rows is
spread over ``2 ** BUCKET_BITS`` groups. Only the window over sources, one narrow row each,
is in one place. All of it is DataFrame expressions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickscope.llm.common import fresh, stage

BUCKET_BITS = 12
HASH_BITS = 60

# Weight over training time, as (time, weight) knots: rising, flat, falling.
# Their integrals are 1, 2 and 3.
SCHEDULES = (
    ((0.0, 0.5), (1.0, 1.5)),
    ((0.0, 2.0), (1.0, 2.0)),
    ((0.0, 5.0), (0.5, 3.0), (1.0, 1.0)),
)


def integral(knots) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:]))


def time_at(area: Column, knots) -> Column:
    """The time by which a schedule's integral reaches ``area``."""
    out, done = None, integral(knots)
    for (t0, w0), (t1, w1) in reversed(list(zip(knots, knots[1:]))):
        done -= (t1 - t0) * (w0 + w1) / 2
        slope, x = (w1 - w0) / (t1 - t0), area - F.lit(done)
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + F.lit(2 * slope) * x))
        here = F.lit(t0) + F.when(x > 0, F.lit(2.0) * x / (F.lit(w0) + root)).otherwise(0.0)
        later = done + (t1 - t0) * (w0 + w1) / 2
        out = here if out is None else F.when(area < F.lit(later), here).otherwise(out)
    return out


def hash_order(doc_id: str, text: str) -> Column:
    """60 bits of the id and the whole text, the same in any engine with md5."""
    both = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit("|"),
                    F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(both.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def word_count(text: str) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` (null: 0)."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """``(source, source_size)`` -> also ``rank, weight, target``.

    Sources by code point, null last, take the weights in turn. The targets share the sum of the
    sizes by weight; none is above ``cap`` times its source's size, and the excess is
    reshared by weight: with sources ordered by size over weight, those at
    their cap come first, and the rest share what is left.
    """
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    w = sizes.withColumn("rank", F.row_number().over(rank) - 1)
    w = w.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))),
                                            (F.col("rank") % len(weights) + 1).cast("int")))
    limit = F.col("source_size") * F.lit(float(cap))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    whole = Window.partitionBy()
    w = (w.withColumn("limit", limit).withColumn("all", F.sum("source_size").over(whole).cast("double"))
         .withColumn("before", F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
         .withColumn("open", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))))
    full = F.col("limit") * F.col("open") <= F.col("weight") * (F.col("all") - F.col("before"))
    w = (w.withColumn("full", full)
         .withColumn("held", F.sum(F.when(F.col("full"), F.col("limit")).otherwise(0.0)).over(whole))
         .withColumn("share", F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0.0)).over(whole)))
    return w.select("source", "source_size", "rank", "weight",
                    F.when(F.col("full"), F.col("limit"))
                    .otherwise(F.col("weight") * (F.col("all") - F.col("held")) / F.col("share")).alias("target"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        schedules=SCHEDULES, cap: float = 3.0, keep: list[str] | None = None, each_copy: bool = False) -> DataFrame:
    """One row for each document row, range-sorted by training position.

    Adds ``size`` (words), ``source_size``, ``target``, ``taken`` (words the mix takes of the row, repeats
    counted), ``copies`` (whole copies nearest to that) and ``position`` (training time of the first copy,
    null if none is taken) to the columns ``keep`` (default: the id). A source
    is gone through floor(target / size) times, then its documents are taken in hash order up to
    the rest, the last one in part, so its words taken differ from its target by rounding only. ``cap``
    bounds the passes. With ``each_copy`` a row comes ``copies`` times, each at its own position. A null text has size 0; null is a source of its own,
    the last; rows without words are never taken. Equal rows are told apart by nothing and
    take consecutive stretches. Reruns agree. An empty table gives no row.
    """
    keep = [doc_id] if keep is None else keep
    src, size, h, bucket = fresh(docs.columns, "_source", "_size", "_hash", "_bucket")
    weights = tuple(integral(k) for k in schedules)
    d = docs.select(*keep, F.col(source).alias(src), word_count(text).alias(size), hash_order(doc_id, text).alias(h))
    d = d.withColumn(bucket, F.shiftright(h, HASH_BITS - BUCKET_BITS))
    sums = stage(docs.select(F.col(source).alias("source"), word_count(text).alias("n"),
                             F.shiftright(hash_order(doc_id, text), HASH_BITS - BUCKET_BITS).alias("bucket"))
                 .groupBy("source", "bucket").agg(F.sum("n").alias("n")), "mix_buckets")
    sources = source_targets(sums.groupBy("source").agg(F.sum("n").alias("source_size")), weights, cap)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sources = stage(sources.withColumn("passes", passes.cast("bigint"))
                    .withColumn("rest", F.floor(F.col("target") - F.col("passes") * F.col("source_size") + 0.5)
                                .cast("bigint")), "mix_sources")
    over = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("source", "bucket", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("start"))
    starts = stage(starts.join(sources, starts["source"].eqNullSafe(sources["source"]))
                   .drop(sources["source"]), "mix_starts")
    starts = starts.toDF(*[f"_m_{c}" for c in starts.columns])
    within = Window.partitionBy(src, bucket).orderBy(h, *[c for c in keep if c == doc_id]).rowsBetween(
        Window.unboundedPreceding, -1)
    (at,) = fresh(d.columns, "_at")
    d = (d.withColumn(at, F.coalesce(F.sum(size).over(within), F.lit(0)))
         .join(starts, d[src].eqNullSafe(F.col("_m_source")) & (d[bucket] == F.col("_m_bucket"))))
    begin = F.col("_m_start") + F.col(at)
    part = F.least(F.greatest(F.col("_m_rest") - begin, F.lit(0)), F.col(size))
    taken = F.col("_m_passes") * F.col(size) + part
    demand = F.col("_m_passes") * F.col("_m_source_size") + F.col("_m_rest")
    copies = F.when(F.col(size) > 0, F.col("_m_passes") + F.when((part > 0) & (part * 2 >= F.col(size)), 1).otherwise(0))
    copies = F.coalesce(copies, F.lit(0)).cast("bigint")
    done = F.lit(0)  # words of its source that come before this copy in earlier passes
    if each_copy:
        (turn,) = fresh(d.columns, "_turn")
        d = d.where(copies > 0).withColumn(turn, F.explode(F.sequence(F.lit(0).cast("bigint"), copies - 1)))
        done = F.col(turn) * F.col("_m_source_size")
    share = (done + begin) / demand
    where = reduce(lambda otherwise, k: F.when(F.col("_m_rank") % len(schedules) == k,
                                               time_at(share * F.lit(weights[k]), schedules[k])).otherwise(otherwise),
                   range(len(schedules)), F.lit(None).cast("double"))
    out = d.select(*keep, F.col(size).alias("size"), F.col("_m_source_size").alias("source_size"),
                   F.col("_m_target").alias("target"), taken.cast("bigint").alias("taken"),
                   copies.alias("copies"),
                   F.when(taken > 0, where).alias("position"))
    return out.orderBy(F.col("position").asc_nulls_last(), doc_id)
