"""Structured Streaming jobs over the ad-click log.

Every job reads a streaming frame of log lines (column ``value``, from
:func:`clickscope.sources.adlog.read_ad_log_kafka` on a cluster,
:func:`read_ad_log_files` or the segment source) and parses it. What a job
keeps lies in Spark's own state store and file sink, in the query's checkpoint folder on
shared storage, and is read through the state data source; a
replayed micro-batch leaves it as it was.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from clickscope.fixed import BATCH_INTERVAL, TOP_ADS
from clickscope.operators.ads import ad_area_top3_json, with_day
from clickscope.sources.adlog import parse_ad_log
from clickscope.streaming import state
from clickscope.streaming.counters import Counters
from clickscope.streaming.latest import Latest

DEFAULT_TRIGGER = {"processingTime": BATCH_INTERVAL}
AD_COLS = ["ts_ms", "province", "city", "userid", "adid"]
TOP_SCHEMA = "dt string, province string, adid string, clicks bigint, rn int"


def parsed_clicks(lines: DataFrame) -> DataFrame:
    """Accepted clicks of a (streaming or batch) line frame, with their day."""
    return with_day(parse_ad_log(lines).where("_ok").select(*AD_COLS))


def running_counts(clicks: DataFrame, keys: list[str]) -> DataFrame:
    """Streaming count per (dt, *keys) as ``clicks``.

    The day is a plain grouping column and state is kept for every day, so
    a late click always counts on its own day.
    """
    return clicks.groupBy("dt", *keys).agg(F.count(F.lit(1)).alias("clicks"))


@contextmanager
def _settings(spark: SparkSession, conf: dict[str, str]):
    """Session settings that a query takes over when it starts (it runs on a clone
    of the session and keeps them in its checkpoint); the caller's are restored."""
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _start(df_writer, spark: SparkSession, checkpoint: str, trigger: dict | None, name: str,
           state_partitions: int | None = None, conf: dict[str, str] | None = None) -> StreamingQuery:
    """Start a query; ``state_partitions`` fixes the number of its state-store partitions."""
    own = dict(conf or {}) | ({"spark.sql.shuffle.partitions": str(state_partitions)} if state_partitions else {})
    with _settings(spark, own):
        return (df_writer.option("checkpointLocation", checkpoint).trigger(**(trigger or DEFAULT_TRIGGER))
                .queryName(name).start())


def _run_of(batch: DataFrame) -> str | None:
    """The run (the checkpoint) that a micro-batch belongs to."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


# ---------------------------------------------------------------- parsed log

def start_ad_log_parse(lines: DataFrame, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Parse lines once into the file sink at ``out``: accepted clicks and rejected lines, by ``ok``.

    The sink's own log lists the files of finished micro-batches. It belongs to one checkpoint: a new one
    needs a new folder (its batch numbers would be taken for those already written).
    """
    spark = lines.sparkSession
    if _exists(spark, f"{out}/_spark_metadata") and not _exists(spark, checkpoint):
        raise ValueError(f"{out} belongs to another checkpoint")
    rows = parse_ad_log(lines).withColumnRenamed("_ok", "ok")
    rows = rows.withColumn("line", F.when(~F.col("ok"), F.col("line"))).withColumns(
        {c: F.when(F.col("ok"), F.col(c)) for c in AD_COLS})
    return _start(rows.writeStream.format("parquet").option("path", out).partitionBy("ok"), spark, checkpoint, trigger, "ad_log_parse")


def parsed_log(spark: SparkSession, out: str, ok: bool = True) -> DataFrame:
    """The accepted clicks, or the rejected lines, of the sink at ``out``."""
    return spark.read.parquet(out).where(F.col("ok") == ok).select(*(AD_COLS if ok else ["line"]))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


# ---------------------------------------------------------------- counts

def start_area_city_clicks(lines: DataFrame, checkpoint: str, trigger: dict | None = None,
                           state_partitions: int | None = None) -> StreamingQuery:
    """Running clicks per (dt, province, city, adid), absolute values (hash set).

    The count is a streaming aggregation, partial-aggregated before its shuffle, and its state store is the
    table: :func:`area_city_clicks` reads it, of one or several checkpoints.
    """
    counts = running_counts(parsed_clicks(lines), ["province", "city", "adid"])
    return _start(counts.writeStream.outputMode("update").format("noop"), lines.sparkSession, checkpoint, trigger,
                  "ad_area_city_clicks", state_partitions)


def area_city_clicks(spark: SparkSession, checkpoints: str | list[str]) -> DataFrame:
    """(dt, province, city, adid, clicks) of what the streams of ``checkpoints`` have read."""
    return state.running_state(spark, checkpoints)


def start_area_city_clicks_incr(lines: DataFrame, table: Counters, checkpoint: str,
                                trigger: dict | None = None, fold_every: int | None = 100) -> StreamingQuery:
    """Clicks per (dt, province, city, adid) as per-batch increments (counter add).

    Stateless in Spark: each batch's counts are added to ``table``, which holds them once
    whatever is replayed, and sums them over all runs.
    """
    w = lines.writeStream.foreachBatch(lambda b, i: area_city_incr_step(b, i, table, _run_of(b), fold_every))
    return _start(w, lines.sparkSession, checkpoint, trigger, "ad_area_city_clicks_incr")


def area_city_incr_step(batch: DataFrame, batch_id: int, table: Counters, run: str, fold_every: int | None = None) -> None:
    table.add(run, batch_id, running_counts(parsed_clicks(batch), ["province", "city", "adid"]))
    if fold_every and batch_id and batch_id % fold_every == 0:
        table.fold(run, batch_id - 1)  # this one may be replayed


# ---------------------------------------------------------------- top ads

def start_area_top3(lines: DataFrame, top: Latest, checkpoint: str, n: int = TOP_ADS, trigger: dict | None = None,
                    state_partitions: int | None = None, earlier: list[str] | None = None) -> StreamingQuery:
    """Top-n ads per (dt, province) on the running counts.

    Running clicks per (dt, province, adid) are a streaming aggregation; ``update`` mode emits the counts that a
    batch changed. Counts only grow, so the new top n of a group are among its stored top n and its
    changed ads: a batch reads ``top``, never the other counts of a group. A repeated batch finds the
    same. A new checkpoint counts from zero: ``earlier`` names those whose counts it goes on from,
    and a ``top`` of another checkpoint is refused without.
    """
    spark = lines.sparkSession
    counts = running_counts(parsed_clicks(lines), ["province", "adid"])
    base = None
    if earlier:
        base = top.path.rstrip("/") + "-before"
        state.running_state(spark, earlier).write.mode("overwrite").partitionBy("dt").parquet(base)

    def step(batch: DataFrame, batch_id: int) -> None:
        run = _run_of(batch)
        if base is None and top.writer() not in (None, run):
            raise RuntimeError(f"{top.path} is the result of another checkpoint, which earlier= should name")
        before = batch.sparkSession.read.schema("province string, adid string, clicks bigint, dt string").parquet(base) if base else None
        top3_step(batch, top, n, run, before)

    return _start(counts.writeStream.outputMode("update").foreachBatch(step), spark, checkpoint, trigger,
                  "ad_area_top3", state_partitions)


def top3_step(changed: DataFrame, top: Latest, n: int, run: str, before: DataFrame | None = None) -> None:
    """Merge a batch's changed (dt, province, adid, clicks) into the stored top n."""
    if before is not None:
        b = before.select(*[F.col(c).alias(f"_{c}") for c in ("dt", "province", "adid", "clicks")])
        same = [changed[c].eqNullSafe(b[f"_{c}"]) for c in ("dt", "province", "adid")]
        changed = changed.join(b, same, "left").select("dt", "province", "adid", (F.col("clicks") + F.coalesce("_clicks", F.lit(0))).alias("clicks"))
    top.replace(merged_top(top.read(), changed, n), run)


def merged_top(stored: DataFrame, changed: DataFrame, n: int = TOP_ADS) -> DataFrame:
    """(dt, province, adid, clicks, rn): the top n of each group of ``stored`` tops and ``changed`` counts.

    An ad is in both at most, so the 2 n largest of a group hold its top n; they are
    limited before the one shuffle, and an ad's smaller count is dropped in the group's list.
    """
    cols = ["dt", "province", "adid", "clicks"]
    by = Window.partitionBy("dt", "province").orderBy(F.desc("clicks"), F.asc("adid"))
    few = (stored.select(*cols).unionByName(changed.select(*cols))
           .withColumn("_rn", F.row_number().over(by)).where(F.col("_rn") <= 2 * n))
    ranked = few.groupBy("dt", "province").agg(F.sort_array(F.collect_list(F.struct("_rn", "adid", "clicks"))).alias("_all"))
    once = F.filter("_all", lambda e, i: ~F.exists(F.slice("_all", 1, i), lambda d: d["adid"].eqNullSafe(e["adid"])))
    return (ranked.select("dt", "province", F.posexplode(F.slice(once, 1, n)).alias("_at", "_e"))
            .select("dt", "province", "_e.adid", "_e.clicks", (F.col("_at") + 1).alias("rn")))


def top3_json(top: Latest) -> DataFrame:
    """(key, field, value_json) of a top-n table."""
    return ad_area_top3_json(top.read())


# ---------------------------------------------------------------- blacklist

def start_blacklist(lines: DataFrame, checkpoint: str, threshold: int, trigger: dict | None = None,
                    state_partitions: int | None = None, earlier: str | None = None) -> StreamingQuery:
    """The blacklist feedback loop, as a stateful operator keyed by user.

    Batch N drops the clicks of users banned up to batch N-1, counts the others per (dt, adid, userid), and bans
    every user one of whose counts reaches ``threshold``. :func:`banned_users` and :func:`user_clicks` of
    :mod:`clickscope.streaming.state` read the result from the checkpoint. Clicks are counted within a task first, so
    a user with a third of all clicks sends few rows. A new checkpoint goes on from the
    state of ``earlier``.
    """
    spark = lines.sparkSession
    few = state.combined(parsed_clicks(lines), ["dt", "adid", "userid"])
    first = state.users(spark, earlier).groupBy("userid") if earlier else None
    banned = few.groupBy("userid").transformWithState(state.BannedUsers(threshold), "userid string", "Update", "None", first)
    return _start(banned.writeStream.outputMode("update").format("noop"), spark, checkpoint, trigger,
                  "ad_blacklist", state_partitions, state.ROCKSDB)


def start_console_preview(stream: DataFrame, checkpoint: str, rows: int = 20,
                          trigger: dict | None = None) -> StreamingQuery:
    """Debug sink: print the first rows of every micro-batch on the driver."""
    w = stream.writeStream.format("console").option("numRows", str(rows)).option("truncate", "false")
    return _start(w, stream.sparkSession, checkpoint, trigger, "console_preview")
