"""The ad-click log: stream readers and the line parser."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickscope.fixed import AD_LOG_TOPIC, LOG_FIELD_SEPARATOR, LOG_FIELDS
from clickscope.functions.lists import jvm_split



def parse_ad_log(lines: DataFrame, col: str = "value") -> DataFrame:
    """Split each line on single spaces into the five ad-click fields.

    Adds ``_ok``: a line is accepted when it has at least five fields (extra
    fields are ignored) and the first is an integer timestamp; other lines
    are rejects, kept for the reject output instead of failing the job.
    """
    f = jvm_split(F.col(col), LOG_FIELD_SEPARATOR)
    ts = F.get(F.col("_f"), 0).try_cast("bigint")
    return (lines.select(F.col(col).alias("line"), f.alias("_f"))
            .select("line",
                    ts.alias("ts_ms"),
                    F.get(F.col("_f"), 1).alias("province"),
                    F.get(F.col("_f"), 2).alias("city"),
                    F.get(F.col("_f"), 3).alias("userid"),
                    F.get(F.col("_f"), 4).alias("adid"),
                    ((F.size("_f") >= LOG_FIELDS) & ts.isNotNull()).alias("_ok")))


def ad_log_parse(lines: DataFrame, col: str = "value") -> DataFrame:
    """Accepted lines as (ts_ms, province, city, userid, adid)."""
    return (parse_ad_log(lines, col).where("_ok")
            .select("ts_ms", "province", "city", "userid", "adid"))


def ad_log_rejects(lines: DataFrame, col: str = "value") -> DataFrame:
    """Lines that do not parse, as (line)."""
    return parse_ad_log(lines, col).where(~F.col("_ok")).select("line")


def read_ad_log_files(spark: SparkSession, path: str,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming text source: one ad-log line per row in column ``value``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def read_ad_log_kafka(spark: SparkSession, bootstrap_servers: str,
                      topic: str = AD_LOG_TOPIC, starting_offsets: str = "latest",
                      min_partitions: int | None = None,
                      max_offsets_per_trigger: int | None = None,
                      extra_options: dict[str, str] | None = None) -> DataFrame:
    """Kafka source of ad-log lines (value column as text).

    Offsets are tracked in the streaming checkpoint, so a restarted query
    resumes where it stopped. ``min_partitions`` lets Spark split the offset
    range of a hot topic partition (one producer holding a large share of
    the log) across several tasks; ``max_offsets_per_trigger`` bounds the
    size of a micro-batch after a backlog. Needs the spark-sql-kafka
    package on the cluster's classpath.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    if min_partitions:
        reader = reader.option("minPartitions", str(min_partitions))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in (extra_options or {}).items():
        reader = reader.option(k, v)
    return reader.load().select(F.col("value").cast("string").alias("value"))
