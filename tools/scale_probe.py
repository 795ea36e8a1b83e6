"""Scale and skew probe (PLANS.md): copies of the sf0.1 events, one hot user.

usage: python tools/scale_probe.py <scratch folder> [copies] [query ...]

Writes ``copies`` copies of ``events`` (ids kept unique, timestamps shifted
by a few microseconds) into <scratch>/events.parquet. In every copy one
third of the rows is moved to user 7, which creates a hot user, hot
sessions and hot (day, ad, user) groups. The queries then run over it with
Spark's event log in <scratch>/eventlog, and a per-stage report follows.
Nothing is written outside the given folder.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from clickscope.session import build_session  # noqa: E402

SOURCE = "/root/testdata/sf0.1"
DEFAULT_QUERIES = ["category_top10", "category_session_top10", "page_flow_rate", "ad_blacklist",
                   "ad_log_filtered", "ad_admitted_clicks", "ad_area_top3_json"]
HOT_USER = 7


def main(argv):
    out = argv[1]
    copies = int(argv[2]) if len(argv) > 2 else 100
    names = argv[3:] or DEFAULT_QUERIES
    log_dir = os.path.join(out, "eventlog")
    os.makedirs(log_dir, exist_ok=True)
    spark = build_session("local[8]", shuffle_partitions=32, extra_conf={
        "spark.driver.memory": "8g", "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
    spark.sparkContext.setLogLevel("ERROR")
    ev = spark.read.parquet(os.path.join(SOURCE, "events.parquet"))
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    big = (ev.select("*", copy)
           .select((F.col("event_id") + F.col("copy") * 1_000_000).alias("event_id"),
                   F.timestamp_add("MICROSECOND", F.col("copy"), F.col("ts")).alias("ts"),
                   F.when((F.col("event_id") + F.col("copy")) % 3 == 0, F.lit(HOT_USER))
                    .otherwise(F.col("user_id")).alias("user_id"),
                   "event_type", "value", "props"))
    big.repartition(32).write.mode("overwrite").parquet(os.path.join(out, "events.parquet"))
    for t in ("nation", "region"):
        spark.read.parquet(os.path.join(SOURCE, f"{t}.parquet")).write.mode("overwrite") \
            .parquet(os.path.join(out, f"{t}.parquet"))
    from clickscope.plans.catalogue import batch_queries
    q = batch_queries()
    for name in names:
        t0 = time.perf_counter()
        q[name](spark, out).write.format("noop").mode("overwrite").save()
        print(f"{name:26s} {time.perf_counter() - t0:7.2f}s", flush=True)
    spark.stop()
    from tools.eventlog_report import report
    report(log_dir, 12)


if __name__ == "__main__":
    main(sys.argv)
