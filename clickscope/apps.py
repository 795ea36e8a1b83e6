"""Runnable applications: the six questions end to end.

    spark-submit --py-files clickscope.zip clickscope/apps.py category-top10 --table user_visit_action \\
        --database mall --jdbc-url jdbc:mysql://db/mall --jdbc-user u --jdbc-password p

Batch apps read the visit-action table (optionally within text time
bounds), compute, and append their result with a run id to a JDBC table, or
write it whole as Parquet under ``--out`` (default: a new folder under the
shared one). Rows that don't conform go to ``<out>-quarantine``, and their
number is reported. Stream apps read the ad-click log (Kafka) and keep their
checkpoints and results under ``--root`` (shared storage; defaults to
``spark.checkpoint.dir``), running until stopped; :func:`stream_results` reads them.
"""

from __future__ import annotations

import argparse
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from clickscope.fixed import (
    BLACKLIST_THRESHOLD_STORE_VARIANT, CATEGORY_SESSION_TABLE, CATEGORY_TOP10_TABLE, TOP_ADS,
)
from clickscope.operators import category as C
from clickscope.operators import pageflow as P
from clickscope.session import build_session, scratch_path, shared_dir
from clickscope.sinks.writers import append_jdbc
from clickscope.sources.adlog import read_ad_log_kafka
from clickscope.sources.tables import conform_visits, read_table, visits_in_range
from clickscope.streaming import jobs
from clickscope.streaming.counters import Counters
from clickscope.streaming.latest import Latest
from clickscope.streaming.state import banned_users, user_clicks


def new_task_id() -> str:
    """One id per run, stamped on every result row of the run."""
    return str(uuid.uuid4())


def load_visits(spark: SparkSession, table: str, database: str | None = None,
                start: str | None = None, end: str | None = None, date_col: str | None = None,
                required: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The visit table, conformed on the ``required`` columns, within the bounds; and
    the rows of the whole table that don't conform."""
    visits, quarantine = conform_visits(read_table(spark, table, database), required)
    return visits_in_range(visits, start, end, date_col), quarantine


def write_quarantine(quarantine: DataFrame, path: str) -> int:
    """Store the rows that don't conform (nothing if there are none); returns their number."""
    quarantine.write.mode("overwrite").parquet(path)
    return quarantine.sparkSession.read.schema(quarantine.schema).parquet(path).count()


# Columns each batch application reads (and so requires non-null).
APP_REQUIRED = {
    "category-top10": C.REQUIRED,
    "category-session-top10": C.SESSION_REQUIRED,
    "page-flow": P.REQUIRED,
}


def category_top10_app(visits: DataFrame, task_id: str, n: int = 10) -> DataFrame:
    """(task_id, category_id, click_count, order_count, pay_count)."""
    return C.category_top10(visits, n, task_id=task_id)


def category_session_top10_app(visits: DataFrame, task_id: str, n_categories: int = 10,
                               n_sessions: int = 10) -> DataFrame:
    """(task_id, category_id, session_id, click_count), top sessions per top category."""
    return (C.category_session_top10(visits, n_categories=n_categories, n_sessions=n_sessions,
                                     task_id=task_id)
            .select("task_id", "category_id", "session_id", "click_count"))


def page_flow_app(visits: DataFrame, path: str, tie_col: str | None = None,
                  tie_split: int | None = 1000) -> DataFrame:
    """(page_flow, rate) for each step of the path that sessions took. A second of one
    session is cut at ``tie_split`` values of the tie column, or at page ids without one."""
    return P.page_flow_rate(visits, path, tie_col, tie_split).select("page_flow", "rate")


AREA_CITY_KEYS = ["dt", "province", "city", "adid"]


def _checkpoint(root: str, name: str) -> str:
    return os.path.join(root, "checkpoints", name)


def _counters(spark: SparkSession, root: str) -> Counters:
    return Counters(spark, os.path.join(root, "area_city_ad_clicks_incr"), AREA_CITY_KEYS)


def _top3(spark: SparkSession, root: str) -> Latest:
    return Latest(spark, os.path.join(root, "top3_ads_per_day"), jobs.TOP_SCHEMA)


def stream_results(spark: SparkSession, name: str, root: str) -> dict[str, DataFrame]:
    """What the stream app ``name`` has stored under ``root`` so far."""
    chk = _checkpoint(root, name)
    if name == "blacklist":
        return {"blacklist": banned_users(spark, chk), "user_ad_day": user_clicks(spark, chk)}
    if name == "area-city-clicks":
        return {"area_city": jobs.area_city_clicks(spark, chk)}
    if name == "area-city-clicks-incr":
        return {"area_city": _counters(spark, root).totals()}
    if name == "area-top3":
        return {"top3": _top3(spark, root).read(), "json": jobs.top3_json(_top3(spark, root))}
    raise ValueError(f"unknown stream app {name}")


def start_stream_app(spark: SparkSession, name: str, lines: DataFrame, root: str,
                     threshold: int = BLACKLIST_THRESHOLD_STORE_VARIANT, trigger: dict | None = None,
                     state_partitions: int | None = None):
    chk = _checkpoint(root, name)
    if name == "blacklist":
        return jobs.start_blacklist(lines, chk, threshold, trigger, state_partitions)
    if name == "area-city-clicks":
        return jobs.start_area_city_clicks(lines, chk, trigger, state_partitions)
    if name == "area-city-clicks-incr":
        return jobs.start_area_city_clicks_incr(lines, _counters(spark, root), chk, trigger)
    if name == "area-top3":
        return jobs.start_area_top3(lines, _top3(spark, root), chk, TOP_ADS, trigger, state_partitions)
    raise ValueError(f"unknown stream app {name}")


BATCH_APPS = ("category-top10", "category-session-top10", "page-flow")
STREAM_APPS = ("blacklist", "area-city-clicks", "area-city-clicks-incr", "area-top3")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="clickscope.apps")
    ap.add_argument("app", choices=BATCH_APPS + STREAM_APPS)
    ap.add_argument("--table", default="user_visit_action")
    ap.add_argument("--testdata", metavar="SF_DIR",
                    help="derive the visit actions from the shared test tables in SF_DIR instead")
    ap.add_argument("--database")
    ap.add_argument("--start")
    ap.add_argument("--end")
    ap.add_argument("--date-col", help="partition column of the table holding the day")
    ap.add_argument("--path", default="1,2,3,4,5,6,7", help="target page path")
    ap.add_argument("--tie-col", help="numeric column that orders the actions of one second")
    ap.add_argument("--out", help="folder of a batch result (Parquet)")
    ap.add_argument("--jdbc-url")
    ap.add_argument("--jdbc-user")
    ap.add_argument("--jdbc-password")
    ap.add_argument("--bootstrap-servers")
    ap.add_argument("--topic", default="ads_log")
    ap.add_argument("--root", help="shared folder for stream tables and checkpoints")
    ap.add_argument("--threshold", type=int, default=BLACKLIST_THRESHOLD_STORE_VARIANT)
    ap.add_argument("--min-partitions", type=int, help="Kafka: split hot topic partitions over tasks")
    ap.add_argument("--max-offsets-per-trigger", type=int, help="Kafka: cap a micro-batch")
    ap.add_argument("--state-partitions", type=int,
                    help="state-store partitions of a new stateful stream (fixed once started)")
    a = ap.parse_args(argv)
    spark = build_session()
    if a.app in BATCH_APPS:
        required = APP_REQUIRED[a.app] + (["action_time"] if (a.start or a.end) else [])
        if a.testdata:
            from clickscope.plans.inputs import visits as testdata_visits
            visits = visits_in_range(testdata_visits(spark, a.testdata, required, a.start, a.end), a.start, a.end)
            quarantine = None
        else:
            visits, quarantine = load_visits(spark, a.table, a.database, a.start, a.end, a.date_col, required)
        path = a.out or scratch_path(spark, a.app)
        if quarantine is not None:
            n = write_quarantine(quarantine, f"{path.rstrip('/')}-quarantine")
            print(f"{n} rows don't conform; see {path.rstrip('/')}-quarantine")
        task_id = new_task_id()
        if a.app == "page-flow":
            out, target = page_flow_app(visits, a.path, a.tie_col), None
        elif a.app == "category-top10":
            out, target = category_top10_app(visits, task_id), CATEGORY_TOP10_TABLE
        else:
            out, target = category_session_top10_app(visits, task_id), CATEGORY_SESSION_TABLE
        if a.jdbc_url and target:
            append_jdbc(out, a.jdbc_url, target, a.jdbc_user, a.jdbc_password)
        else:
            out.write.mode("overwrite").parquet(path)
            print(f"result: {path}")
        return
    lines = read_ad_log_kafka(spark, a.bootstrap_servers, a.topic,
                              min_partitions=a.min_partitions,
                              max_offsets_per_trigger=a.max_offsets_per_trigger)
    root = a.root or shared_dir(spark)
    start_stream_app(spark, a.app, lines, root, a.threshold,
                     state_partitions=a.state_partitions).awaitTermination()


if __name__ == "__main__":
    main()
