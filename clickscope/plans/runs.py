"""Registered sink and stream runs.

Each run writes under a fresh folder in the shared folder
(``spark.checkpoint.dir``) and returns the stored result as a DataFrame,
which must equal the batch query it mirrors.

Stream runs stage the ad-log lines derived from ``events`` as text files,
as many as the input needs, then run the streaming job with
``availableNow`` and an eighth of the files per trigger, so the job sees
several micro-batches. Files come in the order of their modification
times, which is not the order of the clicks; results don't depend on it.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickscope.operators.category import REQUIRED as CATEGORY_REQUIRED, category_top10
from clickscope.plans import inputs
from clickscope.session import scratch_path
from clickscope.sinks.writers import overwrite_table
from clickscope.sources import segments
from clickscope.sources.adapters import ad_log_lines
from clickscope.sources.adlog import read_ad_log_files
from clickscope.sources.tables import visits_in_range
from clickscope.streaming import jobs
from clickscope.streaming.counters import Counters
from clickscope.streaming.latest import Latest
from clickscope.streaming.state import banned_users

MICRO_BATCHES = 8
LINES_PER_FILE = 1_000_000
TRIGGER = {"availableNow": True}


def stage_ad_log(spark: SparkSession, sf_dir: str, root: str,
                 truncate_every: int | None = None) -> tuple[str, int]:
    """Write the derived ad-log lines as text files; returns the folder and files per micro-batch."""
    path = os.path.join(root, "input")
    ads = inputs.ads(spark, sf_dir)
    rows = inputs.events(spark, sf_dir).count()  # from the Parquet footers
    each = max(1, -(-rows // (LINES_PER_FILE * MICRO_BATCHES)))
    lines = ad_log_lines(ads.repartition(each * MICRO_BATCHES, "event_id"), truncate_every)
    lines.write.mode("overwrite").text(path)
    return path, each


def _state_parts(spark: SparkSession) -> int:
    """State-store partitions for the registered runs: the cluster's cores."""
    return spark.sparkContext.defaultParallelism


def _stream(spark: SparkSession, staged: tuple[str, int]) -> DataFrame:
    return read_ad_log_files(spark, staged[0], max_files_per_trigger=staged[1])


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def _run_parse(spark, sf_dir, p, ok: bool) -> DataFrame:
    root = scratch_path(spark, "stream_ad_log_parse")
    src = _stream(spark, stage_ad_log(spark, sf_dir, root, p.truncate_every))
    out = os.path.join(root, "log")
    _finish(jobs.start_ad_log_parse(src, out, os.path.join(root, "chk"), TRIGGER))
    return jobs.parsed_log(spark, out, ok)


def _run_blacklist(spark, sf_dir, p) -> DataFrame:
    root = scratch_path(spark, "stream_ad_blacklist")
    src = _stream(spark, stage_ad_log(spark, sf_dir, root))
    chk = os.path.join(root, "chk")
    _finish(jobs.start_blacklist(src, chk, p.threshold, TRIGGER, _state_parts(spark)))
    return banned_users(spark, chk)


def _run_area_city(spark, sf_dir, p) -> DataFrame:
    root = scratch_path(spark, "stream_ad_area_city_clicks")
    src = _stream(spark, stage_ad_log(spark, sf_dir, root))
    chk = os.path.join(root, "chk")
    _finish(jobs.start_area_city_clicks(src, chk, TRIGGER, _state_parts(spark)))
    return jobs.area_city_clicks(spark, chk)


def _run_area_city_incr(spark, sf_dir, p) -> DataFrame:
    root = scratch_path(spark, "stream_ad_area_city_clicks_incr")
    src = _stream(spark, stage_ad_log(spark, sf_dir, root))
    table = Counters(spark, os.path.join(root, "counters"), ["dt", "province", "city", "adid"], buckets=_state_parts(spark))
    _finish(jobs.start_area_city_clicks_incr(src, table, os.path.join(root, "chk"), TRIGGER, fold_every=4))
    return table.totals()


def _run_segments(spark, sf_dir, p) -> DataFrame:
    """Running counts from the segment log: stopped within a micro-batch, and started again."""
    root = scratch_path(spark, "stream_ad_segments")
    path, chk = os.path.join(root, "log"), os.path.join(root, "chk")
    ads = inputs.ads(spark, sf_dir)
    for half in range(2):
        segments.append_lines(ad_log_lines(ads.where(F.pmod("event_id", F.lit(2)) == half)), path, f"half-{half}", _state_parts(spark))
        lines = segments.stream_lines(spark, path)
        if half:  # a first try of the second micro-batch fails after its offsets are written
            broken = lines.withColumn("value", F.when(F.raise_error(F.lit("stopped")).isNull(), F.col("value")))
            try:
                _finish(jobs.start_area_city_clicks(broken, chk, TRIGGER, _state_parts(spark)))
            except Exception as e:  # noqa: BLE001
                if "stopped" not in str(e):
                    raise
        _finish(jobs.start_area_city_clicks(lines, chk, TRIGGER, _state_parts(spark)))
    return jobs.area_city_clicks(spark, chk)


def _run_top3(spark, sf_dir, p, as_json: bool) -> DataFrame:
    root = scratch_path(spark, "stream_ad_area_top3")
    src = _stream(spark, stage_ad_log(spark, sf_dir, root))
    top = Latest(spark, os.path.join(root, "top"), jobs.TOP_SCHEMA)
    _finish(jobs.start_area_top3(src, top, os.path.join(root, "chk"), p.top_ads, TRIGGER, _state_parts(spark)))
    return jobs.top3_json(top) if as_json else top.read()


def _table_roundtrip(spark, sf_dir, p) -> DataFrame:
    name = overwrite_table(category_top10(inputs.visits(spark, sf_dir, CATEGORY_REQUIRED), p.top_categories),
                           f"clickscope_category_top10_{uuid.uuid4().hex[:12]}",
                           path=scratch_path(spark, "table_category_top10"))
    return spark.table(name)


def _clustered_visits(spark, sf_dir, p) -> DataFrame:
    """The visits in the time range, from a table clustered by the time they are asked by."""
    name = overwrite_table(inputs.visits(spark, sf_dir), f"clickscope_visits_{uuid.uuid4().hex[:12]}",
                           path=scratch_path(spark, "table_visits"), cluster_by=["action_time"], files=_state_parts(spark))
    return visits_in_range(spark.table(name), p.start, p.end)


def _appended_top10(spark, sf_dir, p) -> DataFrame:
    """The categories' result as a run appends it, and a second try of the run that adds nothing."""
    path = scratch_path(spark, "appended_category_top10")
    top = category_top10(inputs.visits(spark, sf_dir, CATEGORY_REQUIRED), p.top_categories, task_id=p.run_id)
    for _ in range(2):
        segments.append_rows(top, path, p.run_id)
    return segments.read_rows(spark, path, top.schema)


def sink_queries(p):
    return {
        "table_overwrite_roundtrip": lambda s, d: _table_roundtrip(s, d, p),
        "visits_clustered_in_range": lambda s, d: _clustered_visits(s, d, p),
        "category_top10_appended": lambda s, d: _appended_top10(s, d, p),
    }


def stream_queries(p):
    return {
        "stream_ad_log_parse": lambda s, d: _run_parse(s, d, p, True),
        "stream_ad_log_rejects": lambda s, d: _run_parse(s, d, p, False),
        "stream_ad_blacklist": lambda s, d: _run_blacklist(s, d, p),
        "stream_ad_area_city_clicks": lambda s, d: _run_area_city(s, d, p),
        "stream_ad_area_city_clicks_incr": lambda s, d: _run_area_city_incr(s, d, p),
        "stream_ad_segments_city_clicks": lambda s, d: _run_segments(s, d, p),
        "stream_ad_area_top3": lambda s, d: _run_top3(s, d, p, as_json=False),
        "stream_ad_area_top3_json": lambda s, d: _run_top3(s, d, p, as_json=True),
    }
