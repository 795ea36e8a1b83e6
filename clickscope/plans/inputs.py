"""Input frames for the registered queries, derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickscope.schemas import VISIT_ACTION
from clickscope.sources.adapters import (
    ad_clicks_from_events, ad_log_lines, events_in_range, visit_actions_from_events,
)
from clickscope.sources.tables import conform_visits, load_testdata


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_testdata(spark, sf_dir, "events")


def visits(spark: SparkSession, sf_dir: str, required: list[str] | None = None,
           start: str | None = None, end: str | None = None) -> DataFrame:
    """Conformed visit actions; ``required`` as in :func:`conform_visits`
    (default: every non-nullable column). The other rows are those of
    :func:`quarantined`. Bounds are pushed into the scan of ``events``."""
    good, _ = conform_visits(visit_actions_from_events(events_in_range(events(spark, sf_dir), start, end)), required)
    return good


def raw_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visit actions as a raw table may hold them: ids as text, some null or not numeric.

    Of the events whose id divides by 50 the page id is null, of those that
    leave 1 the user id is not a number, of those that leave 2 the time is null.
    """
    v = visit_actions_from_events(events(spark, sf_dir))
    rest = F.col("event_id") % 50
    return (v.withColumn("page_id", F.when(rest != 0, F.col("page_id").cast("string")))
            .withColumn("user_id", F.when(rest == 1, "unknown").otherwise(F.col("user_id").cast("string")))
            .withColumn("action_time", F.when(rest != 2, F.col("action_time"))))


def quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of :func:`raw_visits` that do not conform, with their raw values."""
    _, bad = conform_visits(raw_visits(spark, sf_dir))
    return bad


def bare_visits(spark: SparkSession, sf_dir: str, required: list[str]) -> DataFrame:
    """Visits with no column beyond the visit-action schema (no tie column)."""
    v = visits(spark, sf_dir, required)
    return v.select(*[c for c in v.columns if c in VISIT_ACTION.fieldNames()])


def ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad clicks with the tie column: (event_id, ts_ms, dt, province, city, userid, adid)."""
    return ad_clicks_from_events(events(spark, sf_dir), load_testdata(spark, sf_dir, "nation"),
                                 load_testdata(spark, sf_dir, "region"))


def raw_lines(spark: SparkSession, sf_dir: str, truncate_every: int) -> DataFrame:
    """Ad-log wire lines (column ``value``) with some lines cut short."""
    return ad_log_lines(ads(spark, sf_dir), truncate_every)
