"""Adapters from the shared test tables to the package's input model.

The visit-action table and the ad-click log are derived from the
``events`` table (and the small ``nation`` / ``region`` dimensions) with
plain column expressions, so the derived inputs grow with ``events``.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from clickscope.functions.timefmt import epoch_ms_of, epoch_ms_to_day, ts_text


def _k(events: DataFrame):
    return F.get_json_object("props", "$.k").try_cast("int")


def events_in_range(events: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Events that can become actions with ``start <= action_time <= end``.

    The bounds compare text (see :func:`visits_in_range`); for a bound that is
    a day or a full second they are the same as bounds on ``ts``, which
    reach the Parquet scan. A bound in any other form is left to the text rule.
    """
    for bound, at in ((start, "start"), (end, "end")):
        if bound is None or not re.fullmatch(r"\d{4}-\d\d-\d\d( \d\d:\d\d:\d\d)?", bound):
            continue
        t = datetime.fromisoformat(bound)
        if at == "end" and len(bound) > 10:
            t += timedelta(seconds=1)  # the text is cut to seconds
        limit = F.expr(f"TIMESTAMP_NTZ'{t.isoformat(sep=' ')}'")
        events = events.where(F.col("ts") >= limit if at == "start" else F.col("ts") < limit)
    return events


def visit_actions_from_events(events: DataFrame) -> DataFrame:
    """events(event_id, ts, user_id, event_type, value, props) -> visit actions.

    session = user id + day; page = k%10+1; a click carries category
    k%20+1 and product k+1; a signup is an order of three categories (a
    list may repeat an id, on purpose); a purchase pays two categories; a
    view is a search. ``event_id`` is kept as the tie column for actions in
    the same second. The product-id lists are not derived (no query reads them).
    """
    k = F.col("_k")
    et = F.col("event_type")
    s = lambda c: c.cast("string")
    return (events
            .select("event_id", "ts", "user_id", "event_type", _k(events).alias("_k"))
            .select(
                "event_id",
                ts_text("ts", "yyyy-MM-dd").alias("date"),
                "user_id",
                F.concat(s(F.col("user_id")), F.lit("-"), ts_text("ts", "yyyyMMdd")).alias("session_id"),
                (k % 10 + 1).cast("bigint").alias("page_id"),
                ts_text("ts").alias("action_time"),
                F.when(et == "view", F.concat(F.lit("kw"), s(k % 6))).alias("search_keyword"),
                F.when(et == "click", k % 20 + 1).otherwise(-1).cast("bigint").alias("click_category_id"),
                F.when(et == "click", k + 1).otherwise(-1).cast("bigint").alias("click_product_id"),
                F.when(et == "signup", F.concat_ws(",", s(k % 20 + 1), s((k * 7) % 20 + 1),
                                                   s((k * 3) % 20 + 1))).alias("order_category_ids"),
                F.when(et == "purchase", F.concat_ws(",", s(k % 20 + 1),
                                                     s((k * 11) % 20 + 1))).alias("pay_category_ids"),
                (F.col("user_id") % 26 + 1).cast("bigint").alias("city_id"),
            ))


def ad_clicks_from_events(events: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """events -> ad clicks (event_id, ts_ms, dt, province, city, userid, adid).

    city = nation name of ``user_id % 25``, province = its region name with
    spaces turned into ``-`` (the log line format has no spaces inside a
    field), ad = k%6+1. The nation/region lookup is a fixed-size dimension
    (25 and 5 rows), which the planner broadcasts by its size. The day is
    that of the rounded ``ts_ms``, as in the streams.
    """
    geo = (nation.join(region, nation.n_regionkey == region.r_regionkey)
           .select(F.col("n_nationkey").cast("bigint").alias("_nk"),
                   F.col("n_name").alias("city"),
                   F.regexp_replace("r_name", " ", "-").alias("province")))
    ev = events.select("event_id", "ts", "user_id", _k(events).alias("_k"),
                       (F.col("user_id") % 25).alias("_nk"))
    return (ev.join(geo, "_nk")
            .select("event_id",
                    epoch_ms_of("ts").alias("ts_ms"),
                    epoch_ms_to_day(epoch_ms_of("ts")).alias("dt"),
                    "province", "city",
                    F.col("user_id").cast("string").alias("userid"),
                    (F.col("_k") % 6 + 1).cast("string").alias("adid")))


def ad_log_lines(ads: DataFrame, truncate_every: int | None = None) -> DataFrame:
    """Render ad clicks as wire lines ``"<ts_ms> <area> <city> <user> <ad>"``.

    ``truncate_every=n`` cuts the ad field off the line of every event whose
    id is a multiple of n (every line is still emitted), which gives the
    reject path real input.
    """
    head = F.concat_ws(" ", F.col("ts_ms").cast("string"), "province", "city", "userid")
    tail = F.concat(F.lit(" "), F.col("adid"))
    if truncate_every:
        tail = F.when(F.col("event_id") % truncate_every == 0, F.lit("")).otherwise(tail)
    return ads.select(F.concat(head, tail).alias("value"))
