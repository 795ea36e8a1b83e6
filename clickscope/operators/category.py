"""Category ranking by clicks, orders and payments, and top sessions per category.

An action is a click, *or else* an order, *or else* a payment, in that
priority, even when several columns are filled. Category ids are text,
so ``"01"`` and ``"1"`` are different categories and ties on all counts
fall back to text order (``"10"`` before ``"2"``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from clickscope.fixed import NOT_A_CLICK, TOP_CATEGORIES, TOP_SESSIONS
from clickscope.functions.lists import jvm_split

# Non-null columns the category questions read (see conform_visits).
REQUIRED = ["click_category_id"]
SESSION_REQUIRED = ["click_category_id", "session_id"]



def _is_click():
    return F.col("click_category_id") != NOT_A_CLICK


def category_action_facts(visits: DataFrame) -> DataFrame:
    """One row per (category, action) occurrence: (category_id, action).

    A click gives one row; an order or payment gives one row per id in its
    comma list, repeats included. Rows with no action give none.
    """
    is_order = F.col("order_category_ids").isNotNull()
    is_pay = F.col("pay_category_ids").isNotNull()
    ids = (F.when(_is_click(), F.array(F.col("click_category_id").cast("string")))
           .when(is_order, jvm_split("order_category_ids"))
           .when(is_pay, jvm_split("pay_category_ids")))
    action = (F.when(_is_click(), F.lit("click"))
              .when(is_order, F.lit("order"))
              .when(is_pay, F.lit("pay")))
    return visits.select(F.explode(ids).alias("category_id"), action.alias("action"))


def category_counts(visits: DataFrame) -> DataFrame:
    """(category_id, click_count, order_count, pay_count); an absent action counts 0.

    A single hash aggregate: partial counts are combined map-side, so only
    one row per category and task crosses the shuffle, however skewed.
    """
    a = F.col("action")
    return (category_action_facts(visits).groupBy("category_id")
            .agg(F.count_if(a == "click").alias("click_count"),
                 F.count_if(a == "order").alias("order_count"),
                 F.count_if(a == "pay").alias("pay_count")))


def category_top10(visits: DataFrame, n: int = TOP_CATEGORIES, task_id: str | None = None) -> DataFrame:
    """Top-n categories by clicks, then orders, then payments (all descending).

    ``task_id`` (one id per run, e.g. ``str(uuid4())``) is added as the
    first column when given, for the result sinks.
    """
    top = (category_counts(visits)
           .orderBy(F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"),
                    F.asc("category_id"))
           .limit(n))
    if task_id is not None:
        top = top.select(F.lit(task_id).alias("task_id"), *top.columns)
    return top


def category_clicks_in_top10(visits: DataFrame, top: DataFrame | None = None,
                             n: int = TOP_CATEGORIES,
                             ranking_visits: DataFrame | None = None) -> DataFrame:
    """Click rows of the top-n categories: (category_id, session_id).

    Without ``top`` the top-n is ranked here, from ``ranking_visits``
    (default ``visits``). It holds at most n rows by its limit, so it is
    broadcast and the click rows are filtered map-side with no shuffle. A
    ``top`` table of the caller's gets no hint: the planner (AQE) broadcasts
    it when its measured size allows.
    """
    if top is None:
        ranked = category_top10(ranking_visits if ranking_visits is not None else visits, n)
        wanted = F.broadcast(ranked.select("category_id"))
    else:
        wanted = top.select("category_id")
    clicks = (visits.where(_is_click())
              .select(F.col("click_category_id").cast("string").alias("category_id"),
                      "session_id"))
    return clicks.join(wanted, "category_id", "left_semi")


def category_session_clicks(visits: DataFrame) -> DataFrame:
    """Clicks per (category, session): (category_id, session_id, click_count)."""
    return (visits.where(_is_click())
            .groupBy(F.col("click_category_id").cast("string").alias("category_id"),
                     "session_id")
            .agg(F.count(F.lit(1)).alias("click_count")))


def category_session_top10(visits: DataFrame, top: DataFrame | None = None,
                           n_categories: int = TOP_CATEGORIES, n_sessions: int = TOP_SESSIONS,
                           task_id: str | None = None,
                           ranking_visits: DataFrame | None = None) -> DataFrame:
    """For each top category, its n sessions with most clicks.

    (category_id, session_id, click_count, rn); ties by session id. The
    session ranking is a ``row_number() <= n`` window, which Spark plans
    with a partial WindowGroupLimit before the shuffle: each map task sends
    at most n rows per category, so a category holding most of the data
    does not pile up in one task. ``task_id`` (one id per run) is added as
    the first column when given, for the result sinks.
    """
    in_top = category_clicks_in_top10(visits, top, n_categories, ranking_visits)
    counts = in_top.groupBy("category_id", "session_id").agg(F.count(F.lit(1)).alias("click_count"))
    w = Window.partitionBy("category_id").orderBy(F.desc("click_count"), F.asc("session_id"))
    ranked = (counts.withColumn("rn", F.row_number().over(w))
              .where(F.col("rn") <= n_sessions))
    if task_id is not None:
        ranked = ranked.select(F.lit(task_id).alias("task_id"), *ranked.columns)
    return ranked
