"""The registered query catalogue: name -> (spark, sf_dir) -> DataFrame.

Every query reads the shared test tables (through the adapters) and runs
over them whole; parameters are the documented test settings.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from clickscope.functions.timefmt import epoch_ms_to_text
from clickscope.operators import ads as A
from clickscope.operators import category as C
from clickscope.operators import pageflow as P
from clickscope.plans import inputs
from clickscope.sources import adlog
from clickscope.sources.tables import visits_in_range


@dataclass(frozen=True)
class Params:
    """Test settings (fixed values shared with the SQL oracle)."""
    start: str = "2024-01-05"
    end: str = "2024-01-07"
    path: str = "1,2,3,4,5,6,7"
    threshold: int = 3
    top_categories: int = 10
    top_sessions: int = 10
    top_ads: int = 3
    truncate_every: int = 97
    tie_col: str = "event_id"
    tie_split: int = 1000
    run_id: str = "run-1"


P0 = Params()
Query = Callable[[SparkSession, str], DataFrame]


def batch_queries(p: Params = P0) -> dict[str, Query]:
    a = inputs.ads

    def v(s, d):  # all required columns (queries returning whole rows)
        return inputs.visits(s, d)

    def vc(s, d):  # the columns the category questions read
        return inputs.visits(s, d, C.REQUIRED)

    def vs(s, d):  # ... plus the session
        return inputs.visits(s, d, C.SESSION_REQUIRED)

    def vp(s, d):  # the columns the page-flow questions read
        return inputs.visits(s, d, P.REQUIRED)

    def top(s, d):
        return C.category_top10(vc(s, d), p.top_categories)

    return {
        "visits_conformed": lambda s, d: v(s, d),
        "visits_quarantine": inputs.quarantined,
        "visits_in_range": lambda s, d: visits_in_range(inputs.visits(s, d, None, p.start, p.end), p.start, p.end),
        "category_action_facts": lambda s, d: C.category_action_facts(vc(s, d)),
        "category_counts": lambda s, d: C.category_counts(vc(s, d)),
        "category_top10": top,
        "category_top10_run": lambda s, d: C.category_top10(vc(s, d), p.top_categories, task_id=p.run_id),
        "category_clicks_in_top10": lambda s, d: C.category_clicks_in_top10(
            vs(s, d), n=p.top_categories, ranking_visits=vc(s, d)),
        "category_session_clicks": lambda s, d: C.category_session_clicks(vs(s, d)),
        "category_session_top10": lambda s, d: C.category_session_top10(
            vs(s, d), n_categories=p.top_categories, n_sessions=p.top_sessions,
            ranking_visits=vc(s, d)),
        "page_views_in_flow": lambda s, d: P.page_views_in_flow(vp(s, d), p.path),
        "page_transitions": lambda s, d: P.page_transitions(vp(s, d), p.tie_col),
        "page_transition_counts": lambda s, d: P.page_transition_counts(vp(s, d), p.path, p.tie_col),
        "page_flow_rate": lambda s, d: P.page_flow_rate(vp(s, d), p.path, p.tie_col, p.tie_split),
        "page_flow_rate_no_tie": lambda s, d: P.page_flow_rate(inputs.bare_visits(s, d, P.REQUIRED), p.path,
                                                               tie_split=p.tie_split),
        "ad_log_parse": lambda s, d: adlog.ad_log_parse(inputs.raw_lines(s, d, p.truncate_every)),
        "ad_log_rejects": lambda s, d: adlog.ad_log_rejects(inputs.raw_lines(s, d, p.truncate_every)),
        "ad_click_times": lambda s, d: a(s, d).select("event_id", "ts_ms", epoch_ms_to_text("ts_ms").alias("click_time")),
        "ad_user_day_clicks": lambda s, d: A.ad_user_day_clicks(a(s, d)),
        "ad_blacklist": lambda s, d: A.ad_blacklist(a(s, d), p.threshold),
        "ad_log_filtered": lambda s, d: A.ad_log_filtered(a(s, d), p.threshold),
        "ad_admitted_clicks": lambda s, d: A.ad_admitted_clicks(a(s, d), p.threshold),
        "ad_area_city_clicks": lambda s, d: A.ad_area_city_clicks(a(s, d)),
        "ad_area_clicks": lambda s, d: A.ad_area_clicks(a(s, d)),
        "ad_area_top3": lambda s, d: A.ad_area_top3(A.ad_area_clicks(a(s, d)), p.top_ads),
        "ad_area_top3_json": lambda s, d: A.ad_area_top3_json(
            A.ad_area_top3(A.ad_area_clicks(a(s, d)), p.top_ads)),
    }


def all_queries(p: Params = P0) -> dict[str, Query]:
    from clickscope.plans.runs import sink_queries, stream_queries
    q = batch_queries(p)
    q.update(sink_queries(p))
    q.update(stream_queries(p))
    return q
