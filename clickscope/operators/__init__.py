"""DataFrame -> DataFrame operators answering the clickstream questions."""

from clickscope.operators.category import (
    category_action_facts, category_counts, category_top10,
    category_clicks_in_top10, category_session_clicks, category_session_top10,
)
from clickscope.operators.pageflow import (
    parse_page_path, path_pairs, page_views_in_flow, page_transitions,
    page_transition_counts, page_flow_rate,
)
from clickscope.operators.ads import (
    ad_user_day_clicks, over_threshold, ad_blacklist, ad_log_filtered, ad_admitted_clicks,
    ad_area_city_clicks, ad_area_clicks, ad_area_top3, ad_area_top3_json,
)

__all__ = [
    "category_action_facts", "category_counts", "category_top10",
    "category_clicks_in_top10", "category_session_clicks", "category_session_top10",
    "parse_page_path", "path_pairs", "page_views_in_flow", "page_transitions",
    "page_transition_counts", "page_flow_rate",
    "ad_user_day_clicks", "over_threshold", "ad_blacklist", "ad_log_filtered", "ad_admitted_clicks",
    "ad_area_city_clicks", "ad_area_clicks", "ad_area_top3", "ad_area_top3_json",
]
