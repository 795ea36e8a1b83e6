"""Structured Streaming jobs, and how what they keep is read."""

from clickscope.streaming.counters import Counters
from clickscope.streaming.jobs import (
    area_city_clicks, parsed_clicks, parsed_log, start_ad_log_parse, start_area_city_clicks,
    start_area_city_clicks_incr, start_area_top3, start_blacklist, top3_json,
)
from clickscope.streaming.latest import Latest
from clickscope.streaming.state import banned_users, running_state, user_clicks

__all__ = [
    "Counters", "Latest", "area_city_clicks", "banned_users", "parsed_clicks", "parsed_log", "running_state",
    "start_ad_log_parse", "start_area_city_clicks", "start_area_city_clicks_incr", "start_area_top3",
    "start_blacklist", "top3_json", "user_clicks",
]
