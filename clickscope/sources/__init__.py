"""Readers, adapters and parsers that produce the package's input frames."""

from clickscope.sources.tables import (
    read_table, visits_in_range, conform_visits, load_testdata,
)
from clickscope.sources.adapters import (
    visit_actions_from_events, ad_clicks_from_events, ad_log_lines,
)
from clickscope.sources.adlog import (
    parse_ad_log, ad_log_parse, ad_log_rejects, read_ad_log_files,
    read_ad_log_kafka,
)

__all__ = [
    "read_table", "visits_in_range", "conform_visits", "load_testdata",
    "visit_actions_from_events", "ad_clicks_from_events", "ad_log_lines",
    "parse_ad_log", "ad_log_parse", "ad_log_rejects", "read_ad_log_files",
    "read_ad_log_kafka",
]
