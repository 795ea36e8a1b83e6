"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from clickscope.functions.lists import jvm_split
from clickscope.functions.timefmt import (
    epoch_ms_of, epoch_ms_to_day, epoch_ms_to_text, ts_text,
)
from clickscope.functions.render import ordered_json_object

__all__ = [
    "jvm_split", "epoch_ms_of", "epoch_ms_to_day",
    "epoch_ms_to_text", "ts_text", "ordered_json_object",
]
