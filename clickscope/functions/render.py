"""Rendering helpers for exported values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ordered_json_object(entries: Column) -> Column:
    """Compact JSON object text from an ``array<struct<key, value>>``.

    Entry order is kept, e.g. ``{"9":30,"10":20,"1":5}``.
    """
    return F.to_json(F.map_from_entries(entries))
