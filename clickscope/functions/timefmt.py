"""Time helpers that do not depend on the session time zone.

Day buckets and text times are computed from epoch milliseconds with
UTC-aligned arithmetic on ``timestamp_ntz`` values, so a job gives the
same day for an event on every cluster regardless of
``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from clickscope.fixed import DAY_FORMAT, TIME_FORMAT

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
MS_PER_DAY = 86_400_000


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_ms_of(ts_ntz: Column | str) -> Column:
    """Epoch milliseconds (UTC) of a ``timestamp_ntz`` column.

    Microseconds are rounded to the nearest millisecond, halves away from
    zero (``.0005`` -> 1 ms), in exact integer arithmetic.
    """
    us = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), _c(ts_ntz))
    return (F.when(us >= 0, F.floor((us + 500) / 1000))
            .otherwise(-F.floor((-us + 500) / 1000))).cast("bigint")


def epoch_ms_to_ntz(ms: Column | str) -> Column:
    return F.timestamp_add("MILLISECOND", _c(ms), F.expr(_EPOCH_NTZ))


def epoch_ms_to_day(ms: Column | str) -> Column:
    """``yyyy-MM-dd`` UTC day of an epoch-ms value."""
    days = F.floor(_c(ms) / F.lit(MS_PER_DAY)).cast("int")
    return F.date_format(F.date_from_unix_date(days), DAY_FORMAT)


def epoch_ms_to_text(ms: Column | str, fmt: str = TIME_FORMAT) -> Column:
    """Format an epoch-ms value as text in UTC (default second-level format)."""
    return F.date_format(epoch_ms_to_ntz(ms), fmt)


def ts_text(ts: Column | str, fmt: str = TIME_FORMAT) -> Column:
    """Format a timestamp or date column as text."""
    return F.date_format(_c(ts), fmt)
