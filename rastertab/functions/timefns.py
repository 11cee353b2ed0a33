"""Time helpers (SCL-7, SCL-9, SCL-10, SCL-14)."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Slice formats used in staging names and paths.
CYCLE_SUFFIX_FORMAT = "%Y%m%d%H"
CYCLE_LAG_HOURS = 4  # a cycle is processed 4 hours after its nominal time


def to_datetime(ts: Column) -> Column:
    """SCL-7 ``DATETIME(ts)``: UTC civil time (session time zone is UTC)."""
    return ts.cast("timestamp_ntz")


def hour_diff(start: Column, end: Column) -> Column:
    """SCL-9 ``TIMESTAMP_DIFF(end, start, HOUR)``: whole hours, truncated toward zero."""
    return F.timestamp_diff("HOUR", start, end)


def epoch_millis_to_timestamp(v: Column) -> Column:
    """SCL-10 (Parquet): epoch milliseconds -> timestamp."""
    return F.timestamp_millis(v.cast("bigint"))


def epoch_millis_to_text(v: Column) -> Column:
    """SCL-10 (CSV): epoch milliseconds -> ``yyyy-MM-ddTHH:mm:ss`` UTC, seconds truncated."""
    return F.date_format(F.timestamp_seconds(F.floor(v.cast("double") / 1000)), "yyyy-MM-dd'T'HH:mm:ss")


def cycle_time(execution_time: datetime) -> datetime:
    """SCL-14: the cycle a run processes (execution time minus 4 hours)."""
    return execution_time - timedelta(hours=CYCLE_LAG_HOURS)


def cycle_time_col(ts: Column) -> Column:
    return ts - F.expr(f"INTERVAL {CYCLE_LAG_HOURS} HOURS")


def cycle_suffix(t: datetime) -> str:
    return t.strftime(CYCLE_SUFFIX_FORMAT)
