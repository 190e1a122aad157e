"""Time expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def parse_iso_ts(text, lenient: bool = False) -> Column:
    """ISO-8601 text → timestamp. Strict raises on bad text (ANSI); lenient gives null."""
    return F.try_to_timestamp(_c(text)) if lenient else F.to_timestamp(_c(text))


def uptime_seconds(ingestion_ts, started_at) -> Column:
    """Whole seconds between start and poll (each side floored to seconds)."""
    return F.unix_timestamp(_c(ingestion_ts)) - F.unix_timestamp(_c(started_at))


def epoch_to_ts(epoch_seconds) -> Column:
    return F.timestamp_seconds(_c(epoch_seconds))


def truncate_ts(ts, grain: str | None) -> Column:
    """Timestamp truncated to a grain ('minute', 'hour', 'day'); None keeps it exact."""
    return _c(ts) if grain is None else F.date_trunc(grain, _c(ts))
