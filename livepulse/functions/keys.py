"""Surrogate and date keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def surrogate_key(*cols) -> Column:
    """64-bit surrogate key: xxhash64 of the natural key ('abc' → 1423657621850124518, null → 42)."""
    return F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in cols])


def date_key(year, month, day) -> Column:
    """YYYYMMDD as a long (same value as concat(y, lpad(m,2,'0'), lpad(d,2,'0')))."""
    y, m, d = (F.col(c) if isinstance(c, str) else c for c in (year, month, day))
    return (y.cast("long") * 10000 + m.cast("long") * 100 + d.cast("long"))
