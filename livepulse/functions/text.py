"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from livepulse.functions.constants import (
    ARROW, ENVELOPE_HEADER_BYTES, READABLE_TS_FORMAT, THUMBNAIL_1080P, THUMBNAIL_PLACEHOLDER)


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def strip_envelope(value, header_bytes: int = ENVELOPE_HEADER_BYTES) -> Column:
    """Drop the schema-registry header (magic byte + 4-byte schema id) of a message.

    Works on binary and string; a message of exactly the header length gives an
    empty payload.
    """
    v = _c(value)
    return v.substr(F.lit(header_bytes + 1), F.length(v) - F.lit(header_bytes))


def resolve_thumbnail(url, size: str = THUMBNAIL_1080P) -> Column:
    """Replace every {width}x{height} placeholder with a concrete size."""
    return F.regexp_replace(_c(url), THUMBNAIL_PLACEHOLDER, size)


def normalise_tag(tag) -> Column:
    """lower(trim(tag)); trims spaces only, keeps empty strings."""
    return F.lower(F.trim(_c(tag)))


def readable_ts(ts) -> Column:
    return F.date_format(_c(ts), READABLE_TS_FORMAT)


def change_text(old, new) -> Column:
    return F.concat_ws(ARROW, F.coalesce(_c(old), F.lit("None")), F.coalesce(_c(new), F.lit("None")))


def event_label(event_type) -> Column:
    return F.replace(_c(event_type), F.lit("_"), F.lit(" "))
