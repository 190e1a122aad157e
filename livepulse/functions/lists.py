"""Array expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def field_names(array_of_structs: str, field: str = "name") -> Column:
    """array<struct{..., name}> → array<name> (null array stays null)."""
    return F.col(f"{array_of_structs}.{field}")


def distinct_nested_names(array_of_structs: str, struct_field: str, field: str = "name") -> Column:
    """Two-level extraction, deduplicated; a null inner struct leaves one null element."""
    return F.array_distinct(F.col(f"{array_of_structs}.{struct_field}.{field}"))


def any_of(arr, values) -> Column:
    """True when the list shares at least one element with ``values``."""
    vals = list(values)
    if not vals:
        return F.lit(True)
    return F.exists(_c(arr), lambda x: x.isin(vals))


def parse_list_text(text) -> Column:
    """List text such as "['a', 'b']" → array<string>; null when it does not parse.

    Steps: trim, strip control characters, single → double quotes, parse as a
    JSON array. A label containing an apostrophe breaks the quoting and fails,
    as a text-to-JSON cleanup does.
    """
    cleaned = F.regexp_replace(F.trim(_c(text)), r"[\x00-\x1f\x7f]", "")
    jsonish = F.replace(cleaned, F.lit("'"), F.lit('"'))
    return F.from_json(jsonish, "array<string>")
