"""Timestamp parsing and formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted shapes, tried in order: ISO with or without seconds/fraction and
# offset (Spark's default parser), then minute precision with 'Z'/offset.
_FULL_DATE = r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}([T\s]|$)"
_FALLBACK_PATTERNS = ["yyyy-MM-dd'T'HH:mmXXX", "yyyy-MM-dd'T'HH:mm:ssXXX",
                      "yyyy-MM-dd HH:mm:ss"]


def parse_iso(col) -> Column:
    """ISO-8601 text -> timestamp; NULL (not an error) when unparsable.

    Naive text is read as UTC (the session zone of every job).  Text must
    begin with a full date: a bare time or year is not a timestamp.
    """
    c = F.col(col) if isinstance(col, str) else col
    c = F.when(c.cast("string").rlike(_FULL_DATE), c)
    tries = [F.try_to_timestamp(c)] + [F.try_to_timestamp(c, F.lit(p)) for p in _FALLBACK_PATTERNS]
    return F.coalesce(*tries)


def iso_offset(col) -> Column:
    """``2026-03-03T00:00:00+00:00`` (seconds, numeric offset)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ssxxx")


def compact_stamp(col) -> Column:
    """``20260303T0000`` (used in landed file names)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, "yyyyMMdd'T'HHmm")


def date_key(col) -> Column:
    """Zero-padded ``year=YYYY/month=MM/day=DD`` path fragment."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, "'year='yyyy'/month='MM'/day='dd")


def period_start(col) -> Column:
    """Minute-precision UTC stamp with ``Z`` as used in load documents."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm'Z'")


def utc_wall_clock(col, source_zone: str = "UTC") -> Column:
    """Naive local time in ``source_zone`` -> UTC timestamp."""
    c = F.col(col) if isinstance(col, str) else col
    return F.to_utc_timestamp(c, source_zone)
