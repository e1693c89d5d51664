"""Dates delivered as text.

A value in ISO form goes straight to the cast, which checks the calendar; other forms are rewritten to it
first. No exception is raised per bad row. Times carry no zone, so results do not depend on the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tandem.functions.text import EDGE_CHARS

_ISO = r"^\d{4}-\d\d-\d\d( \d\d:\d\d:\d\d)?$"
_TURNED = r"^(\d\d)/(\d\d)/(\d{4})$"


def is_iso(text: Column) -> Column:
    """``yyyy-MM-dd`` or ``yyyy-MM-dd HH:mm:ss``, whatever the digits."""
    return text.rlike(_ISO)


def parse_date(value: Column) -> Column:
    """Zone-free timestamp from ``yyyy-MM-dd HH:mm:ss``, ``yyyy-MM-dd`` or ``dd/MM/yyyy``; else null.

    Values that are in ISO form as they stand, nearly all, are neither trimmed nor rewritten.
    """
    rewritten = F.regexp_replace(F.btrim(value, F.lit(EDGE_CHARS)), _TURNED, "$3-$2-$1")
    repaired = F.regexp_extract(rewritten, _ISO, 0)
    return F.when(is_iso(value), value).otherwise(repaired).try_cast("timestamp_ntz")


def normal_date(value: Column, with_time: bool = False) -> Column:
    """Text date in normal form, ``yyyy-MM-dd`` or ``yyyy-MM-dd HH:mm:ss``; null when no form fits."""
    parsed = parse_date(value)
    return (parsed if with_time else parsed.cast("date")).cast("string")


def to_time(value: Column) -> Column:
    """Timestamp from text; unreadable text gives null instead of an error under ANSI mode."""
    return value.try_cast("timestamp")


def days_between(start: Column, end: Column) -> Column:
    """Whole days from text date ``start`` to text date ``end``; negative when end comes first."""
    return F.datediff(to_time(end), to_time(start))
