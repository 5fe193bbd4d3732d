"""Date rules."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def earliest() -> Column:
    return F.lit(datetime.date(1900, 1, 1))


def latest() -> Column:
    return F.lit(datetime.date(9999, 12, 31))


def or_earliest(date: Column) -> Column:
    return F.coalesce(date, earliest())


def or_latest(date: Column) -> Column:
    return F.coalesce(date, latest())


def parse_date(text: Column) -> Column:
    """The day written in a string, whatever time and offset follow; null if it is no date."""
    day = F.try_to_date(F.regexp_extract(text, r"^\s*([0-9]{4}(?:-[0-9]{1,2}){0,2})(?:[T\s]|$)", 1))
    return F.when(F.try_to_timestamp(text).isNotNull(), day)


def proximity(a: Column, b: Column) -> Column:
    """1 on the same day, 0.01 less per day apart, never under 0; null if either is null."""
    score = F.lit(1.0) - F.abs(F.datediff(a, b)) / F.lit(100.0)
    return F.when(score < 0, F.lit(0.0)).otherwise(score)


def longer_than_a_day(start: Column, end: Column) -> Column:
    """True for a spell over one day and for an open one."""
    return F.coalesce(F.datediff(end, start) > 1, F.lit(True))


def undo_frozen_end(end: Column, frozen_as_of: datetime.date | None) -> Column:
    """Turn an end date that only marks the day of a past run back into "open"."""
    return end if frozen_as_of is None else F.when(end == F.lit(frozen_as_of), latest()).otherwise(end)
