from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(c: Column | str) -> Column:
    """The day of a date, timestamp or ISO text. Bad text raises under ANSI mode."""
    return _col(c).cast("date")


def month_start(c: Column | str) -> Column:
    return F.trunc(_col(c), "MM")


def season(c: Column | str) -> Column:
    """The calendar year as text."""
    return F.year(_col(c)).cast("string")
