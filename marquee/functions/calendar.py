"""Calendar keys used for grouping and partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_week_label(day: Column | str) -> Column:
    """'2026-W01', from the ISO week-year so that a week at New Year stays whole."""
    day = F.col(day) if isinstance(day, str) else day
    week = F.lpad(F.weekofyear(day).cast("string"), 2, "0")
    return F.concat(F.extract(F.lit("YEAROFWEEK"), day).cast("string"), F.lit("-W"), week)


def week_start(day: Column | str) -> Column:
    """The Monday on or before the day."""
    return F.date_trunc("week", day).cast("date")


def month_start(day: Column | str) -> Column:
    return F.trunc(day, "MM")


def month_label(day: Column | str) -> Column:
    return F.date_format(day, "yyyy-MM")


def epoch_day(day: Column | str) -> Column:
    return F.unix_date(day)
