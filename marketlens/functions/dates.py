"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def date_key(moment: Column) -> Column:
    """``yyyymmdd`` as an integer, from arithmetic on the date parts."""
    return F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)


def elapsed_days(later: Column, earlier: Column) -> Column:
    """Whole days between two timestamps, truncated toward zero.

    This is elapsed time, not a calendar difference: half a day early is 0 days.
    """
    return F.extract(F.lit("DAY"), later - earlier).cast("int")


def week_ending_sunday(day: Column) -> Column:
    """The Sunday that closes the Monday-to-Sunday week of ``day``."""
    return F.next_day(F.date_sub(day, 1), "SUN")


def period_label(year: Column, month: Column) -> Column:
    return F.format_string("%d-%02d", year, month)
