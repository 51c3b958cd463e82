"""Calendar expressions; all dates and hours are UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.text import ColumnLike, as_column


def year_month(c: ColumnLike) -> Column:
    return F.date_format(as_column(c), "yyyy-MM")


def year_label(c: ColumnLike) -> Column:
    return F.date_format(as_column(c), "yyyy")


def day_name(c: ColumnLike) -> Column:
    return F.date_format(as_column(c), "EEEE")


def year_week(c: ColumnLike) -> Column:
    """Year and week '00' to '53'; weeks start on Monday, days before the first one are week 00."""
    c = as_column(c)
    week = F.floor((F.dayofyear(c) + F.lit(6) - F.weekday(c)) / F.lit(7)).cast("string")
    return F.concat_ws("-", F.date_format(c, "yyyy"), F.lpad(week, 2, "0"))


def iso_day_num(c: ColumnLike) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(as_column(c)) + F.lit(1)


def sunday_day_num(c: ColumnLike) -> Column:
    """Sunday 1 to Saturday 7."""
    return F.dayofweek(as_column(c))


def event_hour(c: ColumnLike) -> Column:
    return F.hour(as_column(c))


def days_between(later: ColumnLike, earlier: ColumnLike) -> Column:
    return F.datediff(as_column(later), as_column(earlier)).cast("bigint")


def utc_timestamp(c: ColumnLike) -> Column:
    """Timestamp text, with or without a closing ' UTC'."""
    return F.regexp_replace(as_column(c), " UTC$", "").cast("timestamp")
