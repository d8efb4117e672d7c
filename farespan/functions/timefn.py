"""Date helpers with SQL Server counting rules.

Elapsed "hours", "days" and "years" count the boundaries crossed, and weeks run
from Sunday with week 1 holding 1 January.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day(ts: ColumnLike) -> Column:
    """The calendar day of a timestamp."""
    return F.to_date(col(ts))


def plus_hours(ts: ColumnLike, hours: int) -> Column:
    return col(ts) + F.expr(f"INTERVAL '{hours}' HOUR")


def days_between(a: ColumnLike, b: ColumnLike) -> Column:
    return F.datediff(day(b), day(a))


def hours_between(a: ColumnLike, b: ColumnLike) -> Column:
    return days_between(a, b) * 24 + F.hour(col(b)) - F.hour(col(a))


def minutes_between(a: ColumnLike, b: ColumnLike) -> Column:
    return hours_between(a, b) * 60 + F.minute(col(b)) - F.minute(col(a))


def years_between(a: ColumnLike, b: ColumnLike) -> Column:
    return F.year(col(b)) - F.year(col(a))


def us_week(d: ColumnLike) -> Column:
    """Week of year, Sunday start, week 1 holds 1 January."""
    c = col(d)
    first = F.dayofweek(F.trunc(c, "year"))
    return (F.floor((F.dayofyear(c) + first - 2) / 7) + 1).cast("int")


def week_of_month(d: ColumnLike) -> Column:
    """Week number of day-of-month counted from 1 January 1900 (a Monday)."""
    return (F.floor((F.dayofmonth(col(d)) + 1) / 7) + 1).cast("int")


def week_label(week: Column) -> Column:
    return F.concat(F.lit("W"), week.cast("string"))


def month_name(d: ColumnLike) -> Column:
    return F.date_format(col(d), "MMMM")


def month_label(d: ColumnLike) -> Column:
    """``Jan-15`` style label."""
    return F.date_format(col(d), "MMM-yy")


def weekday_name(d: ColumnLike) -> Column:
    return F.date_format(col(d), "EEEE")


def int_div(x: Column, n: int) -> Column:
    """Integer division that truncates towards zero."""
    return (x / n).cast("int")


def day_number(d: ColumnLike) -> Column:
    """Days since 1970-01-01, usable as a numeric range-frame key."""
    return F.datediff(day(d), F.lit("1970-01-01").cast("date"))
