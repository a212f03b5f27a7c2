"""Calendar expressions on DATE columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sunday_week(d: Column | str) -> Column:
    """Running number of the Sunday-started week a date falls in."""
    # 1970-01-04, day 3 of the epoch, is a Sunday
    return F.floor((F.unix_date(_col(d)) - 3) / 7)


def weeks_between(later: Column | str, earlier: Column | str) -> Column:
    """Number of Sundays crossed from ``earlier`` to ``later``."""
    return (sunday_week(later) - sunday_week(earlier)).cast("int")


def month_start(d: Column | str) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(_col(d), "MM")


def plus_weeks(d: Column | str, weeks: int) -> Column:
    return F.date_add(_col(d), 7 * weeks)
