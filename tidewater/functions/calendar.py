"""Calendar expressions over dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(d: Column) -> Column:
    """yyyyMMdd as an integer."""
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def month_label(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def quarter_label(d: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(d).cast("string"))


def month_start(label: Column) -> Column:
    """First day of a ``yyyy-MM`` label; bad labels raise."""
    return F.to_date(F.concat(label, F.lit("-01")), "yyyy-MM-dd")


def week_of_year(d: Column) -> Column:
    """Week number where January 1 is in week 1 and weeks begin on Sunday (not ISO)."""
    offset = F.dayofweek(F.trunc(d, "YEAR")) - 1
    return (F.floor((F.dayofyear(d) - 1 + offset) / 7) + 1).cast("int")


def is_weekday(d: Column) -> Column:
    return ~F.dayofweek(d).isin(1, 7)
