"""Dates and the year/month partitions made from them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_date(value: Column) -> Column:
    """A date from ``yyyy-MM-dd`` text; null, never an error, for other text."""
    return F.try_to_date(value.cast("string"), "yyyy-MM-dd")


def period(date: Column) -> dict[str, Column]:
    """The partition columns of a sale date."""
    return {"sale_year": F.year(date), "sale_month": F.month(date)}


def later_than(mark: dt.date | None) -> Column:
    """Sales strictly after ``mark``; without a mark, every sale.

    The year and month bounds follow from the date bound. They are stated because a date
    filter alone reaches row groups, not the year/month partitions.
    """
    if mark is None:
        return F.lit(True)
    year, month = F.col("sale_year"), F.col("sale_month")
    in_range = (year > mark.year) | ((year == mark.year) & (month >= mark.month))
    return in_range & (F.col("sale_date") > F.lit(mark))


def up_to(mark: dt.date) -> Column:
    """The complement of :func:`later_than` among dated sales, with the same pruning."""
    year, month = F.col("sale_year"), F.col("sale_month")
    in_range = (year < mark.year) | ((year == mark.year) & (month <= mark.month))
    return in_range & (F.col("sale_date") <= F.lit(mark))
