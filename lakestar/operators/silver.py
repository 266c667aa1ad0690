"""Bronze rows to clean, typed silver rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestar.functions.calendar import iso_date, period
from lakestar.functions.money import line_total, money, money_text, number_in_text
from lakestar.functions.text import city_name, email, full_name


def with_period(rows: DataFrame) -> DataFrame:
    """Add the year and month a table is partitioned by."""
    return rows.withColumns(period(F.col("sale_date")))


def _cleaned_text(raw: DataFrame) -> DataFrame:
    date = F.col("sale_date")
    if not isinstance(raw.schema["sale_date"].dataType, T.DateType):
        date = iso_date(date)
    return raw.withColumns(
        {
            "sale_date": date,
            "email": email(F.col("email_name")),
            "full_name": full_name(F.col("email_name")),
            "city": city_name(F.col("city")),
        }
    ).drop("email_name", "campaign_id")


def clean(raw: DataFrame) -> DataFrame:
    """Silver: parsed contact, decimal money, the total of each line, year and month."""
    rows = _cleaned_text(raw).withColumns(
        {"unit_price": money(F.col("unit_price")), "unit_cost": money(F.col("unit_cost"))}
    )
    total = line_total(F.col("unit_price"), F.col("units"))
    return with_period(rows.withColumn("total_sales", total))


def clean_as_text(raw: DataFrame) -> DataFrame:
    """Silver with money as text, for users who need those exact values.

    A total is computed from the price text, so it is null where that has a thousands comma.
    """
    rows = _cleaned_text(raw).withColumns(
        {
            "unit_price": money_text(F.col("unit_price")),
            "unit_cost": money_text(F.col("unit_cost")),
        }
    )
    total = money_text(number_in_text(F.col("unit_price")) * F.col("units"))
    return with_period(rows.withColumn("total_sales", total))
