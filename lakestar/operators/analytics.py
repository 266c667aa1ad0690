"""Reports on the star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.specs import CHECK_YEAR


def sales_by_category_year(fact: DataFrame, categories: DataFrame) -> DataFrame:
    """Total sales by category and year, years ascending, largest totals first.

    Totals are formed per key, before the lookup: the join sees one row per category and
    year instead of every sale, and Spark broadcasts the categories by their actual size.
    """
    totals = fact.groupBy("category_sk", "sale_year").agg(F.sum("total_sales").alias("total_sales"))
    return (
        totals.join(categories.select("category_sk", "category"), "category_sk")
        .select("category", "sale_year", "total_sales")
        .orderBy("sale_year", F.desc("total_sales"))
    )


def sales_by_year(fact: DataFrame) -> DataFrame:
    """Total sales by year, in order."""
    return (
        fact.groupBy("sale_year")
        .agg(F.sum("total_sales").alias("total_sales"))
        .orderBy("sale_year")
    )


def load_check(fact: DataFrame, year: int = CHECK_YEAR) -> DataFrame:
    """One row in one pass: ``years`` after ``year`` that the fact holds, and whether it ``passed``.

    A load that did not get there has no years and has not passed.
    """
    later = F.sort_array(F.collect_set(F.when(F.col("sale_year") > year, F.col("sale_year"))))
    return fact.select("sale_year").agg(later.alias("years")).select("years", (F.size("years") > 0).alias("passed"))
