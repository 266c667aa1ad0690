"""Bronze and silver by month, for deliveries that correct whole months.

A delivery holds all sales of some months. It takes the place of what those months had, in bronze
and in silver, and leaves all others as they are (dynamic partition overwrite). Delivering it again
changes nothing, so a lost run is repeated as it is. Sales without a date are a month of their own.

A reader during the commit may see a month's old files go before the new ones come; who needs more
reads the batch tables (``plans.ingest``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestar.operators.silver import clean, with_period
from lakestar.session import freeing_shuffles
from lakestar.sources.landing import MALFORMED, read_landing
from lakestar.sources.tables import Lake, gathered, read_table
from lakestar.specs import BATCH, BRONZE_SCHEMA, PERIOD, SILVER_SCHEMA

Months = list[tuple[int | None, int | None]]


def _by_month(schema: T.StructType) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name != BATCH])


def bronze_months(lake: Lake) -> DataFrame:
    return read_table(lake.spark, f"{lake.root}/bronze/months", _by_month(BRONZE_SCHEMA))


def silver_months(lake: Lake) -> DataFrame:
    return read_table(lake.spark, f"{lake.root}/silver/months", _by_month(SILVER_SCHEMA))


def replace_months(rows: DataFrame, path: str, gather: bool = True) -> Months:
    """Write rows over the months they are of; which those are, the writing tasks tell."""
    seen = Observation()
    rows = gathered(rows, *PERIOD) if gather else rows
    months = F.collect_set(F.struct(*PERIOD)).alias("months")  # as many as the delivery has
    writer = rows.observe(seen, months).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with freeing_shuffles(rows.sparkSession):
        writer.partitionBy(*PERIOD).parquet(path)
    return [tuple(m) for m in seen.get["months"] or []]


def in_months(months: Months) -> Column:
    """Rows of these months; only their folders are listed and read."""
    year, month = (F.col(c) for c in PERIOD)
    return reduce(
        Column.__or__, [year.eqNullSafe(F.lit(y)) & month.eqNullSafe(F.lit(m)) for y, m in months], F.lit(False)
    )


def deliver_months(lake: Lake, rows: DataFrame, gather: bool = True) -> Months:
    """Replace the months of raw rows in bronze, then in silver; the months, in order.

    Rows that lie by month already need no shuffle: ``gather=False``.

    Silver is cleaned from bronze as stored, file by file: bronze files hold one month each, so this
    needs no shuffle. A delivery without rows changes nothing.
    """
    if "source_file" not in rows.columns:
        rows = rows.withColumn("source_file", F.lit(None).cast("string"))
    raw = with_period(rows).select(*_by_month(BRONZE_SCHEMA).names)
    months = replace_months(raw, f"{lake.root}/bronze/months", gather)
    if months:
        stored = bronze_months(lake).where(in_months(months))
        replace_months(clean(stored).select(*_by_month(SILVER_SCHEMA).names), f"{lake.root}/silver/months", gather=False)
    return sorted(months, key=repr)


def deliver_month_files(lake: Lake, paths: str | list[str]) -> Months:
    """The same from landing files. A delivery with malformed lines is refused: its months would lack them."""
    rows = read_landing(lake.spark, paths, malformed=True)
    broken = rows.where(F.col(MALFORMED).isNotNull()).limit(1).collect()  # all fields: see read_landing
    if broken:
        raise ValueError(f"malformed lines in {broken[0].source_file}: no month is replaced by a part of it")
    return deliver_months(lake, rows.drop(MALFORMED))
