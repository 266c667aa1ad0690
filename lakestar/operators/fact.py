"""The sales fact: dimension keys and measures, and the rows that find no key."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.functions.calendar import period
from lakestar.operators.colocated import Staged, attach_colocated
from lakestar.operators.dimensions import stamped
from lakestar.operators.lookup import SALT, Limits, Lookup, Size, attach, measure, refuse_duplicates
from lakestar.sources.buckets import Buckets
from lakestar.sources.tables import gathered_by_month
from lakestar.specs import FACT_LOOKUPS, FACT_MEASURES, FACT_SCHEMA, PERIOD, ROW_PLACE, Dimension


def fact_lookups(
    dimensions: dict[str, DataFrame], by: Sequence[Dimension] = FACT_LOOKUPS
) -> list[Lookup]:
    return [Lookup(d.name, dimensions[d.name], (d.lookup,), d.sk) for d in by]


def keyed_rows(
    rows: DataFrame,
    dimensions: dict[str, DataFrame],
    *,
    by: Sequence[Dimension] = FACT_LOOKUPS,
    how: str = "inner",
    stamp: dt.datetime | None = None,
    on_duplicate: str = "fail",
    limits: Limits = Limits(),
    sizes: dict[str, Size] | None = None,
) -> DataFrame:
    """Silver rows as rows of the fact; ``how='left'`` keeps those that lack a key, which is null.

    If every lookup can be broadcast, rows stay where they were read, month by month.
    Otherwise a lookup has shuffled them and they are gathered again for the write. ``sizes`` are
    those of the lookups, where they are known.
    """
    place = [ROW_PLACE] if ROW_PLACE in rows.columns else []
    lookups = fact_lookups(dimensions, by)
    sizes = measure(lookups) if sizes is None else sizes
    in_place = len(limits.small(lookups, sizes)) == len(lookups)
    # year and month follow from the date: they need not go through shuffles with it
    needed = ["sale_date", *[d.lookup for d in by], *FACT_MEASURES, *(PERIOD if in_place else ()), *place]
    keyed = attach(
        rows.select(*needed), lookups, how, on_duplicate=on_duplicate, limits=limits, sizes=sizes
    )
    if not in_place:
        keyed = gathered_by_month(keyed, "sale_date").withColumns(period(F.col("sale_date")))
    return stamped(keyed, stamp).select(*FACT_SCHEMA.names)


def lacks(by: Sequence[Dimension] = FACT_LOOKUPS) -> dict[str, Column]:
    """For each dimension, whether a row kept by ``keyed_rows(how='left')`` finds no key in it."""
    return {d.name: F.isnull(d.sk) for d in by}


def build_fact(
    rows: DataFrame,
    dimensions: dict[str, DataFrame],
    *,
    by: Sequence[Dimension] = FACT_LOOKUPS,
    stamp: dt.datetime | None = None,
    on_duplicate: str = "fail",
    limits: Limits = Limits(),
) -> DataFrame:
    """Silver rows with the keys of their five dimensions. A row that lacks one is left out."""
    return keyed_rows(rows, dimensions, by=by, stamp=stamp, on_duplicate=on_duplicate, limits=limits)


def build_fact_colocated(
    staged: Staged,
    lookup: Lookup,
    dimensions: dict[str, DataFrame],
    buckets: Buckets,
    *,
    by: Sequence[Dimension] = FACT_LOOKUPS,
    stamp: dt.datetime | None = None,
    limits: Limits = Limits(),
) -> DataFrame:
    """As ``build_fact``, for rows staged in buckets of one large lookup (usually customers).

    The other lookups are broadcast, so rows stay in their buckets up to the join with the large one,
    for which only its members are dealt out.
    """
    lookups = fact_lookups(dimensions, by)
    refuse_duplicates(sizes := measure(lookups))
    others = [l for l in lookups if l.name != lookup.name]
    columns = ["sale_date", *[d.lookup for d in by], *FACT_MEASURES, *PERIOD, SALT]
    keyed = attach(staged.rows.select(*columns), others, limits=limits, sizes=sizes)
    return stamped(attach_colocated(staged, keyed, lookup, buckets), stamp).select(*FACT_SCHEMA.names)


def rejects(
    rows: DataFrame,
    dimensions: dict[str, DataFrame],
    *,
    by: Sequence[Dimension] = FACT_LOOKUPS,
    limits: Limits = Limits(),
) -> DataFrame:
    """For each dimension, how many rows find no key in it.

    Rows with equal lookup values are counted together before any join, by one dimension at a time: few
    values go through the shuffle, while nearly every sale differs from others in some dimension.
    """
    lookups = fact_lookups(dimensions, by)
    sizes = measure(lookups)
    refuse_duplicates(sizes)

    def lost(d: Dimension, lookup: Lookup) -> DataFrame:
        alike = rows.groupBy(d.lookup).agg(F.count("*").alias("n"))
        keyed = attach(alike, [lookup], "left", on_duplicate="fail", limits=limits, sizes=sizes)
        n = F.coalesce(F.sum(F.when(F.isnull(d.sk), F.col("n"))), F.lit(0))
        return keyed.agg(F.lit(d.name).alias("dimension"), n.alias("rows_lost"))

    return reduce(DataFrame.unionByName, [lost(d, l) for d, l in zip(by, lookups)])
