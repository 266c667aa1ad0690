"""Lookups in tables too large to broadcast, without a shuffle of the rows at each load.

Rows are staged once in buckets of the lookup's key; members are dealt out alike. A hot key has
salts in both tables, so its rows lie in many buckets and no task gets them all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.operators.lookup import (
    MEMBER_SALT,
    SALT,
    Limits,
    Lookup,
    hot_keys,
    row_identity,
    salted_facts,
    salted_members,
)
from lakestar.sources.buckets import Buckets


@dataclass(frozen=True)
class Staged:
    """Rows in buckets of a key and its salts, and the salts of the hot keys."""

    rows: DataFrame
    hot: DataFrame


def stage_rows(rows: DataFrame, lookup: Lookup, buckets: Buckets, limits: Limits = Limits()) -> Staged:
    """Deal the rows out by the lookup's key for as many loads as there will be.

    Rows should bring their place in their files (``sources.tables.with_place``), as equal rows of a
    hot key share a salt otherwise.
    """
    hot = hot_keys(rows, [lookup], limits)
    salted = salted_facts(row_identity(rows), lookup, hot)
    return Staged(buckets.write(salted, f"{lookup.name}_rows", (*lookup.on, SALT)), hot)


def attach_colocated(staged: Staged, rows: DataFrame, lookup: Lookup, buckets: Buckets, how: str = "inner") -> DataFrame:
    """Add the lookup's key to ``rows``, which are the staged ones with columns added, in their buckets.

    Only the members are shuffled, to lie like the rows. Repeated keys must be excluded before.
    """
    members = salted_members(lookup, staged.hot)
    dealt = buckets.write(members, f"{lookup.name}_members", (*lookup.others, MEMBER_SALT))
    condition = lookup.matches() & (F.col(SALT) == F.col(MEMBER_SALT))
    columns = [c for c in rows.columns if c != SALT]
    return rows.join(dealt, condition, how).select(*columns, lookup.take)
