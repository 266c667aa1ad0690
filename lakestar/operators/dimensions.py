"""Dimensions: members, surrogate keys, replacement and upsert."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.operators.keys import number, ranked, with_dense_keys
from lakestar.operators.lookup import Limits, Lookup, attach
from lakestar.session import staged
from lakestar.specs import DERIVED_FROM, DIMENSIONS, STAMP, Dimension


def members(rows: DataFrame, spec: Dimension) -> DataFrame:
    """The distinct members among the rows. Repeats collapse before the shuffle."""
    return rows.select(*spec.columns).dropDuplicates()


def latest_members(rows: DataFrame, spec: Dimension) -> DataFrame:
    """One member per key: the version sold last, the greatest one on a tie.

    Versions are reduced to one row each, with a hash aggregate, before the few that share a
    key are compared.
    """
    rest = [c for c in spec.columns if c not in spec.key]
    if not rest:
        return members(rows, spec)
    versions = rows.groupBy(*spec.columns).agg(F.max("sale_date").alias("last_sold"))
    newest = F.max(F.struct("last_sold", *rest)).alias("newest")
    return (
        versions.groupBy(*spec.key)
        .agg(newest)
        .select(*[F.col(c) if c in spec.key else F.col(f"newest.{c}") for c in spec.columns])
    )


def stamped(rows: DataFrame, stamp: dt.datetime | None) -> DataFrame:
    """Add the time of the run: one value for all its tables, null if not wanted."""
    return rows.withColumn(STAMP, F.lit(stamp).cast("timestamp"))


def with_parent_key(
    rows: DataFrame,
    spec: Dimension,
    parent_table: DataFrame,
    *,
    null_safe: bool = True,
    limits: Limits = Limits(),
) -> DataFrame:
    """Swap the parent's columns for its surrogate key; rows without a parent stay, key null.

    Null-safe by default: a null district is a value like others. Otherwise one null among
    the parent's columns leaves the key null.
    """
    lookup = Lookup(spec.parent.name, parent_table, spec.parent.columns, spec.parent.sk, null_safe)
    return attach(rows, [lookup], "left", limits=limits).drop(*spec.parent.columns)


def concurrently(spark: SparkSession, tasks: Sequence[Callable[[], object]]) -> list:
    """Run independent Spark jobs side by side, so that one's last tasks do not idle the rest."""
    in_session = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        return [f.result() for f in [pool.submit(in_session(t)) for t in tasks]]


def build_dimension(rows: DataFrame, spec: Dimension) -> DataFrame:
    """Members with dense keys from 1 in natural order, for a dimension without parent."""
    return number(members(rows, spec), spec.columns, spec.sk)


def staged_versions(rows: DataFrame, spec: Dimension) -> DataFrame:
    """Members with the date each was last sold, staged."""
    found = rows.groupBy(*spec.columns).agg(F.max("sale_date").alias("sale_date"))
    return staged(found, spec.name)


def _roots_of(specs: Sequence[Dimension]) -> list[Dimension]:
    return list(dict.fromkeys(DERIVED_FROM.get(d, d) for d in specs))


def build_dimensions(
    rows: DataFrame,
    specs: Sequence[Dimension] = DIMENSIONS,
    *,
    versions: str = "all",
    null_safe: bool = True,
    limits: Limits = Limits(),
) -> dict[str, DataFrame]:
    """Dimensions by name, each with dense keys from 1 in natural order.

    The rows are read once for each of at most four root dimensions, side by side and with
    its columns only; the others come from those members. ``versions='all'`` keeps every
    distinct member, ``'latest'`` one per key.
    """
    wanted = list(dict.fromkeys([*specs, *[d.parent for d in specs if d.parent]]))

    def from_root(root: Dimension) -> dict[Dimension, DataFrame]:
        if versions == "all":
            every = own = ranked(members(rows, root), root.columns, root.name)
        else:  # derived dimensions keep what only older versions refer to
            every = staged_versions(rows, root)
            own = ranked(latest_members(every, root), root.columns, root.name)
        found = {root: with_dense_keys(own, root.sk)}
        for spec in wanted:
            if DERIVED_FROM.get(spec) == root:
                found[spec] = build_dimension(every, spec)
        return found

    tasks = [lambda root=root: from_root(root) for root in _roots_of(wanted)]
    tables: dict[Dimension, DataFrame] = {}
    for found in concurrently(rows.sparkSession, tasks):
        tables |= found
    for spec in specs:
        if spec.parent:
            parent = tables[spec.parent]
            keyed = with_parent_key(tables[spec], spec, parent, null_safe=null_safe, limits=limits)
            tables[spec] = keyed.select(*spec.attributes, spec.sk)
    return {d.name: tables[d] for d in specs}


def incoming_members(rows: DataFrame) -> dict[Dimension, DataFrame]:
    """One row per key for every dimension, read from four staged sets of members."""
    roots = _roots_of(DIMENSIONS)
    tasks = [lambda d=d: staged_versions(rows, d) for d in roots]
    staged_by = dict(zip(roots, concurrently(rows.sparkSession, tasks)))
    return {d: latest_members(staged_by[DERIVED_FROM.get(d, d)], d) for d in DIMENSIONS}


@dataclass(frozen=True)
class Upsert:
    """What a batch does to a dimension: members to add, and members to rewrite in place."""

    spec: Dimension
    existing: DataFrame
    matched: DataFrame
    stamp: dt.datetime | None

    def counts(self) -> tuple[int, int]:
        """How many members are new, and how many known ones change."""
        new, changed = F.count_if(F.isnull(self.spec.sk)), F.count_if(F.col("differs"))
        return tuple(self.matched.agg(new, changed).first())

    def added(self) -> DataFrame:
        """The new members, keys after the highest one, in natural order."""
        start = self.existing.agg(F.max(self.spec.sk)).first()[0] or 0
        fresh = self.matched.filter(F.isnull(self.spec.sk)).select(*self.spec.attributes)
        return stamped(number(fresh, self.spec.attributes, self.spec.sk, start), self.stamp)

    def snapshot(self) -> DataFrame:
        """The whole dimension after the batch."""
        changed = self.matched.filter("differs").drop("differs")
        replaced = changed.select(F.col(self.spec.sk).alias("__sk"))
        same = F.col(self.spec.sk) == F.col("__sk")
        unchanged = self.existing.join(replaced, same, "left_anti")
        return unchanged.unionByName(stamped(changed, self.stamp)).unionByName(self.added())


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    spec: Dimension,
    *,
    on_change: str = "update",
    stamp: dt.datetime | None = None,
) -> Upsert:
    """Keep known members and their keys; new members get the next keys, in natural order.

    ``incoming`` has one row per key. A known member whose attributes differ takes the new
    ones under its old key (``on_change='update'``) or stays (``'keep'``). The existing
    members are read once, for one join whose result, as long as ``incoming``, is staged.
    Keys are unique on both sides, so it has no hot key.
    """
    rest = [c for c in spec.attributes if c not in spec.key]
    known = existing.select(*[F.col(c).alias(f"__{c}") for c in spec.attributes], spec.sk)
    same_key = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in spec.key]
    differs = F.lit(False)
    if on_change == "update":
        for c in rest:
            differs = differs | ~F.col(c).eqNullSafe(F.col(f"__{c}"))
    matched = (
        incoming.select(*spec.attributes)
        .join(known, reduce(Column.__and__, same_key), "left")
        .select(*spec.attributes, spec.sk, (F.isnotnull(spec.sk) & differs).alias("differs"))
    )
    existing = existing.select(*spec.attributes, spec.sk, STAMP)
    return Upsert(spec, existing, staged(matched, f"{spec.name}-upsert"), stamp)
