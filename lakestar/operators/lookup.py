"""Look up dimension keys: broadcast what is measured to be small, salt hot keys of the rest."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.session import staged
from lakestar.specs import ROW_PLACE

SALT, MEMBER_SALT = "__salt", "__right__salt"


class DuplicateLookupKey(ValueError):
    """A lookup column names more than one member, which would repeat rows."""


@dataclass(frozen=True)
class Lookup:
    """Fetch ``take`` from ``table`` by the columns ``on``, which have the same name on both sides."""

    name: str
    table: DataFrame
    on: tuple[str, ...]
    take: str
    null_safe: bool = False

    def _other(self, column: str) -> str:
        return f"__{self.name}_{column}"

    @property
    def others(self) -> list[str]:
        """The key columns as the right side of a join names them."""
        return [self._other(c) for c in self.on]

    @property
    def right(self) -> DataFrame:
        """The table as the right side of a join, its key columns under names of their own."""
        return self.table.select(*[F.col(c).alias(self._other(c)) for c in self.on], self.take)

    def matches(self) -> Column:
        """The condition that joins rows, by the key's names, to :attr:`right`."""
        pairs = [(F.col(c), F.col(o)) for c, o in zip(self.on, self.others)]
        same = [a.eqNullSafe(b) if self.null_safe else a == b for a, b in pairs]
        return reduce(Column.__and__, same)


@dataclass(frozen=True)
class Size:
    rows: int
    keys: int
    bytes: int


@dataclass(frozen=True)
class Limits:
    """When to broadcast, and how far to split hot keys otherwise.

    ``broadcast_bytes`` holds for all tables that one stage has at once. A key with more than
    ``rows_per_task`` rows is split over as many tasks as it takes.
    """

    broadcast_bytes: int = 128 << 20
    rows_per_task: int = 4_000_000

    def small(self, lookups: Sequence[Lookup], sizes: dict[str, Size]) -> list[Lookup]:
        """The lookups to broadcast: the smallest ones whose sizes add up to the limit."""
        left, kept = self.broadcast_bytes, set()
        for lookup in sorted(lookups, key=lambda l: sizes[l.name].bytes):
            left -= sizes[lookup.name].bytes
            if left < 0:
                break
            kept.add(lookup.name)
        return [l for l in lookups if l.name in kept]


#: What a row of a broadcast hash table takes besides the text of its key: two rows in Spark's format,
#: the object around them and the pointers to it.
ROW_BYTES = 160


def measure(lookups: Sequence[Lookup]) -> dict[str, Size]:
    """Rows, distinct keys and bytes of each lookup table, in one query over all of them.

    One row per lookup comes back to the driver. A key that can match nothing is not counted.
    """
    if not lookups:
        return {}
    keys = []
    for lookup in lookups:
        # as text, which any key can be, so that the tables can be counted together
        key = F.array(*[F.col(c).cast("string") for c in lookup.on]).alias("key")
        table = lookup.table if lookup.null_safe else lookup.table.dropna(subset=list(lookup.on))
        keys.append(table.select(F.lit(lookup.name).alias("name"), key))
    per_key = reduce(DataFrame.unionByName, keys).groupBy("name", "key").agg(F.count("*").alias("n"))
    text_bytes = F.aggregate(
        "key", F.lit(0), lambda sum_, k: sum_ + F.coalesce(F.octet_length(k), F.lit(0))
    )
    found = per_key.groupBy("name").agg(
        F.sum("n").alias("rows"),
        F.count("*").alias("keys"),
        # a key is there twice, once to be found and once in the row
        F.sum(F.col("n") * (2 * text_bytes + ROW_BYTES)).alias("bytes"),
    )
    sizes = {r["name"]: Size(r["rows"], r["keys"], r["bytes"]) for r in found.collect()}
    return {l.name: sizes.get(l.name, Size(0, 0, 0)) for l in lookups}


def _fingerprint(columns: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(c).cast("string") for c in columns])


def hot_keys(facts: DataFrame, lookups: Sequence[Lookup], limits: Limits) -> DataFrame:
    """``name``, ``fingerprint``, ``salts`` of every key that has more rows than a task should.

    One pass counts the keys of all lookups; counts are combined before the shuffle. There are at
    most (rows / ``rows_per_task``) such keys for each lookup. Other keys don't need salts.
    """
    each = F.array(
        *[F.struct(F.lit(l.name).alias("name"), _fingerprint(l.on).alias("fingerprint")) for l in lookups]
    )
    counts = facts.select(F.inline(each)).groupBy("name", "fingerprint").agg(F.count("*").alias("n"))
    salts = F.ceil(F.col("n") / limits.rows_per_task).cast("int")
    return staged(counts.filter(F.col("n") > limits.rows_per_task).select("name", "fingerprint", salts.alias("salts")), "hot-keys")


def row_identity(facts: DataFrame) -> DataFrame:
    """Add a number that a repeated task gives to the same row, and that equal rows don't share.

    It is the row's place in its file: the one that rows bring (``sources.tables.with_place``), or the
    scan's own where they come straight from one. Other rows, as those of a union, are told apart
    by their values only, of which the caller is warned.
    """
    if ROW_PLACE in facts.columns:
        return facts
    try:
        return facts.withColumn(ROW_PLACE, F.xxhash64("_metadata.file_path", "_metadata.row_index"))
    except AnalysisException:
        warnings.warn("equal rows of a hot key go to one task: take their place at the scan", stacklevel=2)
        return facts.withColumn(ROW_PLACE, F.xxhash64(*facts.columns))


def salted_facts(facts: DataFrame, lookup: Lookup, hot: DataFrame) -> DataFrame:
    """The rows with exactly one salt each, 0 for keys that aren't hot."""
    mine = _salts(lookup, hot)
    return (
        facts.join(mine, _fingerprint(lookup.on) == F.col("__f"), "left")
        .withColumn(SALT, F.coalesce(F.pmod(F.col(ROW_PLACE), F.col("__n")), F.lit(0)).cast("int"))
        .drop("__f", "__n")
    )


def salted_members(lookup: Lookup, hot: DataFrame) -> DataFrame:
    """The members, those of hot keys once per salt."""
    return (
        lookup.right.join(_salts(lookup, hot), _fingerprint(lookup.others) == F.col("__f"), "left")
        .withColumn(MEMBER_SALT, F.explode(F.sequence(F.lit(0), F.coalesce("__n", F.lit(1)) - 1)))
        .drop("__f", "__n")
    )


def _salts(lookup: Lookup, hot: DataFrame) -> DataFrame:
    named = hot.filter(F.col("name") == lookup.name)
    return F.broadcast(named.select(F.col("fingerprint").alias("__f"), F.col("salts").alias("__n")))


def _salted(facts: DataFrame, lookup: Lookup, how: str, hot: DataFrame) -> DataFrame:
    """A shuffled join in which the rows of a hot key go to several tasks, not to one.

    Every fact row keeps exactly one salt and the dimension rows of hot keys exist once per
    salt, so the result is that of the plain join.
    """
    left, right = salted_facts(facts, lookup, hot), salted_members(lookup, hot)
    condition = lookup.matches() & (F.col(SALT) == F.col(MEMBER_SALT))
    return left.join(right, condition, how).select(*facts.columns, lookup.take)


def refuse_duplicates(sizes: dict[str, Size]) -> None:
    bad = {n: s.rows - s.keys for n, s in sizes.items() if s.rows > s.keys}
    if bad:
        raise DuplicateLookupKey(f"surplus rows by lookup: {bad}")


def attach(
    facts: DataFrame,
    lookups: Sequence[Lookup],
    how: str = "inner",
    *,
    on_duplicate: str = "fail",
    limits: Limits = Limits(),
    sizes: dict[str, Size] | None = None,
) -> DataFrame:
    """Add the key of every lookup to the rows.

    ``how='inner'`` drops rows without a match, ``'left'`` keeps them with a null key. A key
    that names several members stops the load, unless ``on_duplicate='fan_out'`` asks for
    one row per member.
    """
    sizes = measure(lookups) if sizes is None else sizes
    if on_duplicate == "fail":
        refuse_duplicates(sizes)
    small = limits.small(lookups, sizes)
    large = [l for l in lookups if l not in small]
    if large:
        # hot keys are counted on the rows as they came, by their key columns only
        hot = hot_keys(facts, large, limits)
        split = {r["name"] for r in hot.select("name").distinct().collect()}
        facts = row_identity(facts) if split else facts
    if small:  # first: rows are narrower by the time others shuffle them
        columns = [*facts.columns, *[l.take for l in small]]
        for lookup in small:
            facts = facts.join(F.broadcast(lookup.right), lookup.matches(), how)
        facts = facts.select(*columns)
    for lookup in large:
        if lookup.name in split:
            facts = _salted(facts, lookup, how, hot)
        else:
            columns = [*facts.columns, lookup.take]
            facts = facts.join(lookup.right, lookup.matches(), how).select(*columns)
    return facts.drop(ROW_PLACE)
