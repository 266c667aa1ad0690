"""Dense surrogate keys 1, 2, 3, ... in the order of the natural key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestar.session import staged

_POSITION = "__position"
_SLICE = "__slice"


def ranked(members: DataFrame, order: Sequence[str], label: str = "ranked") -> DataFrame:
    """Stage distinct members, sorted over all tasks, each with its place in its slice.

    Slices are key ranges, so no task holds more than its range. The result is written: the
    places and the slice sizes counted from them must come from the same slices, also when
    an executor is lost in between.
    """
    in_ranges = members.repartitionByRange(*order).sortWithinPartitions(*order)
    # the id is the slice number in the high bits and the place within it in the low 33
    return staged(in_ranges.withColumn(_POSITION, F.monotonically_increasing_id()), label)


def with_dense_keys(ranked_members: DataFrame, key: str, start: int = 0) -> DataFrame:
    """Turn the places of :func:`ranked` into ``start + 1``, ``start + 2``, ..."""
    slice_of = F.shiftright(_POSITION, 33)
    place = F.col(_POSITION).bitwiseAND(F.lit((1 << 33) - 1))
    # one row per slice, at most spark.sql.shuffle.partitions of them: small enough for
    # a window without partitions and for a broadcast, however many members there are
    earlier = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranked_members.groupBy(slice_of.alias(_SLICE))
        .agg(F.count("*").alias("size"))
        .select(_SLICE, F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"))
    )
    return (
        ranked_members.withColumn(_SLICE, slice_of)
        .join(F.broadcast(offsets), _SLICE)
        .withColumn(key, F.col("offset") + place + F.lit(start + 1))
        .drop(_SLICE, _POSITION, "offset")
    )


def number(members: DataFrame, order: Sequence[str], key: str, start: int = 0) -> DataFrame:
    """Give distinct members dense keys after ``start``, ordered by ``order``, nulls first."""
    return with_dense_keys(ranked(members, order, key), key, start)
