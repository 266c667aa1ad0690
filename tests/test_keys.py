"""Surrogate keys: dense, in natural order, the same for any partitioning."""

from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F
from settings import settings

from lakestar.operators.keys import number, ranked, with_dense_keys


def natural(row):
    return tuple((v is not None, v if v is not None else "") for v in row)


@pytest.mark.parametrize(
    "partitions, adaptive", list(itertools.product(["1", "7", "64"], ["true", "false"]))
)
def test_keys_do_not_depend_on_partitions(spark, partitions, adaptive):
    members = [(f"n{i % 37:02d}", None if i % 11 == 0 else f"m{i}") for i in range(3000)]
    members = list(dict.fromkeys(members))
    changed = {"spark.sql.shuffle.partitions": partitions, "spark.sql.adaptive.enabled": adaptive}
    with settings(spark, changed):
        rows = spark.createDataFrame(members, "a string, b string").repartition(13)
        got = {(r.a, r.b): r.key for r in number(rows, ["a", "b"], "key", 100).collect()}
    assert got == {m: 101 + i for i, m in enumerate(sorted(members, key=natural))}


def test_no_members(spark):
    rows = spark.createDataFrame([], "a string")
    assert number(rows, ["a"], "key").collect() == []


def test_numbering_uses_more_than_one_task(spark):
    rows = spark.range(400_000).select(F.col("id").alias("a"), F.sha2(F.hex("id"), 256).alias("b"))
    with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m"}):
        sorted_rows = ranked(rows, ["a", "b"])
        slices = sorted_rows.groupBy(F.shiftright("__position", 33)).count().collect()
        keyed = with_dense_keys(sorted_rows, "key")
        assert keyed.filter(F.col("key") != F.col("a") + 1).isEmpty()
    assert len(slices) > 1 and max(r["count"] for r in slices) < 400_000
