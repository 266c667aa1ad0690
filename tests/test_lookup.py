"""Lookups: broadcast and salted joins give the same rows; hot keys are split; duplicates stop."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from settings import settings

from lakestar.operators.lookup import (
    DuplicateLookupKey,
    Limits,
    Lookup,
    Size,
    attach,
    hot_keys,
    row_identity,
    measure,
)

NEVER = Limits(broadcast_bytes=-1, rows_per_task=500)
PLAIN = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows has one key, a tenth has none."""
    rng = random.Random(3)

    def key():
        draw = rng.random()
        return "hot" if draw < 1 / 3 else None if draw < 0.43 else f"k{rng.randint(0, 300)}"

    rows = [(i, key(), rng.choice("xyz")) for i in range(20_000)]
    return spark.createDataFrame(rows, "id long, a string, b string").repartition(8)


@pytest.fixture(scope="module")
def table(spark):
    keys = ["hot", None, *[f"k{i}" for i in range(0, 300, 2)]]
    rows = [(k, b, i * 3 + j) for i, k in enumerate(keys) for j, b in enumerate("xyz")]
    return spark.createDataFrame(rows, "a string, b string, sk long")


def brute(facts, table, how, null_safe):
    found = {(r.a, r.b): r.sk for r in table.collect()}
    result = []
    for r in facts.collect():
        sk = found.get((r.a, r.b)) if null_safe or r.a is not None else None
        if how == "left" or sk is not None:
            result.append((r.id, r.a, r.b, sk))
    return sorted(result, key=repr)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("null_safe", [True, False])
@pytest.mark.parametrize("limits", [Limits(), NEVER], ids=["broadcast", "salted"])
def test_rows_are_those_of_the_plain_join(facts, table, how, null_safe, limits):
    lookup = Lookup("t", table, ("a", "b"), "sk", null_safe)
    got = attach(facts, [lookup], how, limits=limits)
    assert got.columns == ["id", "a", "b", "sk"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(facts, table, how, null_safe)


def test_large_tables_are_not_broadcast(spark, facts, table):
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        joined = attach(facts, [Lookup("t", table, ("a", "b"), "sk")], limits=Limits(broadcast_bytes=-1))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
        joined = attach(facts, [Lookup("t", table, ("a", "b"), "sk")])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_tables_that_fit_one_by_one_but_not_together(facts, table):
    lookups = [Lookup(n, table.select("a", "b", F.col("sk").alias(n)), ("a", "b"), n) for n in ("s1", "s2", "s3")]
    sizes = measure(lookups)
    one = sizes["s1"].bytes
    limits = Limits(broadcast_bytes=2 * one + one // 2)
    assert len(limits.small(lookups, sizes)) == 2
    assert [len(Limits(broadcast_bytes=k * one).small(lookups, sizes)) for k in (0, 1, 3)] == [0, 1, 3]
    got = attach(facts, lookups, limits=limits).collect()
    assert got and all(r.s1 == r.s2 == r.s3 for r in got)


def test_every_key_with_more_rows_than_a_task_takes_is_split(spark):
    """300 keys of equal size, and one with a third of the rows."""
    third = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 300)
    facts = spark.range(90_000).select(third.alias("a"))
    lookup = Lookup("t", facts, ("a",), "a")
    found = {r.fingerprint: r.salts for r in hot_keys(facts, [lookup], Limits(rows_per_task=250)).collect()}
    assert len(found) == 201 and sorted(found.values())[-2:] == [2, 120]
    assert hot_keys(facts, [lookup], Limits(rows_per_task=40_000)).isEmpty()


def tasks_of(joined):
    return joined.groupBy(F.spark_partition_id()).count().count()


def test_a_hot_key_reaches_many_tasks(spark, facts, table):
    with settings(spark, PLAIN):
        joined = attach(facts, [Lookup("t", table, ("a", "b"), "sk")], limits=NEVER)
        assert tasks_of(joined.filter(F.col("a") == "hot")) > 4


def test_equal_rows_of_a_hot_key_reach_many_tasks(spark, tmp_path):
    """Rows of files are told apart by their place, though their values are the same."""
    spark.range(20_000).select(F.lit("hot").alias("a")).repartition(4).write.parquet(str(tmp_path / "t"))
    facts = spark.read.parquet(str(tmp_path / "t"))
    table = spark.createDataFrame([("hot", 1), ("cold", 2)], "a string, sk long")
    with settings(spark, PLAIN):
        joined = attach(facts.filter("a is not null").select("a"), [Lookup("t", table, ("a",), "sk")], limits=NEVER)
        assert tasks_of(joined) == 8 and joined.count() == 20_000
    place = [r["__row"] for r in row_identity(facts).collect()]
    assert len(set(place)) == 20_000 and set(place) == {r["__row"] for r in row_identity(facts).collect()}


def test_duplicates_stop_or_fan_out(spark, facts):
    table = spark.createDataFrame([("hot", 1), ("hot", 2), (None, 3), (None, 4)], "a string, sk long")
    lookup = Lookup("t", table, ("a",), "sk")
    assert measure([lookup])["t"] == Size(rows=2, keys=1, bytes=2 * (2 * 3 + 160))
    with pytest.raises(DuplicateLookupKey, match="'t': 1"):
        attach(facts, [lookup])
    hot = facts.filter(F.col("a") == "hot").count()
    for limits in (Limits(), NEVER):
        assert attach(facts, [lookup], on_duplicate="fan_out", limits=limits).count() == 2 * hot


def test_several_large_lookups_chain(facts, table):
    one = Lookup("one", table.filter("b = 'x'").select("a", F.col("sk").alias("s1")), ("a",), "s1")
    two = Lookup("two", table.filter("b = 'y'").select("a", F.col("sk").alias("s2")), ("a",), "s2")
    want = attach(facts, [one, two]).collect()
    got = attach(facts, [one, two], limits=NEVER).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and got


def test_a_table_made_from_the_rows_themselves(facts):
    """Both sides share their origin; the condition still compares one with the other."""
    table = facts.groupBy("a").agg(F.max("id").alias("last"))
    want = {r.a: r["last"] for r in table.collect() if r.a is not None}
    for limits in (Limits(), NEVER):
        got = attach(facts, [Lookup("t", table, ("a",), "last")], limits=limits).collect()
        assert all(r["last"] == want[r.a] for r in got)
        assert len(got) == facts.filter("a is not null").count()
