from __future__ import annotations

from collections import Counter
from math import comb

import edges
import pytest
from pyspark.sql import functions as F

from lakestar.llm import sharding


def test_hypergeometric_law(spark):
    u = spark.range(40_000).select((F.shiftrightunsigned(F.xxhash64("id"), 11) / float(1 << 53)).alias("u"))
    draw = sharding.hypergeometric("60L", "25L", "12L", "u")
    seen = Counter(r[0] for r in u.select(F.expr(draw)).collect())
    chi = 0.0
    for k in range(13):
        expected = 40_000 * comb(25, k) * comb(35, 12 - k) / comb(60, 12)
        chi += (seen[k] - expected) ** 2 / expected if expected > 5 else 0
    assert chi < 35  # 12 degrees of freedom: 99.95 %


@pytest.mark.parametrize(
    ("pool", "good", "draws", "only"), [(10, 0, 5, 0), (10, 10, 5, 5), (10, 4, 0, 0), (0, 0, 0, 0), (7, 3, 7, 3)]
)
def test_hypergeometric_ends(spark, pool, good, draws, only):
    draw = sharding.hypergeometric(f"{pool}L", f"{good}L", f"{draws}L", "u")
    got = spark.createDataFrame([(0.0,), (0.5,), (0.9999999,)], "u double").select(F.expr(draw)).collect()
    assert {r[0] for r in got} == {only}


def test_margins_of_the_matrix(spark):
    sizes = {11: 5, 12: 1, 900: 17, 1 << 40: 3, 77: 40}
    blocks = spark.createDataFrame(list(sizes.items()), "block long, n long")
    got = {r["block"]: r["counts"] for r in sharding.communication_matrix(blocks, 4, seed=3).collect()}
    assert {b: sum(c) for b, c in got.items()} == sizes
    assert [sum(c[j] for c in got.values()) for j in range(4)] == [17, 17, 16, 16]


def test_blocks_are_numbered_without_a_task_that_sees_all(spark, monkeypatch):
    """Only windows over a row per slice or over one block or shard are in the plans."""
    plans, real = [], sharding.written

    def noting(df, label):
        plans.append(df._jdf.queryExecution().toString())
        return real(df, label)

    monkeypatch.setattr(sharding, "written", noting)
    blocks = spark.range(3000).select(F.col("id").alias("block"), F.lit(5).cast("long").alias("n"))
    got = sharding.communication_matrix(blocks, 3, seed=1).collect()
    assert len(got) == 3000 and all(sum(r["counts"]) == 5 for r in got)
    assert not any("row_number" in plan for plan in plans)


def test_sizes_slots_and_rows(spark):
    df = spark.range(5000).repartition(9).withColumn("x", F.col("id") * 2)
    got = sharding.shuffle_to_shards(df, 7, seed=1, block_rows=64).collect()
    assert sorted(r["id"] for r in got) == list(range(5000)) and all(r["x"] == 2 * r["id"] for r in got)
    for shard in range(7):
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots))) and len(slots) in (714, 715)


def test_every_row_is_as_likely_everywhere(spark):
    """Rows of one block over shards and over first halves of shards."""
    df = spark.range(64).coalesce(1)
    shard, half = Counter(), Counter()
    for seed in range(12):
        for r in sharding.shuffle_to_shards(df, 4, seed=seed, block_rows=16).collect():
            shard[r["id"] < 16, r["shard"]] += 1
            half[r["id"] < 16, r["slot"] < 8] += 1
    assert all(25 < shard[True, j] < 75 for j in range(4))  # 48 expected, deviation 4.5
    assert 70 < half[True, True] < 122  # 96 expected


def test_edges(spark):
    got = sharding.shuffle_to_shards(edges.clashing(edges.documents(spark)), 3)
    rows = got.collect()
    assert len(rows) == len(edges.rows()) and sorted({r["shard"] for r in rows}) == [0, 1, 2]
    assert {"shard_input", "slot_input", "row_no_input"} <= set(got.columns) and "row_no" not in got.columns
    none = sharding.shuffle_to_shards(edges.empty(spark), 3)
    assert none.columns[-2:] == ["shard", "slot"] and none.count() == 0
    with pytest.raises(ValueError):
        sharding.shuffle_to_shards(got, 0)


def test_more_shards_than_rows(spark):
    got = sharding.shuffle_to_shards(spark.range(3), 8).collect()
    assert sorted((r["shard"], r["slot"]) for r in got) == [(0, 0), (1, 0), (2, 0)]
