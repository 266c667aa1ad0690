"""Dimension-sharded clustering against plain Lloyd rounds in Python integers."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from lakestar.llm import centroids

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, dims, k, rounds, scale=256, salt="2"):
    """Sorted (vec_id, cluster, distance, cluster inertia, inertia, hash) by loops over Python integers."""
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, [math.floor(scale * float(np.float32(x))) for x in v]))
    named = sorted((hashlib.sha256(f"{salt}:{'' if i is None else i}".encode()).hexdigest(), x) for i, x in kept)
    own = [x for _, x in named[:k]]
    far = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c))
    near = lambda x: min((far(x, c), i) for i, c in enumerate(own))
    for _ in range(rounds):
        members = [[] for _ in own]
        for _, x in kept:
            members[near(x)[1]].append(x)
        own = [[sum(col) // len(m) for col in zip(*m)] if m else c for m, c in zip(members, own)]
    found = [(i, *near(x)) for i, x in kept]
    total = {c: sum(d for _, d, e in found if e == c) for _, _, c in found}
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in own]
    return sorted(((i, c, d, total[c], sum(total.values()), hashes[c]) for i, d, c in found), key=repr)


def got(df, **asked):
    return sorted(map(tuple, centroids.cluster(df, **asked).collect()), key=repr)


def vectors(n, dims, seed=7):
    rng = random.Random(seed)
    hubs = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(6)]
    return [(i, [x + rng.gauss(0, 0.2) for x in rng.choice(hubs)]) for i in range(n)]


@pytest.mark.parametrize(("dims", "k"), [(20, 5), (16, 9), (3, 4)])
def test_equals_plain_rounds(spark, dims, k):
    rows = vectors(200, dims)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(df, dims=dims, k=k, rounds=3) == brute(rows, dims, k, 3)


def test_a_third_of_all_vectors_is_one_vector(spark, monkeypatch):
    rows = vectors(120, 4) + [(1000 + i, [0.5, -0.25, 0.125, 1.0]) for i in range(60)]
    monkeypatch.setattr(centroids, "CELLS", 40)  # slabs of ten rows, so the copies are in many of them
    assert got(spark.createDataFrame(rows, SCHEMA), dims=4, k=4, rounds=4) == brute(rows, 4, 4, 4)


def test_broken_vectors_are_left_out_and_null_or_repeated_ids_stay(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [0.5, 0.5]), (None, [0.25, -3.0]), (2, None), (3, []), (4, [1.0]),
        (5, [1.0, None]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [-inf, 1.0]), (9, [1.0, 2.0, 3.0]), (10, [-0.001, 0.0]),
    ]
    for k in (3, 40):  # 40: more than there are vectors
        result = got(spark.createDataFrame(rows, SCHEMA), dims=2, k=k, rounds=2)
        assert result == brute(rows, 2, k, 2) and len(result) == 5


def test_ties_go_to_the_smaller_number_and_empty_clusters_stay(spark):
    rows = [(i, [1.0, 1.0]) for i in range(10)]  # all first centroids are equal
    result = got(spark.createDataFrame(rows, SCHEMA), dims=2, k=4, rounds=2)
    assert {r[1] for r in result} == {0} and {r[2] for r in result} == {0}


def test_far_components_are_held(spark):
    rows = [(1, [3e38, 0.0]), (2, [-3e38, 0.0]), (3, [0.0, 0.0])]
    result = got(spark.createDataFrame(rows, SCHEMA), dims=2, k=2, rounds=1)
    assert len(result) == 3 and all(0 <= r[2] <= centroids.LONGEST for r in result)


def test_empty_tables_and_clashing_names(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert got(empty, dims=2) == [] and "centroid_sha256" in centroids.cluster(empty, dims=2).columns
    odd = spark.createDataFrame([(1, [1.0], "x", 5), (2, [2.0], "y", 6)], "`distance` long, `a.b` array<double>, slab string, ids int")
    result = centroids.cluster(odd, "a.b", "distance", dims=1, k=1, rounds=1)
    assert result.columns[0] == "distance_input" and sorted(r[2] for r in result.collect()) == [128**2, 128**2]


def test_the_column_blocks_are_dealt_once(spark):
    """What a round joins has the shards' partitioning already: one shuffle for the blocks, one for assignments."""
    rows = spark.createDataFrame(vectors(50, 32), SCHEMA).selectExpr("vec_id as id", "cast(embedding as array<double>) as v")
    shards = centroids._sharded(centroids.written(centroids._slabs(rows, 32, 256, 10), "slabs"), 32, 4)
    dealt = shards.mapValues(len).partitionBy(4)
    both = shards.cogroup(dealt, 4)
    assert shards.partitioner == dealt.partitioner == both.partitioner
    assert both.toDebugString().decode().count("ShuffledRDD") == shards.toDebugString().decode().count("ShuffledRDD") * 2
