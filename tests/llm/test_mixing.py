from __future__ import annotations

import edges
import pytest
from pyspark.sql import functions as F

from lakestar.llm import mixing
from lakestar.llm.common import word_count

SCHEMA = "doc_id long, size long, source string"


def level(sizes: dict, most: int = 3) -> dict:
    """Targets by trying again and again until no source is above."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    stopped: set = set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in stopped)
        share = sum(weight[s] for s in order if s not in stopped)
        target = {s: most * sizes[s] if s in stopped else left * weight[s] / share for s in order}
        above = {s for s in order if s not in stopped and target[s] >= most * sizes[s]}
        if not above:
            return target
        stopped |= above


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 1, "b": 2, "c": 3, "d": 10_000},
        {"a": 7, None: 50, "é": 1, "z": 900, "Z": 2},
        {"only": 5},
        {"a": 0, "b": 9, "c": 0},
    ],
)
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    want = level(sizes)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) < 1e-9 * max(1, want[s]) for s in want)
    assert abs(sum(got.values()) - sum(sizes.values())) < 1e-6


def corpus(spark, n=3000):
    size = (F.pmod(F.xxhash64("id"), F.lit(37)) ** 2 + 1).cast("long")
    source = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 11).cast("string")))
    return spark.range(n).select(F.col("id").alias("doc_id"), size.alias("size"), source.alias("source"))


def test_words_taken(spark):
    docs = corpus(spark)
    got = mixing.mix(docs, seed=5).withColumn("taken", F.col("size") * F.col("copies")).toPandas()
    assert got["copies"].between(0, 3).all() and len(got) == 3000
    by = got.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert ((by["taken"] - by["target"]).abs() <= 0.002 * by["target"] + 2).all()
    again = mixing.mix(docs.repartition(13), seed=5).toPandas()
    same = ["doc_id", "copies"]
    assert sorted(map(tuple, got[same].values)) == sorted(map(tuple, again[same].values))
    other = mixing.mix(docs, seed=6).toPandas()
    assert sorted(map(tuple, got[same].values)) != sorted(map(tuple, other[same].values))


def test_longer_documents_are_likelier_within_a_source(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, 3).otherwise(1000).cast("long").alias("size"),
        F.when(F.col("id") < 2000, "a").otherwise("b").alias("source"),
    )
    got = mixing.mix(docs).toPandas()
    a = got[got["source"] == "a"]
    assert a[a["size"] == 1000]["copies"].mean() > 2 * a[a["size"] == 3]["copies"].mean() > 0


def test_copies_follow_the_odds(spark):
    rows = [("s", odds, words, 900.0) for odds, words in ((1, 100), (2, 300), (9, 200))]
    levels = spark.createDataFrame(rows, "source string, odds int, words long, target double")
    got = {r["odds"]: r["copies"] for r in mixing.expected_copies(levels).collect()}
    assert got[9] == 3.0 and abs(got[2] - 2 * got[1]) < 1e-12
    assert abs(sum(got[o] * w for _, o, w, _ in rows) - 900) < 1e-9


def test_edges(spark):
    docs = edges.clashing(edges.documents(spark), keep=("size",)).withColumn("size", word_count(F.col("text")))
    got = mixing.mix(docs)
    rows = got.collect()
    assert len(rows) == len(edges.rows()) and all(0 <= r["copies"] <= 3 for r in rows)
    assert {"target_input", "copies_input", "row_no_input"} <= set(got.columns)
    none = mixing.mix(spark.createDataFrame([], SCHEMA))
    assert none.count() == 0 and none.columns[-3:] == ["source_size", "target", "copies"]


def test_ties_and_no_words(spark):
    same = [(1, 5, "a")] * 40 + [(2, 0, "a")] * 3 + [(None, 7, None)] * 20 + [(3, 0, "empty")] * 2
    got = mixing.mix(spark.createDataFrame(same, SCHEMA)).toPandas()
    assert len(got) == 65
    by = got.assign(taken=got["size"] * got["copies"]).groupby("source", dropna=False).agg(taken=("taken", "sum"), target=("target", "first"))
    assert ((by["taken"] - by["target"]).abs() <= 3.5).all()
