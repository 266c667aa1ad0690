"""Ranked search against scores worked out one document at a time."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import edges
import numpy as np
import pyarrow as pa
import pytest

from lakestar.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, queries, k):
    """Sorted (query id, rank, document id, score); documents of one id and score are alike."""
    bags = [(i, Counter(split(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    total, df = sum(sum(b.values()) for _, b in bags), Counter(t for _, b in bags for t in b)
    weight = {t: math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for q, text in queries:
        scored = []
        for i, b in bags:
            m = 10 + 90 * sum(b.values()) * len(bags) // total
            s = sum(weight[t] * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t in set(split(text)) if t in b)
            scored.append((-s, i is None, i or 0, i))
        best = sorted(s for s in scored if s[0] < 0)[:k]
        out += [(q, rank, i, -s) for rank, (s, _, _, i) in enumerate(best, 1)]
    return sorted(out, key=repr)


def got(spark, docs, queries, k=10, parts=4, **more):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    q = spark.createDataFrame(queries, "item_id long, text string")
    return sorted(map(tuple, ranked.search(d, q, k, **more).collect()), key=repr)


def corpus(n, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    text = lambda size: " ".join(rng.choices(words, weights, k=size))
    docs = [(i, text(rng.choice([1, 5, 20, 80, 300]))) for i in range(n)]
    return docs, [(j, text(rng.choice([1, 6, 12, 30]))) for j in range(25)]


@pytest.mark.parametrize("k", [1, 10])
def test_equals_scores_of_all_documents(spark, k):
    docs, queries = corpus(600)
    assert got(spark, docs, queries, k) == brute(docs, queries, k)


def test_small_buckets_and_many_blocks_of_queries_change_nothing(spark, monkeypatch):
    docs, queries = corpus(300, seed=5)
    monkeypatch.setattr(ranked, "FOCUS", 1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        assert got(spark, docs, queries, block_bytes=300) == brute(docs, queries, 10)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_copies_that_tie_are_ordered_by_id(spark):
    docs = [(i, "alpha beta gamma") for i in range(400, 100, -1)] + [(i, f"beta filler{i} more") for i in range(600)]
    queries = [(1, "alpha beta"), (2, "beta"), (3, "nowhere"), (4, None), (5, " ,. ")]
    assert got(spark, docs, queries) == brute(docs, queries, 10)


def test_rows_of_all_kinds(spark):
    docs = [(r[0], r[1]) for r in edges.rows()]
    queries = [(1, "the FOX word"), (2, "naïve 世界 word1x1"), (3, "")]
    assert got(spark, docs, queries) == brute(docs, queries, 10)


def test_empty_tables_and_clashing_names(spark):
    docs, queries = [(1, "a b")], [(1, "a")]
    assert got(spark, [], queries) == [] == got(spark, docs, [])
    rows = edges.clashing(edges.documents(spark)).withColumnRenamed("doc_id", "rank")
    own = spark.createDataFrame([("q", "fox", 1)], "score string, `a.b` string, row_no int")
    result = ranked.search(rows, own, 3, doc_id="rank", query_id="score", query_text="a.b")
    assert result.columns == ["score_", "rank", "rank_", "score"] and result.count() == 3


def test_buckets_that_cannot_gain_are_not_opened():
    n = 50
    rng = np.random.default_rng(1)
    lists = [sorted(rng.choice(30, rng.integers(1, 12), replace=False).tolist()) for _ in range(n)]
    weight = rng.integers(1, 5000, 30)
    m, tf = rng.integers(10, 500, n), [[int(x) for x in rng.integers(1, 9, len(t))] for t in lists]
    score = [{t: int(ranked._impact(weight[t], np.int64(c), m[i])) for t, c in zip(lists[i], tf[i])} for i in range(n)]
    length = [math.sqrt(sum(v * v for v in s.values())) for s in score]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(m), pa.array(lists, pa.list_(pa.int32())), pa.array(tf, pa.list_(pa.int32())), pa.array(length)],
        ["m", "terms", "tf", "length"],
    )
    asked = [np.array(sorted(range(q, q + 6), key=lambda t: (-weight[t], t)), np.int32) for q in range(20)]
    full = [[sum(s.get(t, 0) for t in a.tolist()) for s in score] for a in asked]
    for share in (0.0, 0.5, 0.9, 1.0, 1.1):
        least = np.array([int(max(f) * share) for f in full])
        query, row, found = ranked._bucket(batch, weight, asked, least.copy(), n)
        want = {(q, r, full[q][r]) for q in range(20) for r in range(n) if full[q][r] >= max(1, least[q])}
        assert set(zip(query.tolist(), row.tolist(), found.tolist())) == want
    beyond = np.array([math.ceil(math.sqrt(6) * max(length) * 1.01)] * 20)
    assert all(part.size == 0 for part in ranked._bucket(batch, weight, asked, beyond, n))
