from __future__ import annotations

import random
from collections import Counter

import edges
import numpy as np

from lakestar.llm import suffixes
from lakestar.llm.queries import op2_suffixes

SCHEMA = "doc_id long, text string"
W = suffixes.WORDS


def brute(texts: dict) -> set[tuple]:
    words = {i: (t or "").split() for i, t in texts.items()}
    windows = Counter(tuple(w[j : j + W]) for w in words.values() for j in range(len(w) - W + 1))
    out = set()
    for i, w in words.items():
        span = None
        for j in range(len(w) - W + 1):
            if windows[tuple(w[j : j + W])] > 1:
                if span and span[1] >= j:
                    span[1] = j + W
                else:
                    out |= {(i, *span)} if span else set()
                    span = [j, j + W]
        out |= {(i, *span)} if span else set()
    return out


def spans(spark, texts):
    df = spark.createDataFrame(list(texts.items()), SCHEMA).repartition(7)
    return {(r["doc_id"], r["start"], r["end"]) for r in suffixes.with_spans(df).collect()}


def test_spans_equal_brute_force(spark):
    r = random.Random(7)
    fresh = iter(range(10**9))
    text = lambda n: [f"u{next(fresh)}" for _ in range(n)]
    passages = [text(r.choice([49, 50, 51, 60, 90, 300])) for _ in range(12)]
    texts = {}
    for i in range(60):
        parts = []
        for _ in range(r.randrange(0, 4)):
            p = r.choice(passages)
            a, b = r.randrange(0, 9), len(p) - r.randrange(0, 9)  # cut differently on both sides
            parts += text(r.randrange(0, 70)) + p[a:b]
        texts[i] = " ".join(parts + text(r.randrange(0, 70)))
    assert spans(spark, texts) == brute(texts) and len(brute(texts)) > 30


def test_repeats_within_one_text_and_in_periodic_ones(spark):
    line = [f"v{i}" for i in range(64)]
    texts = {0: " ".join(line + ["x"] + line), 1: " ".join(["same"] * 500), 2: " ".join(["a", "b", "c"] * 70), 3: " ".join(["same"] * 49)}
    assert spans(spark, texts) == brute(texts)


def test_a_passage_that_all_texts_share(spark):
    passage = [f"p{i}" for i in range(55)]
    texts = {i: " ".join([f"a{i}x{j}" for j in range(40)] + passage + [f"b{i}x{j}" for j in range(40)]) for i in range(300)}
    assert spans(spark, texts) == {(i, 40, 95) for i in range(300)}


def test_copies_and_first(spark):
    text = " ".join(f"w{i}" for i in range(80))
    df = spark.createDataFrame([(i, text) for i in range(5)], SCHEMA)
    got = suffixes.with_spans(df).collect()
    assert {(r["start"], r["end"], r["copies"]) for r in got} == {(0, 80, 5)} and sum(r["first"] for r in got) == 1


def left(spark, texts):
    """How often each repeated window is left after the pieces that stand elsewhere before are dropped."""
    rows = suffixes.with_spans(spark.createDataFrame(list(texts.items()), SCHEMA).coalesce(1)).collect()
    gone = {i: set() for i in texts}
    for r in rows:
        assert all(r["start"] <= a < b <= r["end"] for a, b, _ in r["again"])
        assert r["first"] == ([(a, b) for a, b, _ in r["again"]] != [(r["start"], r["end"])])
        gone[r["doc_id"]] |= {k for a, b, _ in r["again"] for k in range(a, b)}
    copies, out, seen = Counter(), Counter(), set()
    for i, t in texts.items():
        w = t.split()
        for j in range(len(w) - W + 1):
            copies[tuple(w[j : j + W])] += t not in seen
            out[tuple(w[j : j + W])] += not gone[i] & set(range(j, j + W))
        seen.add(t)
    return {w: out[w] for w in copies if copies[w] > 1}


def test_dropping_what_stands_before_leaves_each_window_once(spark, tmp_path):
    a, b, c, p = ([f"{x}{i}" for i in range(60)] for x in "abcp")
    own = lambda x, n: [f"{x}own{i}" for i in range(n)]
    texts = {
        3: own("x", 9) + a, 7: own("y", 5) + a + b + own("z", 5), 9: b + own("w", 9),
        12: p + own("p", 9), 15: own("q", 70) + p + own("r", 70), 16: own("q", 70) + p + own("r", 70),
        20: c + own("s", 9) + c, 21: a + b + c,
    }
    texts = {i: " ".join(w) for i, w in texts.items()}
    found = left(spark, texts)
    assert len(found) >= 44 and set(found.values()) == {1}
    spark.createDataFrame(list(texts.items()), SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {tuple(r) for r in op2_suffixes(spark, str(tmp_path)).collect()}
    of = lambda i: {r[1:] for r in rows if r[0] == i}
    assert of(7) == {(5, 125, 3, True), (5, 16, 3, False)} and of(9) == {(0, 60, 3, False)}
    assert of(15) == {(0, 200, 2, True), (70, 130, 2, False)} and of(16) == {(0, 200, 2, False)}


def test_no_window_is_lost_where_passages_overlap(spark):
    r = random.Random(11)
    words = [f"o{i}" for i in range(400)]
    texts = {}
    for i in range(60):
        at = r.randrange(0, 300)
        texts[i] = " ".join([f"f{i}"] + words[at : at + r.randrange(50, 100)] + [f"g{i}"]) if i % 7 else texts.get(i - 5, "")
    found = left(spark, texts)
    assert len(found) > 100 and min(found.values()) == 1


def test_minimisers_depend_on_their_window_alone():
    r = np.random.default_rng(1)
    common = r.integers(0, 50, 200).astype(np.uint64)  # with ties
    kept = []
    for n in (0, 5, 33):
        x = np.concatenate([r.integers(0, 50, n).astype(np.uint64), common, r.integers(0, 50, n).astype(np.uint64)])
        kept.append({int(p) - n for p in suffixes.minimisers(x) if n + 40 <= p < n + 160})
    assert kept[0] == kept[1] == kept[2]
    gaps = np.diff(suffixes.minimisers(common))
    assert gaps.max() <= suffixes.REACH


def test_edges(spark):
    docs = edges.clashing(edges.documents(spark).unionByName(edges.documents(spark)))
    got = suffixes.with_spans(docs)
    rows = got.collect()
    assert {r["doc_id"] for r in rows} == {5} and {(r["start"], r["end"]) for r in rows} == {(0, 60_000)}
    assert {"start_input", "row_no_input"} <= set(got.columns)
    assert suffixes.with_spans(edges.empty(spark)).count() == 0
