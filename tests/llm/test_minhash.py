from __future__ import annotations

import random
from collections import defaultdict

import edges
import numpy as np
import pytest

from lakestar.llm import minhash
from lakestar.llm.components import components
from lakestar.llm.shingles import mixed

SCHEMA = "doc_id long, text string"


def brute(texts: dict[int, str | None], at_least: float = 0.8) -> set[frozenset]:
    """Groups of ids by comparing every two texts."""
    sets = {}
    for i, text in texts.items():
        w = (text or "").lower().split()
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else None
    parent = {i: i for i in texts}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = [i for i in texts if sets[i]]
    for x, i in enumerate(ids):
        for j in ids[:x]:
            a, b = sets[i], sets[j]
            if len(a & b) >= at_least * len(a | b):
                parent[top(i)] = top(j)
    found = defaultdict(set)
    for i in texts:
        found[top(i)].add(i)
    return set(map(frozenset, found.values()))


def groups(spark, texts, parts=6):
    df = spark.createDataFrame(list(texts.items()), SCHEMA).repartition(parts)
    found = defaultdict(set)
    stays = 0
    for r in minhash.with_groups(df).collect():
        found[r["group_no"]].add(r["doc_id"])
        stays += r["stays"]
    assert stays == len(found)
    return set(map(frozenset, found.values()))


def perturbed(r, words, n):
    out = list(words)
    for _ in range(n):
        out[r.randrange(len(out))] = f"new{r.random()}"
    return " ".join(out)


def test_groups_equal_brute_force(spark):
    r = random.Random(1)
    texts, n = {}, 0
    for base in range(25):
        words = [f"w{r.randrange(400)}" for _ in range(r.choice([1, 3, 8, 40, 200]))]
        for _ in range(r.randrange(1, 7)):
            texts[n] = perturbed(r, words, r.choice([0, 0, 1, 2, 6]))
            n += 1
    assert groups(spark, texts) == brute(texts)


def test_one_large_group_of_near_copies(spark):
    """A chain of copies of copies: no hub is near all of them."""
    r = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    texts = {}
    for i in range(150):
        texts[i] = " ".join(words)
        words[r.randrange(400)] = f"x{i}"
    texts[150] = "something else entirely that is not near to any of the others here"
    assert groups(spark, texts) == brute(texts)


def test_exact_copies(spark):
    texts = dict.fromkeys(range(500), "A b c\td e f g") | {500: "a  B c d\ne f g", 501: "a b c d e f h"}
    assert groups(spark, texts) == {frozenset(range(501)), frozenset({501})}


def test_signatures_estimate_the_probability_jaccard():
    x = {i: float(i % 4 + 1) for i in range(300)}
    y = {i: float(i % 3 + 1) for i in range(90, 380)}
    want = sum(
        1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in x.keys() | y.keys()) for i in x.keys() & y.keys()
    )
    ids = mixed(np.array([*x, *y], np.uint64) + np.uint64(99))
    owner = np.repeat([0, 1], [len(x), len(y)])
    kept = minhash.signatures(owner, ids, np.array([*x.values(), *y.values()]), 2, 6000)
    assert abs((kept[0] == kept[1]).mean() - want) < 4 * np.sqrt(want * (1 - want) / 6000)
    alone = minhash.signatures(owner[owner == 0], ids[owner == 0], np.array([*x.values()]), 1, 6000)
    assert (alone[0] == kept[0]).all()  # a document's signature does not depend on others


def test_share_of_registers_follows_the_weight():
    ids, weight = mixed(np.arange(3, dtype=np.uint64)), np.array([1.0, 2.0, 5.0])
    kept = minhash.signatures(np.zeros(3, int), ids, weight, 1, 20_000)[0]
    assert np.allclose([(kept == i).mean() for i in ids], weight / 8, atol=0.015)


@pytest.mark.parametrize("repeated", [0.0, 0.1, 0.5])
def test_recall_with_unequal_repeats(repeated):
    """Pairs at a set similarity of 0.8, one text repeating some shared shingles 1,000 times."""
    found = []
    for trial in range(200):
        ids = mixed(np.arange(90, dtype=np.uint64) + np.uint64(trial * 1000))
        counts = np.ones(80)  # 70 of 90 shingles are shared; 80 in each text: 70 / 90 is 0.78, less than asked for
        counts[: int(70 * repeated)] = 1000
        shingle = np.concatenate([ids[:80], ids[:70], ids[80:]])
        weight = minhash.weights(np.concatenate([counts, np.ones(80)]))
        kept = minhash.signatures(np.repeat([0, 1], 80), shingle, weight, 2, minhash.BANDS * minhash.ROWS)
        one, other = minhash._band_keys(kept, minhash.BANDS)
        found.append(bool((one == other).any()))
    assert np.mean(found) >= 0.9


def test_copies_that_repeat_a_part_are_found(spark):
    """Same shingles, one text repeating a tenth of them: set similarity 1 but for the seams."""
    r = random.Random(9)
    texts = {}
    for i in range(40):
        words = [f"v{i}x{r.randrange(10**6)}" for _ in range(120)]
        texts[2 * i] = " ".join(words)
        texts[2 * i + 1] = " ".join(words + words[:12] * 200)
    assert groups(spark, texts) == brute(texts) == {frozenset({2 * i, 2 * i + 1}) for i in range(40)}


def test_no_text_is_shuffled_however_many_are_wanted(spark, monkeypatch):
    from settings import settings

    plans = []
    real = minhash.written

    def noting(df, label, *more):
        plans.append((label, df._jdf.queryExecution().toString()))
        return real(df, label, *more)

    monkeypatch.setattr(minhash, "written", noting)
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        texts = {i: f"one two three four five six {i % 5} seven eight" for i in range(50)}
        assert groups(spark, texts) == brute(texts)
    assert [plan for label, plan in plans if label == "near-sets"] and not any(
        "text" in line for _, plan in plans for line in plan.splitlines() if "Exchange" in line
    )
    assert not any("Exchange" in plan for label, plan in plans if label == "near-sets")


@pytest.mark.parametrize("links", [[(1, 2), (2, 3), (4, 5)], [(i, i + 1) for i in range(40)], [(9, i) for i in range(9)], []])
def test_components(spark, links):
    got = {r["node"]: r["least"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: i for pair in links for i in pair}
    for _ in want:
        for a, b in links:
            want[a] = want[b] = min(want[a], want[b])
    assert got == want


def test_edges(spark):
    got = minhash.with_groups(edges.clashing(edges.documents(spark)))
    rows = got.collect()
    assert len(rows) == len(edges.rows()) and "group_no_input" in got.columns
    stay = [r for r in rows if r["stays"]]
    assert len(stay) == len(rows) - 2  # the repeated row and the one in capitals go
    assert minhash.with_groups(edges.empty(spark)).count() == 0
