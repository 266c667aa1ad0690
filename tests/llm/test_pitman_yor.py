from __future__ import annotations

import math
import random
from collections import Counter
from itertools import product
from pathlib import Path
from zlib import crc32

import edges
import numpy as np
import pyarrow.parquet as pq
import pytest

from lakestar.llm import pitman_yor as P
from lakestar.llm.queries import QUERIES
from lakestar.session import shared_folder

SCHEMA = "doc_id long, text string"


def partitions_weight(customers, discount):
    """Sum over set partitions by number of blocks: each block of size n weighs (1-d)(2-d)...(n-1-d)."""
    out = Counter()
    for seats in product(range(customers), repeat=customers):
        if all(s <= max(seats[:i], default=-1) + 1 for i, s in enumerate(seats)):
            sizes = Counter(seats).values()
            out[len(sizes)] += math.prod(math.prod(j - discount for j in range(1, n)) for n in sizes)
    return out


def test_stirling_numbers_count_seatings():
    table = P.stirling(8, 0.6)
    for c in range(1, 7):
        want = partitions_weight(c, 0.6)
        assert all(abs(np.exp(table[c, t]) - want[t]) < 1e-9 * want[t] for t in want)


def test_tables_follow_their_law():
    n, discount, weight = 40_000, 0.7, 2.5
    r = np.random.default_rng(1)
    table = P.stirling(P.TABULATED, discount)
    for c in (2, 9, 60):
        t = P.draw_tables(np.full(n, c), np.full(n, weight), discount, table, r.random(n), r.random(n))
        logs = table[c, 1 : c + 1] + np.arange(1, c + 1) * np.log(weight)
        p = np.exp(logs - logs.max())
        p /= p.sum()
        mean = (p * np.arange(1, c + 1)).sum()
        deviation = math.sqrt((p * np.arange(1, c + 1) ** 2).sum() - mean**2)
        assert abs(t.mean() - mean) < 4 * deviation / math.sqrt(n) and t.min() >= 1 and t.max() <= c


@pytest.mark.parametrize("weight", [0.5, 5.0, 80.0])
@pytest.mark.parametrize("customers", [100, 400])
def test_the_saddle_point_agrees_with_the_tabulated_law(customers, weight):
    n, discount = 20_000, 0.6
    r = np.random.default_rng(2)
    large = P.stirling(500, discount)
    u, v = r.random(n), r.random(n)
    exact = P.draw_tables(np.full(n, customers), np.full(n, weight), discount, large, u, v)
    near = P.draw_tables(np.full(n, customers), np.full(n, weight), discount, P.stirling(64, discount), u, v)
    assert abs(exact.mean() - near.mean()) < 0.1 * exact.mean() + 0.6
    assert abs(exact.std() - near.std()) < 0.15 * exact.std() + 0.5


def corpus(n=400, seed=1):
    """A word is mostly followed by the one after it, so the word before tells something."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        at, words = r.randrange(60), []
        for _ in range(r.randrange(0, 80)):
            at = (at + 1) % 60 if r.random() < 0.8 else r.randrange(60)
            words.append(f"W{at}")
        out.append((i, r.choice([" ", "\n"]).join(words)))
    return out


def test_base_score_and_counts_equal_brute_force(spark):
    docs = corpus() + [(1000, "never seen before"), (1001, None), (1002, ""), (None, "w1 w2")]
    got = {r["doc_id"]: r for r in P.score_documents(spark.createDataFrame(docs, SCHEMA).repartition(5)).collect()}
    tokens = {i: [*(t or "").lower().split(), None] for i, t in docs}
    held = {i: crc32(str(i if i is not None else "").encode()) % 10 == 0 for i, _ in docs}
    counts = Counter(w for i in tokens for w in tokens[i] if not held[i])
    total, kinds = sum(counts.values()), len(counts)
    for i, words in tokens.items():
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in words)
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[i], len(words), total)
        assert r["n_known"] == sum(counts[w] > 0 for w in words) and abs(r["base_score"] - base) < 1e-9 * abs(base)


def test_context_helps_on_held_out_texts(spark):
    got = P.score_documents(spark.createDataFrame(corpus(800), SCHEMA)).where("held_out").toPandas()
    model, base = (10 ** -(got[c].sum() / got["n_tokens"].sum()) for c in ("score", "base_score"))
    assert model < 0.35 * base
    scored = spark.createDataFrame(got[["n_tokens", "score"]])
    assert abs(P.perplexity(scored).first()[0] - model) < 1e-6 * model


def probabilities(model):
    """A function of word and context, from the model's tables by plain arithmetic."""
    t, listed = model.totals, {r["word"]: r for r in model.words.collect()}
    head = model.words.sparkSession.sparkContext.broadcast(P.Head.of(model.words.where(model.frequent)))
    gain = {r["key"]: r["unseen"] for r in P._gains(model, model.pairs, head).collect()}
    states = range(1 + P.ROUNDS, 1 + P.ROUNDS + P.SAMPLES)

    def p(word, context):
        w, c = (listed.get(int(np.uint64(x).view(np.int64))) for x in (word, context))
        followed, parent = c["followed"] if c else 0, 0.0
        for s in states:
            seats = lambda r, name, lone: 0 if r is None else lone if r[name] is None else r[name][s]  # noqa: E731, B023
            base = (P.CONCENTRATION + t.root_discount * t.root_tables[s]) / (t.vocabulary + 1)
            dish = seats(w, "customers", 1) - t.root_discount * seats(w, "dish_tables", 1)
            back = (P.CONCENTRATION + t.discount * seats(c, "tables", followed)) / (P.CONCENTRATION + followed)
            parent += back * (dish + base) / (P.CONCENTRATION + t.root_customers[s]) / P.SAMPLES
        key = P._pair(np.array([word], np.uint64), np.array([context], np.uint64)).view(np.int64)[0]
        return parent * 10 ** gain.get(int(key), 0.0)

    return p


def hashed(word):
    return int(P.WordHashes().of([word.encode()])[0]) // P.SALTS * P.SALTS


@pytest.mark.parametrize("head_words", [P.HEAD_WORDS, 20])
def test_probabilities_sum_to_one_in_every_context(spark, monkeypatch, head_words):
    monkeypatch.setattr(P, "HEAD_WORDS", head_words)
    texts = corpus() + [(1000, "rare w1 w2"), (1001, "w3 seldom seldom")]
    p = probabilities(P.fit(spark.createDataFrame(texts, SCHEMA)))
    vocabulary = [hashed(w) for w in {w for _, t in texts for w in t.lower().split()} | {"unknown"}] + [P.END]
    for context in (hashed("w3"), hashed("rare"), hashed("seldom"), hashed("unknown"), P.START):
        assert math.isclose(sum(p(w, context) for w in vocabulary), 1, rel_tol=1e-9)


@pytest.mark.parametrize("head", [None, 5])
def test_scores_are_the_products_of_probabilities(spark, monkeypatch, head):
    if head:
        monkeypatch.setattr(P, "HEAD_WORDS", head)
        monkeypatch.setattr(P, "HEAD_PAIRS", head)
    model = P.fit(spark.createDataFrame(corpus(60), SCHEMA))
    p = probabilities(model)
    asked = ["w1 w2 w3 w9 w1", "w5 unknown w6 unknown", "", None, "w59 w0"]
    rows = spark.createDataFrame(list(enumerate(asked)), "row_no long, text string")
    for r in P.score(rows, model).collect():
        words = [hashed(w) for w in (asked[r["row_no"]] or "").split()] + [P.END]
        want = sum(math.log10(p(w, c)) for w, c in zip(words, [P.START, *words]))
        assert math.isclose(r["score"], want, rel_tol=1e-9)


def test_texts_learned_from_score_as_any_others_do(spark):
    docs = spark.createDataFrame([(i, t) for i, t in corpus(200) if not crc32(str(i).encode()) % 10 == 0], SCHEMA)
    model = P.fit(docs)
    rows = docs.withColumnRenamed("doc_id", "row_no")
    plain = {r["row_no"]: r["score"] for r in P.score(rows, model).collect()}
    own = {r["doc_id"]: r["score"] for r in P.score_documents(docs).collect()}
    assert all(math.isclose(own[i], plain[i], rel_tol=1e-9) for i in plain)


def test_every_word_is_a_context_of_its_own(spark):
    """Of 3,000 words each has one that follows it mostly: 32 classes of words before can't tell which."""
    r = random.Random(5)
    follows = list(range(3000))
    r.shuffle(follows)
    docs = []
    for i in range(1500):
        at, words = r.randrange(3000), []
        for _ in range(60):
            at = follows[at] if r.random() < 0.9 else r.randrange(3000)
            words.append(f"w{at}")
        docs.append((i, " ".join(words)))
    got = P.score_documents(spark.createDataFrame(docs, SCHEMA)).where("held_out").toPandas()
    model, base = (10 ** -(got[c].sum() / got["n_tokens"].sum()) for c in ("score", "base_score"))
    assert model < 0.02 * base  # the law itself: about 4 of 3,000


def test_joined_words_score_like_those_that_all_tasks_have(spark, monkeypatch):
    docs = spark.createDataFrame(corpus(200), SCHEMA)
    whole = {r["doc_id"]: r["score"] for r in P.score_documents(docs).collect()}
    monkeypatch.setattr(P, "HEAD_WORDS", 7)
    few = {r["doc_id"]: r["score"] for r in P.score_documents(docs).collect()}
    assert all(abs(whole[i] - few[i]) < 1e-9 * abs(whole[i]) for i in whole)


def test_partitions_and_reruns_agree(spark):
    docs = spark.createDataFrame(corpus(200), SCHEMA)
    one = {r["doc_id"]: r["score"] for r in P.score_documents(docs.coalesce(1)).collect()}
    many = {r["doc_id"]: r["score"] for r in P.score_documents(docs.repartition(11)).collect()}
    assert all(abs(one[i] - many[i]) < 1e-6 * abs(one[i]) for i in one)


def test_edges(spark):
    got = P.score_documents(edges.clashing(edges.documents(spark)))
    rows = got.collect()
    assert len(rows) == len(edges.rows()) and {"score_input", "held_out_input"} <= set(got.columns)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert {r["n_tokens"] for r in rows if not (r["text"] or "").strip()} == {1}
    assert P.score_documents(edges.empty(spark)).count() == 0
    held = next(i for i in range(100) if crc32(str(i).encode()) % 10 == 0)
    only = P.score_documents(spark.createDataFrame([(held, "a b")], SCHEMA)).first()
    assert (only["train_tokens"], only["n_known"], only["base_score"], only["score"]) == (0, 0, 0.0, 0.0)


def test_the_query_does_not_write_texts_again(spark, tmp_path):
    docs = spark.createDataFrame(corpus(100), SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.rglob("*.parquet"))
    got = {r["doc_id"]: r["score"] for r in QUERIES["op3_pitman_yor"](spark, str(tmp_path)).collect()}
    files = [f for f in set(folder.rglob("*.parquet")) - before if f.is_file()]
    assert files and not any("text" in pq.read_schema(f).names for f in files)
    kept = P.score_documents(docs).collect()
    assert len(got) == len(kept) and all(r["text"] is not None and abs(got[r["doc_id"]] - r["score"]) < 1e-9 * abs(r["score"]) for r in kept)


def test_long_slices_are_looked_up_in_parts(spark, monkeypatch):
    docs = spark.createDataFrame(corpus(100), SCHEMA).coalesce(1)
    whole = {r["doc_id"]: r["score"] for r in P.score_documents(docs).collect()}
    monkeypatch.setattr(P, "PART", 50)
    monkeypatch.setattr(P, "HEAD_WORDS", 20)
    parts = {r["doc_id"]: r["score"] for r in P.score_documents(docs).collect()}
    assert all(abs(whole[i] - parts[i]) < 1e-9 * abs(whole[i]) for i in whole)
