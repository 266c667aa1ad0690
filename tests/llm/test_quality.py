from __future__ import annotations

import random
import re
from collections import defaultdict
from itertools import combinations

import edges
import numpy as np
from pyspark.sql import functions as F

from lakestar.llm import quality

SCHEMA = "doc_id long, text string, lang string, source string"
SPACE = r"[^\x20\x09-\x0D]+"


def brute(text):
    t = text or ""
    w, lines = re.findall(SPACE, t), [x for x in t.split("\n") if re.search(SPACE, x)]
    places = defaultdict(list)
    for i in range(len(w) - 7):
        places[tuple(w[i : i + 8])].append(i)
    twice = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(twice)


def texts():
    r = random.Random(3)
    out = [None, "", " \n\x0b ", "a", "x " * 8, "x " * 9, "a b c d e f g h " * 2, "l\nl\n\nl\n \nm", "é#* %\x85 😀|<>&", "\r\n\r\n"]
    for _ in range(40):
        out.append(r.choice([" ", "\n", "\t "]).join(r.choice("abc#é") * r.randrange(1, 3) for _ in range(r.randrange(0, 90))))
    return out


def test_counts_equal_brute_force(spark):
    docs = [(i, t, "en", "a") for i, t in enumerate(texts())]
    got = quality.measure(spark.createDataFrame(docs, SCHEMA)).collect()
    for r in got:
        assert tuple(r[c] for c in quality.COUNTS) == brute(r["text"]), r["text"]


def corpus(spark, n=1200):
    """Ordinary prose in two languages with words of different length, and one document in ten odd."""
    r = random.Random(5)
    rows, odd = [], set()
    for i in range(n):
        lang, source = ("en", "a") if i % 3 else ("de", "b")
        size = int(np.exp(r.gauss(5, 0.7))) + 25
        words = ["".join(r.choice("abcdefghij") for _ in range(max(1, int(r.gauss(5 if lang == "en" else 8, 2))))) for _ in range(size)]
        if i % 10 == 0:
            odd.add(i)
            words = [w + r.choice(["###", "$$$"]) for w in words] if i % 20 else [w.upper() for w in words]
        rows.append((i, " ".join(words), lang, source))
    return spark.createDataFrame(rows, SCHEMA), odd


def test_outliers_are_rejected_and_others_kept(spark):
    docs, odd = corpus(spark)
    got = quality.verdicts(quality.measure(docs), least_rows=50).collect()
    assert {r["doc_id"] for r in got if not r["kept"]} == odd


def test_few_documents_are_judged_with_their_language(spark):
    docs, odd = corpus(spark)
    docs = docs.withColumn("source", F.concat("source", (F.col("doc_id") % 400).cast("string")))
    got = quality.verdicts(quality.measure(docs)).collect()
    assert {r["doc_id"] for r in got if not r["kept"]} == odd


def test_centre_and_covariance_are_those_of_the_bulk(spark):
    """A third of the documents is far away, all on one side; neither centre nor spread follow."""
    r = np.random.default_rng(2)
    p = len(quality.FLOORS)
    mix = r.normal(size=(p, p)) + 3 * np.eye(p)
    bulk = r.normal(size=(3000, p)) @ mix
    far = r.normal(size=(600, p)) * 0.1 + 40
    rows = [("k", x.tolist()) for x in np.concatenate([bulk, far])]
    fit = quality.robust_fit(spark.createDataFrame(rows, "key string, x array<double>"), steps=8).first()
    low = np.zeros((p, p))
    low[np.tril_indices(p)] = fit["inverse"]
    found = np.linalg.inv(low.T @ low) * fit["scale"]
    assert np.allclose(fit["mean"], bulk.mean(axis=0), atol=1.0)
    want = np.cov(bulk.T)
    assert np.abs(found - want).max() < 0.35 * np.abs(want).max()


def test_a_third_of_bad_rows_shapes_nothing(spark):
    """With production values, wherever they are; they are all rejected, and nearly no others."""
    r = np.random.default_rng(4)
    p = len(quality.FLOORS)
    mix = r.normal(size=(p, p)) + 3 * np.eye(p)
    bulk = r.normal(size=(2400, p)) @ mix
    rows = []
    for key, far in {
        "one side": r.normal(size=(1200, p)) * 0.1 + 40,
        "wide": r.normal(size=(1200, p)) * 30 + 60,
        "one statistic": bulk[:1200] + 60 * np.eye(p)[3],
    }.items():
        rows += [(key, x.tolist(), i >= len(bulk)) for i, x in enumerate(np.concatenate([bulk, far]))]
    df = spark.createDataFrame(rows, "key string, x array<double>, bad boolean")
    fit = quality.robust_fit(df.select("key", "x"))
    out = df.join(fit, "key").withColumn("out", quality._square_distance(p) / F.col("scale") > quality.CUTOFF)
    shares = out.groupBy("key", "bad").agg(F.avg(F.col("out").cast("double")).alias("share")).collect()
    assert len(shares) == 6 and all(s["share"] > 0.98 if s["bad"] else s["share"] < 0.01 for s in shares), shares


def test_small_groups_are_judged_by_their_whole_language_or_not_at_all(spark):
    rows = [("en", "a", i) for i in range(300)] + [("en", "b", i) for i in range(9)] + [("de", "a", i) for i in range(20)]
    docs = spark.createDataFrame([(i, " ".join(["word"] * 5 + [f"w{i}x{j}" for j in range(40)]), a, b) for a, b, i in rows], SCHEMA)
    long = spark.createDataFrame([(-1, " ".join(f"v{j}" for j in range(90_000)), "en", "b"), (-2, " ".join(f"v{j}" for j in range(90_000)), "de", "a")], SCHEMA)
    got = quality.verdicts(quality.measure(docs.unionByName(long))).collect()
    assert {r["doc_id"] for r in got if not r["kept"]} == {-1}
    assert all((r["distance"] is None) == (r["lang"] == "de") for r in got)


def test_repeated_lines_are_rejected_and_few_of_them_kept(spark):
    r = random.Random(8)
    line = lambda: " ".join("".join(r.choice("abcdefghij") for _ in range(max(2, int(r.gauss(5, 1))))) for _ in range(r.randrange(1, 7)))
    menu = [f"menu{c}" for c in "abcdefghij"]

    def page(repeated, n=200):
        again = menu + r.choices(menu, k=repeated) if repeated else []
        lines = again + [line() + f" {i}x" for i in range(n - len(again))]
        r.shuffle(lines)
        return "\n".join(lines)

    clean = [(i, page(0), "en", "a") for i in range(300)] + [(300 + i, page(2 + i), "en", "a") for i in range(8)]
    bad = [(1000 + k, page(k), "en", "a") for k in (100, 120, 140, 160, 180)]
    got = quality.verdicts(quality.measure(spark.createDataFrame(clean + bad, SCHEMA))).collect()
    assert not any(r["base_failed"] for r in got)
    assert {r["doc_id"] for r in got if not r["kept"]} == {i for i, *_ in bad}


def test_one_repeated_line_on_a_short_page_is_no_outlier(spark):
    """Among pages that repeat nothing; it shows in two statistics, but it is one event."""
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(max(2, int(r.gauss(5, 1)))))

    def page(size):
        return [" ".join(word() for _ in range(12)) for _ in range(size)]

    clean = [(i, "\n".join(page(r.randrange(4, 30))), "en", "a") for i in range(400)]
    once = [(1000 + i, "\n".join((lambda p: [*p, p[0]])(page(8 + i))), "en", "a") for i in range(8)]
    got = quality.verdicts(quality.measure(spark.createDataFrame(clean + once, SCHEMA))).collect()
    assert not [r["doc_id"] for r in got if r["doc_id"] >= 1000 and not r["kept"] and not r["base_failed"]]


def test_the_determinant_is_nearly_the_least_of_all_halves(spark):
    """A small group, all its halves tried one by one."""
    r = np.random.default_rng(7)
    p = len(quality.FLOORS)
    x = np.concatenate([r.normal(size=(10, p)), r.normal(size=(3, p)) * 3 + 25])
    half = (len(x) + p + 2) // 2
    floors = np.diag(np.square(quality.FLOORS))
    log_det = lambda rows: np.linalg.slogdet(np.cov(rows.T, bias=True) * quality.CONSISTENCY + floors)[1]
    least = min(log_det(x[list(half_rows)]) for half_rows in combinations(range(len(x)), half))
    fit = quality.robust_fit(spark.createDataFrame([("k", row.tolist()) for row in x], "key string, x array<double>")).first()
    low = np.zeros((p, p))
    low[np.tril_indices(p)] = fit["inverse"]
    found = -2 * np.log(np.diag(low)).sum()
    assert least - 1e-6 <= found + 1e-6 and found < least + 3  # bins may take in a row more
    assert np.abs(np.array(fit["mean"])).max() < 2


def test_inverse_factor(spark):
    r = np.random.default_rng(1)
    p = len(quality.FLOORS)
    x = r.normal(size=(50, p)) * 5
    q = [float((x[:, i] * x[:, j]).sum()) for i in range(p) for j in range(i + 1)]
    moments = spark.createDataFrame([("k", 50, x.sum(axis=0).tolist(), q)], "key string, n long, s array<double>, q array<double>")
    got = quality._inverse_factor(moments, p).first()
    low = np.zeros((p, p))
    low[np.tril_indices(p)] = got["inverse"]
    cov = np.cov(x.T, bias=True) + np.diag(np.square(quality.FLOORS))
    assert np.allclose(low.T @ low, np.linalg.inv(cov)) and np.allclose(got["mean"], x.mean(axis=0))


def test_edges(spark):
    got = quality.verdicts(quality.measure(edges.clashing(edges.documents(spark))))
    rows = got.collect()
    assert len(rows) == len(edges.rows()) and {"n_words_input", "key_input", "kept_input", "x_input"} <= set(got.columns)
    assert all(r["base_failed"] and not r["kept"] for r in rows if not (r["text"] or "").strip() or r["doc_id"] == 6)
    none = quality.verdicts(quality.measure(edges.empty(spark)))
    assert none.count() == 0 and none.columns[-3:] == ["base_failed", "distance", "kept"]
    same = spark.createDataFrame([(1, "the same words over and over but not twice in this one text, I promise you that it is long", "en", "a")] * 300, SCHEMA)
    assert all(r["kept"] for r in quality.verdicts(quality.measure(same)).collect())
