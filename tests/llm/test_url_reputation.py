from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from compare import difference
from pyspark.sql import functions as F

from lakestar.llm import url_reputation as U
from lakestar.llm.queries import op10_url_reputation

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/de/", "block"), ("com", "/fr/", "allow")]
PAGES = "page_id long, url string, html string"


def rules(spark, rows=RULES):
    return spark.createDataFrame(rows, "rule_host string, rule_path string, rule_verdict string")


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host) :]
    for c in "?#":
        path = path.split(c, 1)[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


URLS = [
    "https://Blog.EXAMPLE.org/es/1?x=/y", "http://example.org/en/12#a", "http://example.org/en/2", "http://notexample.org/es/",
    "https://x.com/de/", "https://x.com/fr/#", "ftp://com/de/x", "https://x.com", "https://x.com?u=http://y.org/", "no scheme",
    "", None, "://", "://org/", "a://b://c/d", "http://ÀB.org/é\nline", "http://u@h.com:80/de/9", "http://10.0.0.1/de/",
    "http://org", "https://x.com/de/", "https://x.com/de/",
]


def test_parts_and_rules(spark):
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(URLS)], PAGES)
    got = {r["page_id"]: r for r in U.judge(pages, rules(spark)).collect()}
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        host, path, rule, verdict = brute(u)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), u
        assert verdict is None or got[i]["verdict"] == verdict


def test_hosts_are_judged_by_their_labels_and_their_parents(spark):
    urls = [f"http://bad.com/de/{i}" for i in range(200)] + [f"http://good.com/fr/{i}" for i in range(200)]
    urls += [f"http://a.evil.com/de/{i}" for i in range(400)] + [f"http://b.evil.com/de/{i}" for i in range(400)]
    asked = ["http://bad.com/x", "http://good.com/x", "http://new.evil.com/x", "http://new.com/x", "http://never.net/x"]
    pages = spark.createDataFrame([(i, u, "") for i, u in enumerate(urls + asked)], PAGES)
    got = {r["url"]: r for r in U.judge(pages, rules(spark)).where(F.col("rule").isNull()).collect()}
    assert got["http://bad.com/x"]["verdict"] == "block" and got["http://good.com/x"]["verdict"] == "allow"
    # an unseen host of a bad domain is judged by the domain, an unseen domain by its suffix alone
    low = [got[u]["bad_low"] for u in ("http://good.com/x", "http://new.com/x", "http://new.evil.com/x")]
    assert low[0] < low[1] < low[2] and got["http://new.evil.com/x"]["verdict"] == "block"
    assert got["http://new.com/x"]["verdict"] == "allow"
    assert got["http://never.net/x"]["verdict"] == "allow"


def test_shrinkage_is_the_beta_posterior(spark):
    hosts = [("a.x.com", 10, 9), ("b.x.com", 0, 0), ("c.y.com", 50, 1), ("d.net", 5, 0)]
    got = {r["host"]: r for r in U.reputation(spark.createDataFrame(hosts, "host string, n long, bad long")).collect()}
    assert 0 < got["c.y.com"]["bad_rate"] < got["b.x.com"]["bad_rate"] < got["a.x.com"]["bad_rate"] < 1
    assert got["b.x.com"]["bad_low"] < got["a.x.com"]["bad_low"] < got["a.x.com"]["bad_rate"]


@pytest.mark.parametrize(
    ("host", "domain", "suffix"),
    [("a.b.example.com", "example.com", "com"), ("x.co.uk", "x.co.uk", "co.uk"), ("w.x.co.uk:8080", "x.co.uk", "co.uk"),
     ("localhost", "localhost", "localhost"), ("10.1.2.3", "10.1.2.3", ""), ("u:p@h.net", "h.net", "net"), ("", "", "")],
)
def test_parents(spark, host, domain, suffix):
    d, s = U.parents(F.lit(host))
    assert tuple(spark.range(1).select(d, s).first()) == (domain, suffix)


SUFFIXES = [("com",), ("uk",), ("co.uk",), ("*.ck",), ("!www.ck",), ("github.io",), ("com.cn",), (None,), ("com",)]


@pytest.mark.parametrize(
    ("host", "domain", "suffix"),
    [("a.b.example.com", "example.com", "com"), ("w.x.co.uk:8080", "x.co.uk", "co.uk"), ("a.b.gov.uk", "gov.uk", "uk"),
     ("me.github.io", "me.github.io", "github.io"), ("x.me.github.io", "me.github.io", "github.io"), ("shop.example.com.cn", "example.com.cn", "com.cn"),
     ("a.b.c.ck", "b.c.ck", "c.ck"), ("a.www.ck", "www.ck", "ck"), ("www.ck", "www.ck", "ck"), ("c.ck", "c.ck", "c.ck"),
     ("never.listed.zz", "listed.zz", "zz"), ("localhost", "localhost", "localhost"), ("10.1.2.3", "10.1.2.3", ""), ("", "", "")],
)
def test_parents_by_a_table_of_suffixes(spark, host, domain, suffix):
    table = spark.createDataFrame(SUFFIXES, "suffix string")
    got = U.with_parents(spark.createDataFrame([(host,)], "host string"), table).first()
    assert (got["domain"], got["suffix"]) == (domain, suffix)


def test_hosts_under_a_listed_suffix_are_no_kin(spark):
    """One bad name under a suffix where everyone registers says little about the others."""
    urls = [f"http://bad.github.io/x/{i}" for i in range(300)] + [f"http://good{k}.github.io/y/{i}" for k in range(30) for i in range(10)]
    pages = spark.createDataFrame([(i, u, "") for i, u in enumerate([*urls, "http://bad.github.io/z", "http://new.github.io/z"])], PAGES)
    own = rules(spark, [("github.io", "/x/", "block"), ("github.io", "/y/", "allow")])
    got = {r["url"]: r for r in U.judge(pages, own, suffixes=spark.createDataFrame(SUFFIXES, "suffix string")).collect()}
    assert got["http://bad.github.io/z"]["verdict"] == "block" and got["http://new.github.io/z"]["verdict"] == "allow"


def test_reputation_decides_in_the_registered_query(spark, tmp_path):
    """Pages without a rule are blocked by what rules say of their host; the SQL says the same."""
    urls = [f"http://bad.com/de/{i}" for i in range(200)] + [f"http://good.com/fr/{i}" for i in range(200)]
    urls += [f"http://{h}.evil.com/de/{i}" for h in "abc" for i in range(300)] + ["http://bad.com/x", "http://new.evil.com/x", "http://good.com/x"]
    table = pa.table({"page_id": list(range(len(urls))), "url": urls, "html": [""] * len(urls)})
    pq.write_table(table, tmp_path / "pages.parquet")
    got = {r["page_id"]: r for r in op10_url_reputation(spark, str(tmp_path)).collect()}
    last = [(got[i]["rule"], got[i]["verdict"]) for i in range(len(urls) - 3, len(urls))]
    assert last == [(None, "block"), (None, "block"), (None, "allow")]
    assert difference(spark, str(tmp_path), "op10_url_reputation") is None


def test_pages_are_not_dealt_out_by_url(spark, capsys):
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(URLS)], PAGES)
    U.judge(pages, rules(spark)).explain()
    assert not [x for x in capsys.readouterr().out.splitlines() if "Exchange hashpartitioning" in x and "path" in x]


def test_edges(spark):
    one = "page_id long, url string, html string, host string, rule string, n string, bad_low string, rule_host string"
    pages = spark.createDataFrame([(1, "http://x.com/de/", None, "own", None, "n", "b", "r"), (None, None, None, None, None, None, None, None)], one)
    got = U.judge(pages, rules(spark))
    assert got.count() == 2 and {"host_input", "rule_input", "bad_low_input"} <= set(got.columns)
    assert U.judge(pages.limit(0), rules(spark)).count() == 0
    assert {r["verdict"] for r in U.judge(pages, rules(spark).limit(0)).collect()} == {"allow"}
