"""URL rules, and an empirical-Bayes reputation of hosts for the URLs that no rule fits.

Labelled outcomes of pages (bad or not) are counted per host. A host's bad rate is shrunk
towards that of its registered domain, the domain's towards its public suffix, the suffix's
towards the whole: at each level a beta prior whose mean is the parent's posterior mean and
whose strength comes from the spread of the children around it (beta-binomial moments). What is
uncertain about a parent is so about its children, in the share that it has in them. A URL is
blocked if even a low quantile of its host's posterior is above a bound, so a host with
few labels keeps its pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import col, step_aside, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Suffixes of two labels under which names are registered; fixed values, for callers who give no table of suffixes.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "com.br", "co.jp", "co.in", "co.nz")


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?`` or ``#``; A-Z lowered; else empty."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty for a null URL or one without ``://``."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def parents(host: Column, suffixes=TWO_LABEL_SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and suffix of a host; a number address or a single label is its own."""
    name = F.regexp_replace(host, r"^.*@|:[0-9]*$", "")
    number = name.rlike(r"^[0-9.]+$|^\[")
    two = F.substring_index(name, ".", -2)
    long = two.isin(*suffixes) if suffixes else F.lit(False)
    domain = F.when(number, name).when(long, F.substring_index(name, ".", -3)).otherwise(two)
    suffix = F.when(number, F.lit("")).when(long, two).otherwise(F.substring_index(name, ".", -1))
    return domain, suffix


def with_parents(hosts: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """Adds ``domain`` and ``suffix`` to distinct hosts.

    ``suffixes`` has one column ``suffix`` of rules as in public lists: ``co.uk``, ``*.ck`` (any label
    before it, too), ``!www.ck`` (but not this one). An exception goes before all, then the longest
    rule; without any the last label is the suffix. Hosts are joined by their own and their parent
    names, never with all rules. Null and repeated rules don't matter.
    """
    domain, suffix = parents(F.col("host"))
    if suffixes is None:
        return hosts.withColumns({"domain": domain, "suffix": suffix})
    rules = suffixes.select(F.lower(F.trim("suffix")).alias("asked")).where("asked is not null").distinct()
    name = F.regexp_replace("host", r"^.*@|:[0-9]*$", "")
    labels = F.split(name, r"\.", -1)
    n = F.size(labels)
    tail = lambda i: F.concat_ws(".", F.slice(labels, i, F.greatest(n - i + 1, F.lit(0))))
    # what a rule that starts at label i would be called, and at which label its suffix starts
    ways = lambda i: F.array(
        F.struct(F.concat(F.lit("!"), tail(i)).alias("asked"), F.lit(0).alias("kind"), (i + 1).alias("at")),
        F.struct(tail(i).alias("asked"), F.lit(1).alias("kind"), i.alias("at")),
        F.struct(F.concat(F.lit("*."), tail(i + 1)).alias("asked"), F.lit(1).alias("kind"), i.alias("at")),
    )
    asked = hosts.select("host", F.inline(F.flatten(F.transform(F.sequence(F.lit(1), n), ways))))
    found = asked.join(rules, "asked").groupBy("host").agg(F.min(F.struct("kind", "at")).alias("rule"))
    at = F.coalesce(F.col("rule.at"), n)
    known = hosts.join(found, "host", "left").withColumn("number", name.rlike(r"^[0-9.]+$|^\["))
    return known.withColumns(
        {
            "domain": F.when(F.col("number"), name).otherwise(tail(F.greatest(at - 1, F.lit(1)))),
            "suffix": F.when(F.col("number"), F.lit("")).otherwise(tail(at)),
        }
    ).drop("rule", "number")


def _strength(level: DataFrame, floor: float = 1e-4) -> float:
    """a + b of the beta prior; ``level`` has n, bad and the parents' mean rate p."""
    spread = F.col("p") * (1 - F.col("p"))
    n = F.col("n").cast("double")
    over, pairs = level.agg(
        F.sum((F.col("bad") - n * F.col("p")) ** 2 - n * spread), F.sum(n * (n - 1) * spread)
    ).first()
    share = over / pairs if over is not None and pairs else 1.0
    return 1 / min(max(share, floor), 0.5) - 1


def _shrunk(level: DataFrame, strength: float) -> DataFrame:
    """Adds ``rate`` and ``spread``, its variance, in which the parent's (v) has a share."""
    size = F.col("n") + F.lit(strength)
    level = level.withColumn("rate", (F.col("bad") + F.lit(strength) * F.col("p")) / size)
    share = F.lit(strength) / size
    return level.withColumn("spread", F.col("rate") * (1 - F.col("rate")) / (size + 1) + share * share * F.col("v"))


def reputation(hosts: DataFrame, z: float = 1.645, suffixes: DataFrame | None = None) -> DataFrame:
    """``host``, ``bad_rate``, ``bad_low``: posterior mean and low quantile (normal) of bad pages.

    ``hosts``: one row per host with ``n`` labelled pages, of them ``bad``; n may be 0. Without
    any label every rate is one half and its quantile low, so nothing is blocked. ``suffixes`` as
    for ``with_parents``.
    """
    hosts = written(with_parents(hosts.select("host", "n", "bad"), suffixes), "hosts")
    given = (F.col("rate").alias("p"), F.col("spread").alias("v"))
    sums = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = written(hosts.groupBy("domain", "suffix").agg(*sums), "domains")
    tops = written(domains.groupBy("suffix").agg(*sums), "suffixes")
    n, bad = tops.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    tops = tops.withColumns({"p": F.lit((bad + 0.5) / (n + 1)), "v": F.lit(0.0)})
    tops = written(_shrunk(tops, _strength(tops)), "suffix-rates")
    domains = domains.join(tops.select("suffix", *given), "suffix")
    domains = written(_shrunk(domains, _strength(domains)), "domain-rates")
    hosts = hosts.drop("suffix").join(domains.select("domain", *given), "domain")
    strength = _strength(hosts)
    low = F.col("rate") - z * F.sqrt("spread")
    return _shrunk(hosts, strength).select("host", F.col("rate").alias("bad_rate"), low.alias("bad_low"))


def fitting_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host``, ``rules``: what fits the host, longest first, as structs of size, rule, path, verdict.

    ``rules``: ``rule_host``, ``rule_path``, ``rule_verdict``. Each host is joined by its own
    name and its parent names, never with all rules.
    """
    labels = F.split("host", r"\.", -1)
    names = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels)))
    )
    text = F.concat("rule_host", "rule_path")
    each = F.struct(
        F.length(text).alias("size"),
        text.alias("rule"),
        F.col("rule_path").alias("path"),
        F.col("rule_verdict").alias("verdict"),
    )
    return (
        hosts.select("host", F.explode(names).alias("rule_host"))
        .join(rules, "rule_host")
        .groupBy("host")
        .agg(F.sort_array(F.collect_set(each), asc=False).alias("rules"))
    )


def judge(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    block_above: float = 0.5,
    z: float = 1.645,
    suffixes: DataFrame | None = None,
) -> DataFrame:
    """All rows and columns of ``pages`` with ``host``, ``path``, ``rule``, ``verdict``, ``bad_low``.

    The longest rule that fits decides (a block wins a tie), and its verdict is also the labelled outcome
    from which hosts are judged; pages without a rule are blocked if ``bad_low`` of their host
    is above ``block_above``. A null URL or one without ``://`` has an empty host and path and
    is judged like any host. Repeated pages count as often as they stand. Input columns with
    a result's name are kept as ``<name>_input``; no pages, no rows. ``suffixes``: see ``with_parents``.

    Only hosts are gathered: each page's rule is decided where the page is, and counts per host are
    added up before they are dealt out.
    """
    out = ("host", "path", "rule", "verdict", "bad_low")
    pages = step_aside(pages, (*out, "fits", "rules", "n", "bad"))
    pages = pages.withColumns({"host": host_of(col(url)), "path": path_of(col(url))})
    fits = written(fitting_rules(pages.select("host").distinct(), rules), "url-rules")
    first = F.expr("get(filter(rules, r -> startswith(path, r.path)), 0)")
    decided = F.coalesce(first["verdict"], F.lit(""))
    outcomes = (
        pages.select("host", "path")
        .join(fits, "host", "left")
        .select("host", decided.alias("verdict"))
        .groupBy("host")
        .agg(F.count_if(F.col("verdict") != "").alias("n"), F.count_if(F.col("verdict") == "block").alias("bad"))
    )
    judged = reputation(outcomes, z, suffixes).select("host", "bad_low").join(fits, "host", "left")
    held = F.when(F.col("bad_low") > block_above, F.lit("block")).otherwise("allow")
    return (
        pages.join(written(judged, "url-hosts"), "host", "left")
        .withColumn("fits", first)
        .withColumn("rule", F.col("fits.rule"))
        .withColumn("verdict", F.coalesce(F.col("fits.verdict"), held))
        .drop("fits", "rules")
    )
