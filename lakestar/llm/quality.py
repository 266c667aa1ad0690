"""Quality rules: counts of a text, fixed limits, and robust multivariate outliers.

Per language and source the transformed statistics of the documents have a centre and a
covariance, found by minimum covariance determinant: from several robust starts, the half of
the documents that is nearest (Mahalanobis distance) gives the next mean and covariance until
their determinant falls no more (concentration steps), and the least determinant wins. A document far
from the centre is rejected.

The nearest are found without a sort: sums of the statistics and of their products are kept by
group and logarithmic distance bin, which are few, and the bins are added up from the inside. All
of it is DataFrame expressions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestar.llm.common import WORD, col, step_aside, written

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE_COUNTS = ("n_lines", "n_upper", "n_marks")
WINDOW = 8
#: Least standard deviation of each transformed statistic, in the order of ``vector``.
#: With these a share of repeated lines or words rejects by itself above 19 %, in a group where few have any.
FLOORS = (0.5, 0.1, 0.035, 0.06, 0.1, 0.1)
#: Lines and words without repeats that every document is given besides its own: one line that stands twice on
#: a short page is one event, which shows in both shares, and says little about the page.
GIVEN_LINES, GIVEN_WORDS = 10, 200
#: Concentration steps at most, and the fall of the determinant's logarithm below which they end.
STEPS = 30
TOLERANCE = 1e-3
#: What the covariance of the nearest half of a normal law, 6 statistics, is multiplied by to be the whole one's:
#: 0.5 / P(chi-square with 8 degrees of freedom < CHI_MEDIAN).
CONSISTENCY = 1.785
#: Median of the chi-square law with as many degrees of freedom as there are statistics, 6.
CHI_MEDIAN = 5.348
#: Square of the Mahalanobis distance above which a document is rejected; 99.7 % of the chi-square law is below.
CUTOFF = 20.0
#: Groups with fewer documents are judged by their whole language, languages with fewer by the base rules only.
LEAST_ROWS = 200
BINS_PER_E = 16


def _repeat_words(words: str, window: int = WINDOW) -> str:
    """SQL: words that lie in windows found twice or more in the array ``words``."""
    hashes = f"transform(sequence(1, size({words}) - {window - 1}), i -> xxhash64(slice({words}, i, {window})))"
    order = "array_sort(transform(h, (x, i) -> named_struct('x', x, 'i', i)))"
    twice = (
        "array_sort(transform(filter(s, (e, k) -> coalesce(get(s, k - 1).x = e.x, false)"
        " or coalesce(get(s, k + 1).x = e.x, false)), e -> e.i))"
    )
    covered = (
        f"aggregate({twice}, named_struct('n', 0L, 'end', 0), (a, p) -> named_struct("
        f"'n', a.n + p + {window} - greatest(p, a.end), 'end', p + {window}), a -> a.n)"
    )
    return (
        f"if(size({words}) < {window}, 0L, transform(array({hashes}), h -> if("
        f"size(array_distinct(h)) = size(h), 0L, transform(array({order}), s -> {covered})[0]))[0])"
    )


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the counts of the whole text; a null text has none. Other columns are kept.

    n_words, word_chars (code points in words), n_symbols (``#*$%&|<>``), n_dup_lines (lines with a word
    equal to an earlier one), n_repeat_words (words in windows of eight found twice or more),
    n_lines (lines with a word), n_upper (capital letters), n_marks (neither letter, digit nor space).
    """
    df = step_aside(df, (*COUNTS, *MORE_COUNTS))
    columns = df.columns
    names = {c.lower() for c in columns}
    words, lines, whole = ("w", "l", "t")
    while {words, lines, whole} & names:
        words, lines, whole = words + "_", lines + "_", whole + "_"
    found = df.withColumn(whole, F.coalesce(col(text), F.lit(""))).withColumns(
        {
            words: F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)),
            lines: F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(WORD)),
        }
    )
    only = lambda kind: F.length(F.regexp_replace(whole, kind, "")).cast("long")
    counts = {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a + F.length(w)),
        "n_symbols": only(r"[^#*$%&|<>]+"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": F.expr(_repeat_words(words)),
        "n_lines": F.size(lines).cast("long"),
        "n_upper": only(r"[^A-Z]+"),
        "n_marks": only(r"[\p{L}\p{N}\x00-\x20]+"),
    }
    return found.select(*[col(c) for c in columns], *[x.alias(c) for c, x in counts.items()])


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def vector() -> list[Column]:
    """The statistics on scales where ordinary documents lie about evenly around a centre."""

    def share(part: str, whole: str, given: int = 0) -> Column:
        return F.asin(F.sqrt(F.least(F.col(part) / F.greatest(F.col(whole) + given, F.lit(1)), F.lit(1.0))))

    return [
        F.log1p("n_words"),
        F.log(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)) + 1e-9),
        share("n_marks", "word_chars"),
        share("n_upper", "word_chars"),
        share("n_dup_lines", "n_lines", GIVEN_LINES),
        share("n_repeat_words", "n_words", GIVEN_WORDS),
    ]


def _grouped(rows: DataFrame, keys: list[str], least: int) -> DataFrame:
    """Per combination of ``keys`` the ``key`` it is judged by, null if none, and those it ``shapes``.

    Rows that are fit to estimate from count.
    """
    counts = rows.groupBy(*[col(k) for k in keys]).agg(F.sum((~F.col("base_failed")).cast("long")).alias("n"))
    language = Window.partitionBy(col(keys[0]))
    enough = F.sum("n").over(language) >= least
    own = F.to_json(F.struct(*[col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.lit(2).alias("level")))
    whole = F.to_json(F.struct(col(keys[0]).alias("k0"), F.lit(1).alias("level")))
    key = F.when(F.col("n") >= least, own).when(enough, whole)
    wanted = enough & (F.min("n").over(language) < least)
    shapes = F.filter(F.array(F.when(F.col("n") >= least, own), F.when(wanted, whole)), lambda k: k.isNotNull())
    return counts.select(*[col(k).alias(f"k{i}") for i, k in enumerate(keys)], key.alias("key"), shapes.alias("shapes"))


def _inverse_factor(moments: DataFrame, p: int, factor: float = 1.0) -> DataFrame:
    """``mean``, ``inverse``, ``log_det``: the rows of the inverse Cholesky factor of the covariance, its determinant.

    ``moments``: n, s (sums), q (sums of products of the lower triangle, row by row); other
    columns are kept. The covariance is multiplied by ``factor`` before the floors are added.
    """
    at = lambda i, j: i * (i + 1) // 2 + j
    out = moments.where("n > 0").withColumns({f"m{i}": F.col("s")[i] / F.col("n") for i in range(p)})
    for j in range(p):
        cov = lambda i: (F.col("q")[at(i, j)] / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")) * factor  # noqa: B023, E731
        rest = lambda i: sum((F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j)), F.lit(0.0))  # noqa: B023, E731
        square = F.greatest(cov(j), F.lit(0.0)) + FLOORS[j] ** 2 - rest(j)
        out = out.withColumn(f"l{j}_{j}", F.sqrt(F.greatest(square, F.lit(FLOORS[j] ** 2 / 4))))
        below = {f"l{i}_{j}": (cov(i) - rest(i)) / F.col(f"l{j}_{j}") for i in range(j + 1, p)}
        out = out.withColumns(below) if below else out
    for i in range(p):
        row = {f"v{i}_{i}": 1 / F.col(f"l{i}_{i}")}
        for j in range(i):
            found = sum((F.col(f"l{i}_{k}") * F.col(f"v{k}_{j}") for k in range(j, i)), F.lit(0.0))
            row[f"v{i}_{j}"] = -found / F.col(f"l{i}_{i}")
        out = out.withColumns(row)
    inverse = F.array(*[F.col(f"v{i}_{j}") for i in range(p) for j in range(i + 1)])
    log_det = 2 * sum((F.log(F.col(f"l{i}_{i}")) for i in range(p)), F.lit(0.0))
    mean = F.array(*[F.col(f"m{i}") for i in range(p)])
    others = [c for c in moments.columns if c not in ("n", "s", "q")]
    return out.select(*others, mean.alias("mean"), inverse.alias("inverse"), log_det.alias("log_det"))


def _square_distance(p: int) -> Column:
    """Of the array ``x`` from ``mean`` under ``inverse``."""
    away = [F.col("x")[i] - F.col("mean")[i] for i in range(p)]
    rows = [sum((F.col("inverse")[i * (i + 1) // 2 + j] * away[j] for j in range(i + 1)), F.lit(0.0)) for i in range(p)]
    return sum((r * r for r in rows), F.lit(0.0))


def _binned(rows: DataFrame, fit: DataFrame, p: int) -> DataFrame:
    """Sums by ``key``, ``start`` and distance ``bin``, with ``inside``: how many lie in nearer bins."""
    bin_ = F.floor(F.log(_square_distance(p) + 1e-6) * BINS_PER_E).alias("bin")
    x = [F.col("x")[i] for i in range(p)]
    sums = F.array(*[F.sum(a) for a in x]).alias("s")
    products = F.array(*[F.sum(x[i] * x[j]) for i in range(p) for j in range(i + 1)]).alias("q")
    binned = (
        rows.join(fit, "key").select("key", "start", "x", bin_).groupBy("key", "start", "bin").agg(F.count("*").alias("n"), sums, products)
    )
    whole = Window.partitionBy("key", "start")
    order = whole.orderBy("bin")
    return binned.withColumn("inside", F.sum("n").over(order) - F.col("n")).withColumn("all", F.sum("n").over(whole))


def _added(arrays: str, size: int) -> Column:
    return F.array(*[F.sum(F.col(arrays)[i]) for i in range(size)]).alias(arrays)


def _starts(rows: DataFrame, p: int) -> DataFrame:
    """``key``, ``start``, ``mean``, ``inverse``: three robust starts.

    Medians with quartiles, the shortest halves of each statistic, and the covariance of the
    directions from the middles of these.
    """
    points = [k / 20 for k in range(21)]
    quantiles = written(
        rows.groupBy("key").agg(*[F.percentile_approx(F.col("x")[i], points).alias(f"q{i}") for i in range(p)]), "mcd-quantiles"
    )
    short = lambda i: F.array_min(
        F.transform(
            F.sequence(F.lit(0), F.lit(10)),
            lambda k: F.struct(
                (F.get(f"q{i}", k + 10) - F.get(f"q{i}", k)).alias("width"),
                ((F.get(f"q{i}", k + 10) + F.get(f"q{i}", k)) / 2).alias("middle"),
            ),
        )
    )
    halves = quantiles.select("key", *[short(i).alias(f"h{i}") for i in range(p)])
    deviation = lambda width, i: F.sqrt((width / 1.349) ** 2 + FLOORS[i] ** 2)
    diagonal = lambda of: F.array(*[1 / of(i) if i == j else F.lit(0.0) for i in range(p) for j in range(i + 1)])
    quarters = quantiles.select(
        "key",
        F.lit(0).alias("start"),
        F.array(*[F.col(f"q{i}")[10] for i in range(p)]).alias("mean"),
        diagonal(lambda i: deviation(F.col(f"q{i}")[15] - F.col(f"q{i}")[5], i)).alias("inverse"),
    )
    shortest = written(
        halves.select(
            "key",
            F.lit(1).alias("start"),
            F.array(*[F.col(f"h{i}.middle") for i in range(p)]).alias("mean"),
            diagonal(lambda i: deviation(F.col(f"h{i}.width"), i)).alias("inverse"),
        ),
        "mcd-shortest",
    )
    norm = F.sqrt(_square_distance(p) + 1e-12)
    away = rows.join(shortest, "key").select(
        "key", F.array(*[(F.col("x")[i] - F.col("mean")[i]) / norm for i in range(p)]).alias("w")
    )
    products = F.array(*[F.sum(F.col("w")[i] * F.col("w")[j]) for i in range(p) for j in range(i + 1)])
    moments = away.groupBy("key").agg(F.count("*").alias("n"), F.array(*[F.lit(0.0)] * p).alias("s"), products.alias("q"))
    directions = (
        _inverse_factor(moments, p, float(p))
        .drop("mean", "log_det")
        .join(shortest.select("key", "mean"), "key")
        .select("key", F.lit(2).alias("start"), "mean", "inverse")
    )
    return quarters.unionByName(shortest).unionByName(directions)


def robust_fit(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """Per ``key``: ``mean``, ``inverse`` and ``scale`` of the squared distance; rows: key, x.

    Of all starts, each followed for at most ``steps`` until its determinant falls no more, the least.
    """
    p = len(FLOORS)
    half = F.floor((F.col("all") + p + 2) / 2)
    fit = written(_starts(rows, p).withColumn("log_det", F.lit(float("inf"))), "mcd-fit")
    found = []
    for _ in range(steps):
        near = _binned(rows, fit, p).where(F.col("inside") < half)
        moments = near.groupBy("key", "start").agg(F.sum("n").alias("n"), _added("s", p), _added("q", p * (p + 1) // 2))
        before = fit.select("key", "start", F.col("log_det").alias("before"))
        after = _inverse_factor(moments, p, CONSISTENCY).join(before, ["key", "start"])
        found.append(written(after.withColumn("falls", F.col("before") - F.col("log_det") > TOLERANCE), "mcd-fit"))
        fit = found[-1].where("falls").drop("before", "falls")
        if fit.isEmpty():
            break
    every = reduce(DataFrame.unionByName, found)
    least = every.groupBy("key").agg(F.min_by(F.struct("mean", "inverse", "start"), F.struct("log_det", "start")).alias("f"))
    fit = written(least.select("key", "f.*"), "mcd-fit")
    middle = _binned(rows, fit, p).where(F.col("inside") < F.col("all") / 2).groupBy("key").agg(F.max("bin").alias("bin"))
    scale = F.greatest(F.lit(1.0), F.exp((F.col("bin") + 1) / BINS_PER_E) / CHI_MEDIAN)
    return written(fit.join(middle, "key").select("key", "mean", "inverse", scale.alias("scale")), "mcd-fit")


def verdicts(
    measured: DataFrame,
    keys: tuple[str, str] = ("lang", "source"),
    cutoff: float = CUTOFF,
    least_rows: int = LEAST_ROWS,
) -> DataFrame:
    """Adds ``base_failed``, ``distance`` (squared, robust) and ``kept`` to what ``measure`` returns.

    A null language or source is a group of its own. Only rows that pass the base rules shape
    the centres; a row that fails them is not kept. Where too few rows shape a centre, ``distance``
    is null and the base rules alone decide. Repeated rows count as often as they
    stand. An empty table gives an empty one. Other columns are kept; those that bear a
    result's name as ``<name>_input``.
    """
    p = len(FLOORS)
    measured = step_aside(measured, ("base_failed", "distance", "kept", "key", "shapes", "k0", "k1", "x", "mean", "inverse", "scale"))
    kept_columns = measured.columns
    measured = written(measured.withColumn("base_failed", base_failed()), "quality-counts", level=9)
    groups = written(_grouped(measured, list(keys), least_rows), "quality-groups")
    same = [col(k).eqNullSafe(F.col(f"k{i}")) for i, k in enumerate(keys)]
    rows = measured.join(groups, same[0] & same[1]).withColumn("x", F.array(*vector()))
    shaping = rows.where(~F.col("base_failed")).select(F.explode("shapes").alias("key"), "x")
    fit = robust_fit(written(shaping, "quality-vectors"))
    judged = rows.join(fit, "key", "left").withColumn("distance", _square_distance(p) / F.col("scale"))
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff)
    return judged.select(*[col(c) for c in kept_columns], "base_failed", "distance", kept.alias("kept"))
