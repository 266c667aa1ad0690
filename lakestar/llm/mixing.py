"""Mixing sources to target weights by Pareto order sampling.

A source's target of words is reached in two steps. Every document has an expected number of
copies in proportion to its weight, at most ``most``; the whole part of it is certain. The
rest is a sample without replacement with unequal inclusion probabilities: each document
draws a uniform number and is ranked by its odds divided by the odds of its inclusion
probability (Pareto sampling). Documents are taken in that order until the words that remain are
reached; one more may follow that comes nearest to what is missing then.

What decides is one row per source and weight, so documents are joined with that, and Spark need not
shuffle texts while it is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestar.llm.common import col, numbered, step_aside, written

#: Rows of one piece of a source's order; only the piece in which the words run out is sorted.
PIECE_ROWS = 4096
#: What documents of a source are ordered by.
ORDER = ("rank", "doc_id", "size", "row_no")


def draw(key: Column, seed: int = 0) -> Column:
    """A uniform number in (0, 1) from the key alone, so reruns agree; any SQL engine has md5."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def targets(sources: DataFrame, most: int = 3, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Adds ``weight`` and ``target`` to ``source``, ``source_size``, one row per source.

    Sources by code point, null last, weigh ``weights`` in turn and share all words by weight;
    none gets more than ``most`` times its size. The sources that stop there are those with the least
    size by weight, so one ordered pass finds them: no loop. Sums are whole numbers.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn % len(weights) + 1).cast("int"))
    scale = 1
    for w in weights:
        scale *= w
    order = Window.orderBy("per_weight", F.col("source").asc_nulls_last())
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    ranked = (
        sources.withColumn("weight", weight)
        .withColumn("per_weight", F.expr(f"source_size * {scale} div weight"))
        .withColumn("left", F.sum("source_size").over(every) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("left_weight", F.sum("weight").over(rest))
        .withColumn("stops", most * F.col("source_size") * F.col("left_weight") <= F.col("left") * F.col("weight"))
        # the first that does not stop, and all after it, share what is left there
        .withColumn("stops", F.min(F.col("stops").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    )
    shared_left = F.max(F.when(F.col("stops") == 0, F.col("left"))).over(every)
    shared_weight = F.max(F.when(F.col("stops") == 0, F.col("left_weight"))).over(every)
    share = (shared_left * F.col("weight")).cast("double") / shared_weight.cast("double")
    target = F.when(F.col("stops") == 1, (most * F.col("source_size")).cast("double")).otherwise(share)
    return ranked.select("source", "source_size", "weight", target.alias("target"))


def expected_copies(levels: DataFrame, most: int = 3) -> DataFrame:
    """``copies`` for each ``source`` and weight ``odds``, in proportion to it and at most ``most``.

    ``levels``: source, odds, words, target. As for the targets, those that stop at the most
    are the first in order, here by falling weight.
    """
    order = Window.partitionBy("source").orderBy(F.col("odds").desc())
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy("source")
    ranked = (
        levels.withColumn("left", F.col("target") - most * F.coalesce(F.sum("words").over(before), F.lit(0)).cast("double"))
        .withColumn("mass", F.sum(F.col("odds") * F.col("words")).over(rest).cast("double"))
        .withColumn("stops", F.col("left") * F.col("odds") >= most * F.col("mass"))
        .withColumn("stops", F.min(F.col("stops").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    )
    rate = F.max(F.when(F.col("stops") == 0, F.col("left") / F.col("mass"))).over(every)
    copies = F.when(F.col("stops") == 1, F.lit(float(most))).otherwise(F.col("odds") * rate)
    return ranked.select("source", "odds", "words", copies.alias("copies"))


def _rank(doc_id: Column, chance: Column, seed: int) -> Column:
    """Odds of the uniform number by odds of inclusion; null where nothing is left to chance."""
    u = draw(doc_id, seed)
    return F.when(chance > 0, u / (1 - u) / (chance / (1 - chance)))


def choice(rows: DataFrame, seed: int = 0, most: int = 3) -> DataFrame:
    """Per ``source`` and ``odds`` what decides about a document: it is small, whatever the corpus.

    ``source_size``, ``target``, ``whole`` copies, ``chance`` of one more; ``stop``: documents with an order
    (rank, id, size, row) before it are drawn, all if null; ``best``: the row drawn beyond it.
    ``rows``: row_no, doc_id, source, size, odds.
    """
    levels = written(
        rows.groupBy("source", "odds").agg(F.sum("size").alias("words"), F.count("*").alias("n")),
        "mix-levels",
    )
    sources = written(targets(levels.groupBy("source").agg(F.sum("words").alias("source_size")), most), "mix-sources")
    same = F.expr("source <=> s")
    filled = levels.where("words > 0").join(sources.withColumnRenamed("source", "s"), same)
    copies = expected_copies(filled.select("source", "odds", "words", "target"), most)
    whole = F.floor("copies")
    plan = written(
        copies.select("source", "odds", "words", whole.alias("whole"), (F.col("copies") - whole).alias("chance")), "mix-plan"
    )
    rows_of = levels.groupBy(F.col("source").alias("t")).agg(F.sum("n").alias("n"))
    quota = written(
        plan.groupBy("source").agg(F.sum(F.col("whole") * F.col("words")).alias("certain"), F.max("chance").alias("likely"))
        .join(sources.withColumnRenamed("source", "s"), same)
        .join(rows_of, F.expr("source <=> t"))
        .select(
            "s", "likely", (F.round("target").cast("long") - F.col("certain")).alias("quota"),
            F.ceil(F.col("n") / PIECE_ROWS).alias("pieces"),
        ),
        "mix-quota",
    )
    odds = plan.join(quota, same).select("s", F.col("odds").alias("o"), "chance", "likely", "quota", "pieces")
    scaled = F.col("rank") * F.col("likely") / (1 - F.col("likely"))
    ranked = written(
        rows.join(odds, F.expr("source <=> s and odds = o"))
        .withColumn("rank", _rank(F.col("doc_id"), F.col("chance"), seed))
        .where("rank is not null")
        .withColumn("piece", F.least(F.floor(scaled / (1 + scaled) * F.col("pieces")), F.col("pieces") - 1))
        .select("source", F.struct(*ORDER).alias("at"), "size", "piece", "quota"),
        "mix-ranks",
    )
    pieces = (
        ranked.groupBy("source", "piece", "quota").agg(F.sum("size").alias("words"))
        .withColumn("end", F.sum("words").over(Window.partitionBy("source").orderBy("piece")))
    )
    # in the first piece that ends beyond the quota the words run out
    cut = written(
        pieces.where("end > quota").groupBy(F.col("source").alias("s"))
        .agg(F.min_by(F.struct(F.col("piece").alias("last"), (F.col("end") - F.col("words")).alias("start")), "piece").alias("c"))
        .select("s", "c.*"),
        "mix-cut",
    )
    placed = ranked.join(cut, same)
    inside = Window.partitionBy("source").orderBy("at")
    late = (
        placed.where("piece = last")
        .withColumn("end", F.col("start") + F.sum("size").over(inside))
        .where("end > quota")
        .groupBy(F.col("source").alias("s"))
        .agg(F.min("at").alias("stop"), F.max(F.col("quota") - F.col("end") + F.col("size")).alias("gap"))
    )
    stops = written(late, "mix-stops")
    near = F.abs(F.col("gap") - F.col("size"))
    best = (
        ranked.join(stops, same)
        .where((F.col("at") >= F.col("stop")) & (near < F.col("gap")))
        .groupBy(F.col("source").alias("b"))
        .agg(F.min(F.struct(near, "at")).alias("best"))
        .select("b", F.col("best.at.row_no").alias("best"))
    )
    return written(
        levels.select("source", "odds")
        .join(sources.withColumnRenamed("source", "s"), same).drop("s", "weight")
        .join(plan.select(F.col("source").alias("p"), F.col("odds").alias("o"), "whole", "chance"), F.expr("source <=> p and odds = o"), "left")
        .join(stops.select("s", "stop"), same, "left")
        .join(best, F.expr("source <=> b"), "left")
        .select("source", "odds", "source_size", "target", "whole", "chance", "stop", "best"),
        "mix-choice",
    )


def mix(
    docs: DataFrame, doc_id: str = "doc_id", size: str = "size", source: str = "source",
    seed: int = 0, most: int = 3,
) -> DataFrame:
    """All rows and columns with ``source_size``, ``target`` and ``copies`` (0 to ``most``).

    ``size`` is a column of word counts, never null. A document's odds are the number of binary
    digits of its size, so long ones are somewhat likelier. A null source is a source; rows with
    the same id share their random number and are taken by size, then in the order of rows.
    Rows without words count nothing; if all of a source's shortest are without, they are taken once
    where the target is the source's size or more. An empty table gives an empty one; input
    columns with a result's name become ``<name>_input``.
    """
    out = ("source_size", "target", "copies")
    own = ("row_no", "m_source", "m_odds", "whole", "chance", "stop", "best")
    docs = step_aside(docs, (*out, *own))
    rows = numbered(docs, "mix-rows", level=9)
    digits = F.length(F.bin(col(size)))
    narrow = rows.select(
        "row_no", col(doc_id).alias("doc_id"), col(source).alias("source"), col(size).alias("size"), digits.alias("odds")
    )
    chosen = choice(narrow, seed, most).withColumnsRenamed({"source": "m_source", "odds": "m_odds"})
    rank = _rank(col(doc_id), F.col("chance"), seed)
    at = F.struct(rank.alias("rank"), col(doc_id).alias("doc_id"), col(size).alias("size"), F.col("row_no"))
    drawn = F.isnotnull(rank) & (F.isnull("stop") | (at < F.col("stop")) | F.coalesce(F.col("row_no") == F.col("best"), F.lit(False)))
    without = F.when(F.col("target") >= F.col("source_size"), 1).otherwise(0)
    copies = F.coalesce(F.col("whole") + drawn.cast("int"), without).cast("long")
    return (
        rows.join(chosen, col(source).eqNullSafe(F.col("m_source")) & (digits == F.col("m_odds")))
        .withColumn("copies", copies)
        .select(*[col(c) for c in docs.columns], *out)
    )
