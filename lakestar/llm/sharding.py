"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

A uniform permutation cut into shards sends a random number of rows from each block of the
input to each shard. Those numbers are drawn first, exactly as a permutation would give them:
the matrix has the block sizes and the shard sizes as margins and the multivariate
hypergeometric law. Then every block is permuted by itself and cut by its row of the matrix,
the pieces change places, and every shard is permuted again. No row is compared with rows
of another block before the exchange.

The matrix is drawn over a binary tree of blocks, which are numbered by all tasks together: a node
splits what its shards take between its halves. Each level is one small join, so a million blocks need twenty steps, not a million.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestar.llm.common import numbered, step_aside, uniform, written
from lakestar.operators.keys import ranked, with_dense_keys

#: Rows of one block, the unit that is permuted by one task, before and after the exchange.
BLOCK_ROWS = 4096
#: Tree levels in one plan; then the nodes are written.
LEVELS_AT_ONCE = 7


def _let(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def hypergeometric(pool: str, good: str, draws: str, u: str) -> str:
    """SQL for the number of good ones among ``draws`` from ``pool``, by inversion of ``u``.

    Weights are summed from 12 standard deviations below the mean to 12 above; what lies
    outside has less probability than one step of a 53 bit uniform number.
    """
    ratio = "((x.g - k) * (x.n - k) / ((k + 1) * (x.p - x.g - x.n + k + 1D)))"
    span = "sequence(y.a, y.b)"
    total = (
        f"aggregate({span}, named_struct('w', 1D, 's', 0D),"
        f" (z, k) -> named_struct('w', z.w * {ratio}, 's', z.s + z.w), z -> z.s)"
    )
    pick = (
        f"aggregate({span}, named_struct('w', 1D, 's', 0D, 'at', y.a), (z, k) -> named_struct("
        f"'w', z.w * {ratio}, 's', z.s + z.w, 'at', if(z.s + z.w < x.u * total, k + 1L, z.at)),"
        f" z -> least(z.at, y.b))"
    )
    spread = (
        "12 * sqrt(x.n * (x.g / x.p) * (1 - x.g / x.p) * (x.p - x.n) / greatest(x.p - 1, 1)) + 20"
    )
    window = (
        "named_struct("
        f"'a', greatest(0L, x.n + x.g - x.p, cast(floor(x.n * (x.g / x.p) - ({spread})) as bigint)),"
        f" 'b', least(x.n, x.g, cast(ceil(x.n * (x.g / x.p) + ({spread})) as bigint)))"
    )
    inner = f"if(x.p <= 0, 0L, {_let('y', window, _let('total', total, pick))})"
    given = f"named_struct('p', {pool}, 'g', {good}, 'n', {draws}, 'u', {u})"
    return _let("x", given, inner)


def split_counts(shards: int, seed: int) -> str:
    """SQL for what the left half of a node gives each shard; ``counts`` is what both give."""
    u = f"shiftrightunsigned(xxhash64({seed}L, level, node, j), 11) / {float(1 << 53)}D"
    draw = hypergeometric("acc.pool", "counts[j]", "acc.need", u)
    return (
        f"aggregate(sequence(0, {shards - 1}), named_struct('need', n_left, 'pool', n, 'out',"
        " cast(array() as array<bigint>)), (acc, j) -> aggregate("
        f"array({draw}), acc, (a, got) -> named_struct('need', a.need - got, 'pool',"
        " a.pool - counts[j], 'out', concat(a.out, array(got)))), acc -> acc.out)"
    )


def communication_matrix(blocks: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """``block``, ``counts``: how many of its rows each shard gets. ``blocks``: block, n > 0.

    Row sums are the block sizes, column sums the shard sizes, which differ by one at most.
    No blocks give an empty matrix.
    """
    spark = blocks.sparkSession
    in_order = ranked(blocks.select("block", "n"), ("block",), "shard-blocks")
    leaves = written(with_dense_keys(in_order, "leaf", start=-1), "shard-leaves")
    total, n_blocks = leaves.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    levels = max(n_blocks - 1, 0).bit_length()
    sizes = written(
        leaves.select(F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("depth"), "leaf", "n")
        .withColumn("at", F.expr(f"cast(shiftright(leaf, {levels} - depth) as int)"))
        .groupBy("depth", "at")
        .agg(F.sum("n").alias("n_left")),
        "shard-sizes",
    )
    whole = [total // shards + (j < total % shards) for j in range(shards)]
    nodes = spark.range(1).select(
        F.lit(0).alias("node"),
        F.lit(total).cast("long").alias("n"),
        F.array(*[F.lit(x).cast("long") for x in whole]).alias("counts"),
    )
    for level in range(levels):
        left = sizes.where(F.col("depth") == level + 1).where("at % 2 = 0")
        nodes = (
            nodes.join(left.select(F.expr("at div 2").cast("int").alias("node"), "n_left"), "node")
            .withColumn("level", F.lit(level))
            .withColumn("gives", F.expr(split_counts(shards, seed)))
            .select(
                F.explode(
                    F.expr(
                        "array(named_struct('node', node * 2, 'n', n_left, 'counts', gives),"
                        " named_struct('node', node * 2 + 1, 'n', n - n_left, 'counts',"
                        " zip_with(counts, gives, (a, b) -> a - b)))"
                    )
                ).alias("half")
            )
            .select("half.*")
            .where("n > 0")
        )
        if level % LEVELS_AT_ONCE == LEVELS_AT_ONCE - 1:
            nodes = written(nodes, "shard-nodes")
    return leaves.join(nodes.withColumnRenamed("node", "leaf").drop("n"), "leaf").select(
        "block", "counts"
    )


def assign(rows: DataFrame, shards: int, seed: int = 0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Shard and slot of every numbered row: ``row_no``, ``shard`` int, ``slot`` long from 0."""
    placed = rows.select("row_no").withColumn(
        "block", F.expr(f"shiftright(row_no, 33) * {(1 << 33) // block_rows + 1}L"
                        f" + (row_no & {(1 << 33) - 1}L) div {block_rows}")
    )
    sizes = placed.groupBy("block").agg(F.count("*").alias("n"))
    matrix = written(communication_matrix(sizes, shards, seed), "shard-matrix")
    order = F.xxhash64(F.lit(seed), F.lit("before"), "row_no")
    ends = F.expr("transform(counts, (x, i) -> aggregate(slice(counts, 1, i + 1), 0L, (a, b) -> a + b))")
    sent = written(
        placed.withColumn("at", F.row_number().over(Window.partitionBy("block").orderBy(order, "row_no")))
        .join(matrix.withColumn("ends", ends), "block")
        .select("row_no", F.expr("size(filter(ends, e -> e < at))").alias("shard"))
        .withColumn("u", uniform(F.lit(seed), F.lit("after"), F.col("row_no"))),
        "shard-sent",
    )
    total = sent.count()
    pieces = max(1, -(-total // (shards * block_rows)))
    sent = sent.withColumn("piece", F.floor(F.col("u") * pieces).cast("int"))
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sent.groupBy("shard", "piece")
        .agg(F.count("*").alias("n"))
        .withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .drop("n")
    )
    inside = Window.partitionBy("shard", "piece").orderBy("u", "row_no")
    return (
        sent.withColumn("at", F.row_number().over(inside))
        .join(starts, ["shard", "piece"])
        .select("row_no", "shard", (F.col("start") + F.col("at") - 1).alias("slot"))
    )


def shuffle_to_shards(
    df: DataFrame, shards: int, seed: int = 0, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """All rows and columns, with ``shard`` (0 to shards - 1) and ``slot`` (from 0, without gaps).

    Every order of the rows is equally likely; shard sizes differ by one at most. Rows are
    numbered, so nulls, empty texts and repeated rows are rows like others; an empty table
    gives an empty one. Input columns called shard or slot are kept as ``<name>_input``.
    """
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    df = step_aside(df, ("shard", "slot", "row_no"))
    rows = numbered(df, "shard-rows", level=9)
    return rows.join(assign(rows, shards, seed, block_rows), "row_no").drop("row_no")
