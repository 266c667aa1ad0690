"""Lloyd's clustering sharded by dimension, exact in integers.

Vectors are cut into slabs of rows and blocks of columns. A task of a column block needs only the
centroids' slice for its columns: it computes the exact part of every squared distance that those
columns make. ``reduceByKey`` adds the blocks of a slab and takes the nearest centroid. The
assignments go back to the column blocks, and each shard sums its own columns and moves its own
slice. What the driver sees is k centroids, never rows.

The column blocks are dealt out once by slab and block; later rounds read the same shuffle files
and move assignments only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lakestar.llm.common import col, step_aside, written
from lakestar.sources.ledger import few_rows

#: Columns of one block.
BLOCK = 16
#: Numbers in one slab's matrix of distances; a slab has this many divided by k rows.
CELLS = 1 << 18
#: Components are held within this bound, so squared distances fit a long.
BOUND = 1 << 27
LONGEST = (1 << 63) - 1
RESULTS = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def whole_vector(vector: Column, dims: int) -> Column:
    """Whether a vector has exactly ``dims`` components, none null or non-finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce((F.size(vector) == dims) & F.forall(vector, finite), F.lit(False))


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` within the bound."""
    return np.clip(np.floor(x.astype(np.float64) * scale), -BOUND, BOUND).astype(np.int64)


def partial_distances(x: np.ndarray, slice_: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all centroids over one block's columns."""
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ slice_.T) + (slice_ * slice_).sum(axis=1)


def _narrow(m: np.ndarray) -> np.ndarray:
    """The same numbers, none negative, in the least type that holds them: less to shuffle."""
    most = int(m.max()) if m.size else 0
    return m.astype(np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.int64)


def _add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _narrow(a.astype(np.int64) + b)


def _slabs(rows: DataFrame, dims: int, scale: int, size: int) -> DataFrame:
    """``slab``, ``ids`` and ``blocks``: the integers of each block of columns, row by row."""
    id_type = rows.schema["id"].dataType
    ids_type = pa.list_(to_arrow_type(id_type))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
            x = integers(flat.reshape(batch.num_rows, dims), scale).astype("<i4")
            ids = batch.column("id")
            for at in range(0, batch.num_rows, size):
                part = x[at : at + size]
                blocks = [part[:, c : c + BLOCK].tobytes() for c in range(0, dims, BLOCK)]
                listed = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), ids.slice(at, size)).cast(ids_type)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), listed, pa.array([blocks], pa.list_(pa.binary()))],
                    ["slab", "ids", "blocks"],
                )
                number += 1

    return rows.mapInArrow(cut, f"slab long, ids array<{id_type.simpleString()}>, blocks array<binary>")


def _sharded(slabs: DataFrame, dims: int, parts: int) -> RDD:
    """((slab, block), matrix): each column block of a slab in a partition of its own choice."""

    def matrix(row) -> tuple[tuple[int, int], np.ndarray]:
        width = min(BLOCK, dims - row.pos * BLOCK)
        return (row.slab, row.pos), np.frombuffer(row.col, "<i4").reshape(-1, width)

    return slabs.select("slab", F.posexplode("blocks")).rdd.map(matrix).partitionBy(parts)


def _assigned(shards: RDD, slices: list[np.ndarray], parts: int, spark, label: str) -> DataFrame:
    """``slab``, ``cluster`` and ``distance`` of each of its rows."""

    def partial(cell) -> tuple[int, np.ndarray]:
        (slab, block), x = cell
        return slab, _narrow(partial_distances(x.astype(np.int64), slices[block]))

    def nearest(total: np.ndarray) -> tuple[list[int], list[int]]:
        best = total.argmin(axis=1)  # the first of equal ones
        return best.tolist(), total[np.arange(len(best)), best].tolist()

    found = shards.map(partial).reduceByKey(_add, parts).map(lambda s: (s[0], *nearest(s[1])))
    return written(spark.createDataFrame(found, "slab long, cluster array<int>, distance array<long>"), label)


def _moved(shards: RDD, assigned: DataFrame, slices: list[np.ndarray], parts: int) -> list[np.ndarray]:
    """The slices after each shard has summed its own columns; empty centroids stay."""
    k, blocks = len(slices[0]), range(len(slices))

    def deal(row) -> list:
        clusters = np.array(row.cluster, np.int32)
        return [((row.slab, b), clusters) for b in blocks]

    def sums(cell) -> tuple[int, tuple[np.ndarray, np.ndarray]]:
        (_, block), (xs, clusters) = cell
        x, cluster = next(iter(xs)), next(iter(clusters))
        total = np.zeros((k, x.shape[1]), np.int64)
        np.add.at(total, cluster, x.astype(np.int64))
        return block, (total, np.bincount(cluster, minlength=k))

    def moved(block: int, total: np.ndarray, count: np.ndarray) -> np.ndarray:
        return np.where(count[:, None] > 0, total // np.maximum(count, 1)[:, None], slices[block])

    dealt = assigned.select("slab", "cluster").rdd.flatMap(deal).partitionBy(parts)
    summed = shards.cogroup(dealt, parts).map(sums).reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1]), len(slices))
    new = summed.map(lambda s: (s[0], moved(s[0], *s[1]))).collectAsMap()  # k times dims numbers
    return [new[b] for b in blocks]


def cluster(
    df: DataFrame,
    vector: str = "embedding",
    vec_id: str = "vec_id",
    dims: int = 64,
    k: int = 40,
    rounds: int = 5,
    scale: int = 256,
    salt: str = "2",
) -> DataFrame:
    """``vec_id`` and, per kept vector, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``
    and ``centroid_sha256``; no other columns.

    Kept are vectors with exactly ``dims`` components, none null or non-finite; a component x
    counts as floor(scale * x), held within 2**27 either way. The first centroids are the k kept
    vectors with the least sha256 of ``salt:vec_id``, ordered by it; of equal hashes (repeated
    ids, or null ones, which hash as an empty id) the lesser vector comes first. Repeated rows
    are clustered each for itself; ties go to the smaller cluster number; a cluster left empty
    keeps its centroid. With fewer than k kept vectors there are as many clusters, without any the
    result is empty. Inertias beyond a long are given as the greatest one. An id column with a
    result's name becomes ``<name>_input``.
    """
    spark = df.sparkSession
    rows = df.select(col(vec_id).alias("id"), col(vector).cast("array<double>").alias("v"))
    rows = rows.where(whole_vector(F.col("v"), dims))
    name = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    first = rows.select(F.sha2(name, 256).alias("hash"), "v").orderBy("hash", "v").limit(k).collect()
    named = step_aside(rows.select(F.col("id").alias(vec_id)), RESULTS).columns[0]
    out = (
        f"`{named}` {rows.schema['id'].dataType.simpleString()}, cluster int, distance long, "
        "cluster_inertia long, inertia long, centroid_sha256 string"
    )
    if not first:
        return spark.createDataFrame([], out)
    centroids = integers(np.array([r["v"] for r in first]), scale)
    slices = [centroids[:, c : c + BLOCK] for c in range(0, dims, BLOCK)]
    slabs = written(_slabs(rows, dims, scale, max(1, CELLS // len(first))), "vector-slabs")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = _sharded(slabs, dims, parts)
    for turn in range(rounds):
        assigned = _assigned(shards, slices, parts, spark, f"vector-round-{turn}")
        slices = _moved(shards, assigned, slices, parts)
    assigned = _assigned(shards, slices, parts, spark, "vector-clusters")
    final = np.concatenate(slices, axis=1)
    hashes = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(final.tolist())]
    capped = lambda total: F.least(total, F.lit(LONGEST).cast("decimal(38,0)")).cast("long")
    one = assigned.select(F.inline(F.arrays_zip("cluster", "distance")))
    inertia = one.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(28,0)")).alias("total")).collect()  # k rows
    whole = min(LONGEST, sum(int(r["total"]) for r in inertia))
    totals = few_rows(spark, "cluster int, total decimal(38,0)", [(r["cluster"], r["total"]) for r in inertia])
    said = totals.join(few_rows(spark, "cluster int, centroid_sha256 string", hashes), "cluster")
    return (
        slabs.select("slab", "ids")
        .join(assigned, "slab")
        .select(F.inline(F.arrays_zip("ids", "cluster", "distance")))
        .join(F.broadcast(said), "cluster")
        .select(
            F.col("ids").alias(named),
            "cluster",
            "distance",
            capped(F.col("total")).alias("cluster_inertia"),
            F.lit(whole).cast("long").alias("inertia"),
            "centroid_sha256",
        )
    )
