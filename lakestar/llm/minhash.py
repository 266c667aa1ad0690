"""Near-duplicate documents by ProbMinHash signatures of weighted word shingles.

Every shingle of a document is a Poisson process whose rate is its weight; each of its arrivals
falls into a register drawn at random. A register keeps the shingle that arrived first, so two
documents agree in a register with the probability Jaccard similarity of their weighted
shingles. Arrivals come in order of time: once a process is later than the last register filled, it
ends (early termination), so a long document costs little more than one look at each shingle.

A shingle's weight grows with its count from 1 to less than 1.24, so the weighted similarity that
candidates are drawn by is never below 1 / 1.24 of the similarity of the sets, which decides.

Registers are banded; equal bands make candidates, which are compared by their whole
shingle sets. In a bucket of a band the members are compared with a hub first, not with each other;
the hubs of the first and of the second half of the bands differ. Where a bucket still spans
several components after that, its members are compared in blocks of bounded size, every block with
every other one of the bucket in a task of its own that returns only the links that join
components. So no candidate is left out, and no pair is a row unless it is a link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import bit_map, col, in_map, numbered, row_place, row_places, step_aside, without, written
from lakestar.llm.components import components
from lakestar.llm.shingles import WordHashes, lowered_words, mixed, shingles

WORDS = 5
SIMILARITY = 0.8
#: 20 bands of 5 registers find a pair of weighted similarity 0.8 with probability 0.9996, of 0.8 / 1.24 with 0.905.
BANDS, ROWS = 20, 5
#: What repeats of a shingle add to its weight of 1, at most.
REPEATS = 0.24
#: Bands that share an order of hubs.
HUB_BANDS = 10
#: Members of a block, and bytes of their shingles, at most (a single member may be larger).
BLOCK_ROWS, BLOCK_BYTES = 400, 32 << 20
#: Shingles that are multiplied out at a time when two blocks are compared.
COLUMNS = 4096
#: Shingles that are hashed at a time.
CHUNK = 250_000


def signatures(document: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, registers: int) -> np.ndarray:
    """n x registers: the shingle that each register of each document keeps.

    ``document`` (0 to n - 1), ``shingle`` (64 bit) and ``weight`` are parallel; every document
    has a shingle.
    """
    first = np.full(n * registers, np.inf)
    keeper = np.zeros(n * registers, np.uint64)
    time, step = np.zeros(len(shingle)), 0
    while len(shingle):
        step += 1
        with np.errstate(over="ignore"):
            draw = mixed(shingle + np.uint64(step * 2) * np.uint64(0x9E3779B97F4A7C15))
            place = mixed(shingle + np.uint64(step * 2 + 1) * np.uint64(0x9E3779B97F4A7C15))
        time = time - np.log(((draw >> np.uint64(11)) + 0.5) / (1 << 53)) / weight
        at = document * registers + (place % np.uint64(registers)).astype(np.int64)
        np.minimum.at(first, at, time)
        won = time == first[at]
        keeper[at[won]] = shingle[won]
        last = first.reshape(n, registers).max(axis=1)
        going = time < last[document]
        document, shingle, weight, time = document[going], shingle[going], weight[going], time[going]
    return keeper.reshape(n, registers)


def weights(counts: np.ndarray) -> np.ndarray:
    """Of shingles that occur so often in a document.

    If all weights lie between 1 and c, the probability Jaccard of two documents is at least their
    set Jaccard / c: each common shingle contributes 1 / (sum of ratios of weights), each at most c.
    """
    return 1 + REPEATS * (1 - 1 / counts)


def _band_keys(kept: np.ndarray, bands: int) -> np.ndarray:
    n, registers = kept.shape
    parts = kept.reshape(n, bands, registers // bands)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93), (n, bands)).copy()
    with np.errstate(over="ignore"):
        for i in range(parts.shape[2]):
            out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return out.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        digests: list[bytes | None] = []
        bands: list[np.ndarray | None] = []
        chunk, members = [], []

        def flush() -> None:
            sizes = np.array([len(s) for s, _ in chunk])  # noqa: B023
            document = np.repeat(np.arange(len(chunk)), sizes)  # noqa: B023
            kept = signatures(
                document,
                np.concatenate([s for s, _ in chunk]),  # noqa: B023
                weights(np.concatenate([c for _, c in chunk])),  # noqa: B023
                len(chunk),  # noqa: B023
                BANDS * ROWS,
            )
            for i, keys in zip(members, _band_keys(kept, BANDS)):  # noqa: B023
                bands[i] = keys  # noqa: B023
            chunk.clear()  # noqa: B023
            members.clear()  # noqa: B023

        waiting = 0
        for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
            words = lowered_words(text)
            bands.append(None)
            digests.append(xxhash.xxh3_128_digest(b" ".join(words)) if words else None)
            if words:
                chunk.append(np.unique(shingles(hashes.of(words), WORDS), return_counts=True))
                members.append(i)
                waiting += len(chunk[-1][0])
                if waiting >= CHUNK:
                    flush()
                    waiting = 0
        if chunk:
            flush()
        yield pa.RecordBatch.from_arrays(
            [batch.column("row_no"), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
            ["row_no", "digest", "bands"],
        )


def _sets(batches: Iterator[pa.RecordBatch], wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The sorted distinct shingles of the texts whose row is in the map, as bytes."""
    hashes = WordHashes()
    for batch in batches:
        batch = batch.filter(pa.array(in_map(wanted, row_places(batch.column("row_no").to_numpy()))))
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        found = [np.unique(shingles(hashes.of(lowered_words(t)), WORDS)).tobytes() for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column("row_no"), pa.array(found, pa.binary())], ["row_no", "set"])


def _shared_bands(batches: Iterator[pa.RecordBatch], shared: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``rep``, ``band``, ``key`` of the bands whose key is in the map."""
    for batch in batches:
        keys = batch.column("bands").flatten().to_numpy()
        kept = np.flatnonzero(in_map(shared, keys))
        rep = batch.column("rep").to_numpy()[kept // BANDS]
        columns = [pa.array(rep), pa.array((kept % BANDS).astype(np.int32)), pa.array(keys[kept])]
        yield pa.RecordBatch.from_arrays(columns, ["rep", "band", "key"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
            p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = np.concatenate([p, q])
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            out.append(common / (len(p) + len(q) - common))
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(out, pa.float64())], ["a", "b", "similarity"]
        )


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets have that Jaccard similarity or more."""
    x = sets.select(F.col("row_no").alias("a"), F.col("set").alias("x"))
    y = sets.select(F.col("row_no").alias("b"), F.col("set").alias("y"))
    compared = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")
    return compared.mapInArrow(_compare, "a long, b long, similarity double").where(F.col("similarity") >= similarity)


def _sets_of(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``row_no``, ``set`` of the texts whose row is in ``wanted`` (row_no), and of few others.

    No text is shuffled, however many are wanted: every task has a map of the wanted rows.
    """
    sent = rows.sparkSession.sparkContext.broadcast(bit_map(wanted, row_place(F.col("row_no"))))
    found = rows.select("row_no", "text").mapInArrow(lambda batches: _sets(batches, sent.value), "row_no long, set binary")
    return written(found, "near-sets")


def common_counts(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """How many elements each of the sets ``x`` has in common with each of ``y``."""
    sizes = [len(s) for s in x] + [len(s) for s in y]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _, element = np.unique(np.concatenate([*x, *y]), return_inverse=True)
    in_x = owner < len(x)
    n = element.max() + 1
    shared = (np.bincount(element[in_x], minlength=n) > 0) & (np.bincount(element[~in_x], minlength=n) > 0)
    place = np.cumsum(shared) - 1
    kept = shared[element]
    owner, at = owner[kept], place[element[kept]]
    out = np.zeros((len(x), len(y)), np.float32)
    for low in range(0, int(shared.sum()), COLUMNS):
        here = (at >= low) & (at < low + COLUMNS)
        table = np.zeros((len(sizes), COLUMNS), np.float32)
        table[owner[here], at[here] - low] = 1
        out += table[: len(x)] @ table[len(x) :].T
    return out


def _joining(a: np.ndarray, b: np.ndarray, one: np.ndarray, other: np.ndarray) -> tuple[list[int], list[int]]:
    """Of the links a to b between labels, as many as it takes to join the labels they join."""
    parent: dict[int, int] = {}

    def top(i: int) -> int:
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    kept: tuple[list[int], list[int]] = ([], [])
    for i, j, x, y in zip(a.tolist(), b.tolist(), one.tolist(), other.tolist()):
        x, y = top(x), top(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept[0].append(min(i, j))
            kept[1].append(max(i, j))
    return kept


def _block_links(similarity: float):
    def compare(group: pa.Table) -> pa.Table:
        """Two blocks of a bucket, or one with itself."""
        block = group.column("block").to_numpy()
        rep, label = group.column("rep").to_numpy(), group.column("label").to_numpy()
        bands = np.array(group.column("bands").to_pylist(), np.int64)
        sets = [np.frombuffer(s, np.uint64) for s in group.column("set").to_pylist()]
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        x, y = np.flatnonzero(block == i), np.flatnonzero(block == j)
        links: tuple[list[int], list[int]] = ([], [])
        if len(x) and len(y):
            ask = label[x][:, None] != label[y][None, :]
            # a pair is compared in the first bucket that it shares
            ask &= (bands[x][:, None, :] == bands[y][None, :, :]).argmax(axis=2) == group.column("band")[0].as_py()
            if i == j:
                ask &= rep[x][:, None] < rep[y][None, :]
            p, q = np.flatnonzero(ask.any(axis=1)), np.flatnonzero(ask.any(axis=0))
            if len(p):
                common = common_counts([sets[k] for k in x[p]], [sets[k] for k in y[q]])
                size = np.array([len(s) for s in sets], np.float32)
                total = size[x[p]][:, None] + size[y[q]][None, :] - common
                m, n = np.nonzero(ask[np.ix_(p, q)] & (common >= np.float32(similarity) * total))
                u, v = x[p][m], y[q][n]
                links = _joining(rep[u], rep[v], label[u], label[v])
        return pa.table({"a": pa.array(links[0], pa.int64()), "b": pa.array(links[1], pa.int64())})

    return compare


def _rest_links(rest: DataFrame, sets: DataFrame, signed: DataFrame, similarity: float) -> DataFrame:
    """Links between components that share a bucket; ``rest``: key, band, rep, label; ``signed``: rep, bands."""
    wanted = written(rest.select("rep").distinct(), "near-wanted")
    known = written(
        sets.withColumnRenamed("row_no", "rep").join(wanted, "rep", "left_semi")
        .join(signed.join(wanted, "rep", "left_semi"), "rep"),
        "near-known",
    )
    size = known.select("rep", F.octet_length("set").alias("bytes"))
    blocks = written(
        rest.join(size, "rep").groupBy("key")
        .agg(F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("bytes") / BLOCK_BYTES)).cast("int").alias("blocks")),
        "near-blocks",
    )
    mine = F.pmod(F.xxhash64("rep", F.lit(7)), F.col("blocks")).cast("int")
    dealt = (
        rest.join(blocks, "key")
        .withColumn("block", mine)
        .withColumn("k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", "band", "rep", "label", "block", F.least("block", "k").alias("i"), F.greatest("block", "k").alias("j"))
    )
    return dealt.join(known, "rep").groupBy("key", "i", "j").applyInArrow(_block_links(similarity), "a long, b long")


def _ordered(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def groups(rows: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``row_no``, ``group_no``: the least row of its group, for numbered rows with a ``text``.

    Texts with the same words (A-Z lowered) are one class; classes are linked if their sets of
    five-word shingles have the similarity, and groups are what links connect. A text with less
    than five words is one shingle; one without words is a group of its own.
    """
    signed = written(rows.select("row_no", "text").mapInArrow(_sign, "row_no long, digest binary, bands array<long>"), "near-signed")
    with_words = signed.where("digest is not null")
    classes = written(
        with_words.groupBy("digest").agg(F.min("row_no").alias("rep")), "near-classes"
    )
    first = with_words.select(F.col("row_no").alias("rep"), "bands").join(classes.select("rep"), "rep", "left_semi")
    keys = first.select("rep", F.posexplode("bands").alias("band", "key"))
    turn = F.xxhash64("rep", F.floor(F.col("band") / HUB_BANDS)).alias("turn")
    buckets = written(
        keys.groupBy("key").agg(F.min(F.struct(turn, "rep")).alias("hub"), F.count("*").alias("n"))
        .where("n > 1").select("key", F.col("hub.rep").alias("hub")),
        "near-buckets",
    )
    # most keys are met once: the map leaves them out before the others are dealt out
    sent = rows.sparkSession.sparkContext.broadcast(bit_map(buckets, F.col("key")))
    shared = first.mapInArrow(lambda batches: _shared_bands(batches, sent.value), "rep long, band int, key long")
    members = written(shared.join(buckets, "key").select("key", "band", "rep", "hub"), "near-members")
    pairs = written(members.where("rep <> hub").select(*_ordered("rep", "hub")).distinct(), "near-pairs")
    sets = _sets_of(rows, members.select(F.col("rep").alias("row_no")))
    links = written(_verified(pairs, sets, similarity).select("a", "b"), "near-links")
    labels = components(links)
    own = F.coalesce("least", "rep").alias("label")
    labelled = written(
        members.join(labels, F.col("rep") == F.col("node"), "left").select("key", "band", "rep", own), "near-labelled"
    )
    spans = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("n"))
    # two members were compared with each other already: one was the hub
    open_ = written(spans.where("lo < hi and n > 2").select("key"), "near-open")
    rest = written(labelled.join(open_, "key"), "near-rest")
    found = written(_rest_links(rest, sets, first, similarity), "near-links")
    if not found.isEmpty():
        labels = components(links.unionByName(found))
    label = F.coalesce("least", "rep", "row_no").alias("group_no")
    return (
        signed.select("row_no", "digest")
        .join(classes.select("digest", "rep"), "digest", "left")
        .join(labels, F.col("rep") == F.col("node"), "left")
        .select("row_no", label)
    )


def with_groups(df: DataFrame, text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """All rows and columns with ``row_no``, ``group_no`` and ``stays``, true for one row of each group.

    Null, empty and blank texts are groups of their own, each row by itself; repeated rows are
    copies. An empty table gives an empty one. Input columns with a result's name are kept as
    ``<name>_input``.
    """
    rows = numbered(step_aside(df, ("row_no", "group_no", "stays")), "near-rows")
    found = groups(rows.select("row_no", col(text).alias("text")), similarity)
    return rows.join(written(found, "near-groups"), "row_no").withColumn("stays", F.col("row_no") == F.col("group_no"))


def one_of_each(df: DataFrame, text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """All columns of the rows that stay; edge cases as for ``with_groups``."""
    rows = numbered(step_aside(df, ("row_no",)), "near-rows", level=9)
    found = groups(rows.select("row_no", col(text).alias("text")), similarity)
    return without(rows, found.where("row_no <> group_no"), "near-dropped").drop("row_no")
