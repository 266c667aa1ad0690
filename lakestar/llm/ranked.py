"""Ranked lexical search by norm buckets: the best documents for each query, exact.

A document's impact vector has a coordinate for each query term it holds: the term's weight times
its saturated count. A query is the sum of the coordinates of its terms. Vectors are written in
order of length, longest first. A round reads a range of lengths; every batch of it is a bucket.
Cauchy-Schwarz, query length times the bucket's greatest length, prunes whole buckets for a
query; inside a bucket the coordinates of the query's heaviest terms, and Cauchy-Schwarz for the
others, bound each document's score. What survives is scored again in integers. The best scores
so far of a query are its threshold, carried from bucket to bucket and from round to round; once no
query can gain from shorter vectors, the rounds stop and those vectors are not read.

Queries are taken in blocks of a bounded size, each against all documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestar.llm.common import col, numbered, written

#: Bytes of query texts in one block, about: what tasks get of it is some three times as much.
BLOCK_BYTES = 8 << 20
#: Shares of the vectors that are longer than what the first rounds read down to.
ROUNDS = (0.01, 0.1)
#: Heaviest terms of a query whose coordinates bound the scores inside a bucket.
FOCUS = 4
#: Doubles in the bounds may be off by this share.
SLACK = 1 + 1e-9
#: Letters, digits and everything beyond ASCII stay, A-Z lowered; the rest parts terms.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)


def terms(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def _impact(weight: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


@dataclass
class Block:
    """Queries of one block: ``numbers`` in the table of queries, and the ``vocabulary`` numbers of the
    terms of each."""

    numbers: list[int]
    vocabulary: dict[bytes, int]
    asked: list[list[int]]


def _blocks(queries: DataFrame, block_bytes: int) -> Iterator[Block]:
    """``queries``: query_no, text. The queries of a block come to the driver."""
    size = queries.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    block = F.pmod(F.xxhash64("query_no"), F.lit(max(1, blocks)))
    for b in range(blocks):
        rows = queries.where(block == b).select("query_no", F.encode("text", "UTF-8").alias("text")).collect()
        known: dict[bytes, int] = {}
        asked = [[known.setdefault(t, len(known)) for t in dict.fromkeys(terms(bytes(r["text"])))] for r in rows]
        found = [(r["query_no"], a) for r, a in zip(rows, asked) if a]
        if found:
            yield Block([n for n, _ in found], known, [a for _, a in found])


def _counted(rows: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document with a term ``id``, ``row_no``, ``n`` (its terms), ``terms`` (numbers) and ``tf``."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            sizes, numbers, counts = [], [], []
            for text in _texts(batch):
                found = terms(text)
                held = [(known[t], n) for t, n in Counter(found).items() if t in known]
                sizes.append(len(found))
                numbers.append([t for t, _ in held])
                counts.append([n for _, n in held])
            n = pa.array(sizes, pa.int64())
            lists = [pa.array(x, pa.list_(pa.int32())) for x in (numbers, counts)]
            columns = [batch.column("id"), batch.column("row_no"), n, *lists]
            yield pa.RecordBatch.from_arrays(columns, ["id", "row_no", "n", "terms", "tf"])

    id_type = rows.schema["id"].dataType.simpleString()
    counted = rows.mapInArrow(count, f"id {id_type}, row_no long, n long, terms array<int>, tf array<int>")
    return counted.where("n > 0")


def _weights(counted: DataFrame, size: int) -> tuple[np.ndarray, int, int]:
    """Weight of each term of the vocabulary, number of documents, number of all their terms."""
    documents, total = counted.agg(F.count("*"), F.sum("n")).first()
    # one row per term of the block's vocabulary; weights are computed where the counts are
    weight = F.floor(F.lit(1000) * F.log(F.lit(2.0 * documents + 2) / (2.0 * F.col("df") + 1)))
    held = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    out = np.zeros(size, np.int64)
    for r in held.select("term", weight.alias("w")).collect():
        out[r["term"]] = r["w"]
    return out, documents, total or 0


def _vectors(counted: DataFrame, weight: np.ndarray, documents: int, total: int) -> DataFrame:
    """``id``, ``row_no``, ``m``, ``terms``, ``tf`` and ``length``, in order of length, longest first."""
    shared = counted.sparkSession.sparkContext.broadcast(weight)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            m = batch.column("m").to_numpy()
            rows, term, tf = _flat(batch)
            square = _impact(weights[term], tf, m[rows]).astype(np.float64) ** 2
            length = np.sqrt(np.bincount(rows, square, batch.num_rows))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(length)], [*batch.schema.names, "length"])

    share = F.expr(f"10 + cast((90 * n * {documents}L) div {max(1, total)}L as bigint)")
    rows = counted.where(F.size("terms") > 0).select("id", "row_no", share.alias("m"), "terms", "tf")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", length double"
    longest = rows.mapInArrow(measure, schema).where("length > 0")
    return longest.repartitionByRange(F.desc("length"), "row_no").sortWithinPartitions(F.desc("length"), "row_no")


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and count of every coordinate of a batch."""
    lists = batch.column("terms")
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    tf = batch.column("tf").flatten().to_numpy().astype(np.int64)
    return np.repeat(np.arange(batch.num_rows), sizes), lists.flatten().to_numpy(), tf


def _bucket(
    batch: pa.RecordBatch, weight: np.ndarray, asked: list[np.ndarray], least: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, row and score of the documents of one bucket that may be among the best k; raises ``least``."""
    length = batch.column("length").to_numpy()
    sizes = np.array([len(a) for a in asked])
    is_open = np.sqrt(sizes) * length.max() * SLACK >= least  # Cauchy-Schwarz: the bucket as a whole
    nothing = np.empty(0, np.int64)
    if not is_open.any():
        return nothing, nothing, nothing
    rows, term, tf = _flat(batch)
    impact = _impact(weight[term], tf, batch.column("m").to_numpy()[rows])
    order = np.argsort(term, kind="stable")
    rows, term, impact = rows[order], term[order], impact[order]
    found = []
    for q in np.flatnonzero(is_open):
        own = asked[q]
        start, stop = np.searchsorted(term, own), np.searchsorted(term, own, side="right")
        score, square = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
        for a, b in zip(start[:FOCUS], stop[:FOCUS]):
            score[rows[a:b]] += impact[a:b]
            square[rows[a:b]] += impact[a:b].astype(np.float64) ** 2
        # known coordinates, and Cauchy-Schwarz for the others
        rest = np.sqrt(max(0, len(own) - FOCUS)) * np.sqrt(np.maximum(length**2 * SLACK - square, 0))
        stays = (score + rest) * SLACK >= least[q]
        if not stays.any():
            continue
        for a, b in zip(start[FOCUS:], stop[FOCUS:]):
            mine = stays[rows[a:b]]
            score[rows[a:b][mine]] += impact[a:b][mine]
        stays &= (score > 0) & (score >= least[q])
        hits = np.flatnonzero(stays)
        if hits.size > k:
            least[q] = max(least[q], np.partition(score[hits], -k)[-k])
            hits = hits[score[hits] >= least[q]]  # ties with the k-th stay: ids decide among them
        found.append((np.full(hits.size, q), hits, score[hits]))
    if not found:
        return nothing, nothing, nothing
    return tuple(np.concatenate(x) for x in zip(*found))


def _searched(
    vectors: DataFrame, weight: np.ndarray, numbers: list[int], asked: list[list[int]], least: np.ndarray, k: int
) -> DataFrame:
    """``query_no``, ``id``, ``row_no``, ``score`` of documents that may be among a query's best k."""
    heaviest = [np.array(sorted(a, key=lambda t: (-weight[t], t)), np.int32) for a in asked]
    shared = vectors.sparkSession.sparkContext.broadcast((weight, np.array(numbers), heaviest, least))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, numbers, asked, known = shared.value
        least = known.copy()
        best = [np.empty(0, np.int64)] * len(asked)
        for batch in batches:
            if not batch.num_rows:
                continue
            query, row, score = _bucket(batch, weights, asked, least, k)
            for q in np.unique(query):
                best[q] = np.sort(np.concatenate([best[q], score[query == q]]))[-k:]
                if best[q].size == k:
                    least[q] = max(least[q], best[q][0])
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers[query]), batch.column("id").take(rows), batch.column("row_no").take(rows), pa.array(score)],
                ["query_no", "id", "row_no", "score"],
            )

    id_type = vectors.schema["id"].dataType.simpleString()
    found = vectors.mapInArrow(search, f"query_no long, id {id_type}, row_no long, score long")
    return _best(found, k)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The best k per query; Spark keeps k per query and task before it shuffles."""
    order = Window.partitionBy("query_no").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row_no")
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k)


def _ranked_block(rows: DataFrame, block: Block, k: int) -> DataFrame:
    """``query_no``, ``id``, ``row_no``, ``score``, ``rank`` for one block of queries."""
    counted = written(_counted(rows, block.vocabulary), "ranked-counts")
    weight, documents, total = _weights(counted, len(block.vocabulary))
    vectors = written(_vectors(counted, weight, documents, total), "ranked-vectors")
    bounds = vectors.select(F.percentile_approx("length", [1 - share for share in ROUNDS])).first()[0] or []
    asked = [[t for t in a if weight[t] > 0] for a in block.asked]  # the others add nothing
    least = np.zeros(len(asked), np.int64)
    reach = np.sqrt([len(a) for a in asked])
    place = {n: i for i, n in enumerate(block.numbers)}
    best, above = None, None
    for bound in [*bounds, 0.0]:
        if above is not None and not (reach * above * SLACK >= least).any():
            break  # no shorter vector can be among the best of any query
        part = vectors.where(F.col("length") >= bound)
        if above is not None:
            part = part.where(F.col("length") < above)
        found = _searched(part, weight, block.numbers, asked, least, k).drop("rank")
        best = written(_best(found if best is None else best.drop("rank").unionByName(found), k), "ranked-round")
        for r in best.groupBy("query_no").agg(F.count("*").alias("n"), F.min("score").alias("s")).collect():
            if r["n"] == k:
                least[place[r["query_no"]]] = r["s"]
        above = bound
    return best


def search(
    df: DataFrame,
    queries: DataFrame,
    k: int = 10,
    text: str = "text",
    doc_id: str = "doc_id",
    query_id: str = "item_id",
    query_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per query its ``k`` best documents: ``query_id``, ``rank`` (from 1), ``doc_id``, ``score``.

    Terms are runs of letters, digits and characters beyond ASCII, A-Z lowered. A term weighs
    floor(1000 ln((2N + 2) / (2df + 1))); a document scores the sum over the query's distinct
    terms of weight * (10**9 tf div (1000 tf + 8 m)), m = 10 + 90 n N div L, with n the
    document's terms, N the documents with a term, L all terms. Only scores above 0 are ranked;
    of equal ones the smaller document id comes first, null ids last. Documents and queries without
    terms (null, empty) are in no result; repeated rows are ranked each for itself. An empty
    table on either side gives no rows. Where both id columns have one name, or a result's, the
    document's gets underscores.
    """
    spark = df.sparkSession
    asked = numbered(queries.select(col(query_id).alias("id"), col(query_text).alias("text")), "ranked-queries", "query_no")
    rows = df.select(col(doc_id).alias("id"), col(text).alias("text")).withColumn("row_no", F.monotonically_increasing_id())
    found = None
    for block in _blocks(asked.where("text is not null"), block_bytes):
        best = _ranked_block(rows, block, k)
        found = best if found is None else found.unionByName(best)
    if found is None:
        kind = rows.schema["id"].dataType
        found = spark.createDataFrame([], f"query_no long, id {kind.simpleString()}, row_no long, score long, rank int")
    names = [_apart(query_id, ["rank", "score"])]
    names.append(_apart(doc_id, ["rank", "score", *names]))
    out = asked.select("query_no", F.col("id").alias("query")).join(found, "query_no")
    return out.select(F.col("query").alias(names[0]), "rank", F.col("id").alias(names[1]), "score")


def _apart(name: str, taken: list[str]) -> str:
    while name.lower() in [t.lower() for t in taken]:
        name += "_"
    return name
