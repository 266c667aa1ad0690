"""Language-model scores by a hierarchical Pitman-Yor model.

A token is drawn in the restaurant of the word before it, or of the start of a text. All
restaurants share one parent, whose customers are their tables, and its base is uniform over the
vocabulary and one unknown word. Words are told apart by 61 bits of a hash, pairs by 64.

Training counts how often each word follows each other. Seating is sampled by Gibbs steps on the
number of tables of each dish in each restaurant, given those of the others: up to 64 customers
from the exact law with generalised Stirling numbers, beyond by its saddle point, so the work
for a dish does not grow with its customers. A dish with one customer has one table. So only
pairs found twice or more are seated, from one table per customer at the start, and each
round goes on from the tables that the round before drew: draws depend on the pair and the
round alone, so tasks repeat them from the totals of words, and nothing is written per pair and round.
Totals are gathered between rounds, per word. Probabilities are averaged over samples of the last round.

Texts are cut into words once and written as places in the list of words of a slice of texts. A word found
once that no text asks about is in no pair that matters; it is just one that is there once. The others are
kept: the most frequent of them, in a table of bounded size that all tasks have, go by their place in it, all
others by their hashes. Pairs are counted and looked up in lists dealt to buckets; only tokens with two words that
go by hashes are joined. The most frequent pairs go to all tasks, too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from lakestar.llm.common import bit_map, col, in_map, numbered, step_aside, written
from lakestar.llm.shingles import WordHashes, lowered_words, mixed

#: The low bits of a hash are free, a power of two: the number of a word that goes by its place has the lowest set.
SALTS = 8
#: What stands for the end of a text, as a word, and for its start, as a context.
END, START = 0x5EED0E28, 0x57A27E8
CONCENTRATION = 1.0
SAMPLES = 3
#: Rounds before the one that samples are taken of.
ROUNDS = 2
#: Customers up to which the law of the tables is tabulated.
TABULATED = 64
#: At most so many of the most frequent words have their totals sent to every task (28 bytes each, 88 if they are
#: there more than 255 times; below 1 << 20), and so many of the most frequent pairs of such words their probabilities (4 MB).
HEAD_WORDS, HEAD_PAIRS = 1 << 18, 1 << 18
#: Tokens that a task counts at a time, and pairs whose tables it adds up.
CHUNK, SUMMED = 4_000_000, 1 << 20
#: Bytes of texts that are encoded at a time, and tokens that are looked up at a time.
SLICE, PART = 1 << 23, 1 << 18
#: Tokens for each bucket that pairs are counted in, and that they are looked up in, and the fewest buckets.
BUCKET, ASKED_BUCKET, LEAST_BUCKETS = 1 << 18, 1 << 21, 32
#: Rows whose sums are added up together, as a power of two.
BLOCK = 12
#: Beyond any count: tells that a word is in a text that is not learned from.
ASKED = 1 << 40
#: In place of a word that goes by its hash.
FAR = -1


def held_out(doc_id: Column) -> Column:
    """True for one document in ten, by its id; a null id counts as an empty one."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 10 == 0


def _pair(word: np.ndarray, context: np.ndarray) -> np.ndarray:
    """A hash of context and word."""
    with np.errstate(over="ignore"):
        return mixed((context ^ (context >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + word)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about a million tokens, or one text, each."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = sizes[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(sizes, before + SLICE, "right")))
            yield batch.slice(at, stop - at)
            at = stop


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where a number of an ordered array differs from the one before."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.empty(0, np.int64)


def _find(ordered: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where wanted numbers are in an ordered array, and whether they are there at all."""
    if not len(ordered):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    order = np.argsort(wanted)  # neighbours are looked up in the same part of the array
    at = np.empty(len(wanted), np.int64)
    at[order] = np.minimum(np.searchsorted(ordered, wanted[order]), len(ordered) - 1)
    return at, ordered[at] == wanted


def encoded(texts: DataFrame) -> DataFrame:
    """``texts`` in slices, written: a row has lists of the columns but the text, and the number of tokens of each text.

    ``words`` has the hashes of the slice's words, the most frequent first, ``told`` twice how often each is learned
    and whether it is in a text that is not learned from, ``tokens`` the place of each token's word among them.
    """
    names = [c for c in texts.columns if c != "text"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, end = WordHashes(), np.array([END], np.uint64)
        for batch in _slices(batches):
            found = []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                found += [known.of(lowered_words(text)), end]
            sizes = np.fromiter((len(x) + 1 for x in found[::2]), np.int32, batch.num_rows)
            word = np.concatenate(found) & np.uint64((1 << 64) - SALTS)
            learned = np.repeat(batch.column("learned").to_numpy(zero_copy_only=False), sizes)
            order = np.argsort(word)
            at = _starts(word[order])
            count = np.diff(np.append(at, len(word)))
            n = np.add.reduceat(learned[order].astype(np.int32), at)
            frequent = np.argsort(-count, kind="stable")
            place, tokens = np.empty(len(at), np.int32), np.empty(len(word), np.int32)
            place[frequent] = np.arange(len(at), dtype=np.int32)
            tokens[order] = np.repeat(place, count)
            told = (2 * n + (count > n))[frequent].astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), x) for x in (*(batch.column(c) for c in names), pa.array(sizes))]
            numbers = [pa.array([x.tobytes()], pa.binary()) for x in (word[order][at][frequent], told, tokens)]
            yield pa.RecordBatch.from_arrays([*lists, *numbers], [*names, "sizes", "words", "told", "tokens"])

    schema = StructType([StructField(c, ArrayType(texts.schema[c].dataType)) for c in names])
    for c, kind in (("sizes", ArrayType(IntegerType())), *[(c, BinaryType()) for c in ("words", "told", "tokens")]):
        schema = schema.add(c, kind)
    return written(texts.select(*names, "text").mapInArrow(work, schema), "lm-tokens")


def _numbers_of(batch: pa.RecordBatch, name: str, i: int, kind: type) -> np.ndarray:
    return np.frombuffer(batch.column(name)[i].as_py(), kind)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting, rows = [], 0

    def counted() -> pa.RecordBatch:
        word, told = (np.concatenate(x) for x in zip(*waiting))
        order = np.argsort(word)
        at, told = _starts(word[order]), told[order].astype(np.int64)
        n = np.add.reduceat(told >> 1, at) + np.maximum.reduceat(told & 1, at) * ASKED
        return pa.RecordBatch.from_arrays([pa.array(word[order][at].view(np.int64)), pa.array(n)], ["word", "n"])

    for batch in batches:
        for i in range(batch.num_rows):
            waiting.append((_numbers_of(batch, "words", i, np.uint64), _numbers_of(batch, "told", i, np.int32)))
            rows += len(waiting[-1][0])
            if rows >= CHUNK:
                yield counted()
                waiting, rows = [], 0
    if rows:
        yield counted()


@dataclass(frozen=True)
class Vocabulary:
    """``counts``: word, n, kept of all words learned. ``head``: the most frequent of the kept ones, and ``rare`` the others.

    ``rare`` is None if there are none; ``bits`` is a map of these. Kept are words that pairs are needed of.
    """

    counts: DataFrame
    head: Head
    rare: DataFrame | None
    bits: np.ndarray | None
    words: int
    tokens: int
    alone: int


def learn_words(coded: DataFrame, all_asked: bool) -> Vocabulary:
    """Count the words of the texts that are ``learned``."""
    raw = coded.select("words", "told").mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    n = F.col("n").bitwiseAND(F.lit(ASKED - 1))
    kept = F.lit(True) if all_asked else (n > 1) | (F.col("n") >= ASKED)
    counts = written(raw.where(n > 0).select("word", n.alias("n"), kept.alias("kept")), "lm-counts")
    zero = F.lit(0)
    words, tokens, ends, alone = counts.agg(
        F.count("*"), *[F.coalesce(F.sum(c), zero) for c in ("n", F.when(F.col("word") == END, F.col("n")))], F.count(F.when(~F.col("kept"), 1))
    ).first()
    followed = F.when(F.col("word") == END, 0).otherwise(F.col("n")).alias("followed")
    told = counts.where("kept").select("word", "n", followed)
    if ends:  # the start of a text is a word with no count of its own
        start = [F.lit(x).cast("long").alias(c) for x, c in ((START, "word"), (0, "n"), (ends, "followed"))]
        told = told.unionByName(counts.sparkSession.range(1, numPartitions=1).select(*start))
    frequent = _most_frequent(told, F.greatest("n", "followed"), HEAD_WORDS)
    head = Head.first(told.where(frequent))
    rare = told.where(~frequent) if words - alone + bool(ends) > len(head.word) else None
    bits = None if rare is None else bit_map(rare, F.shiftright("word", 3))
    return Vocabulary(counts, head, rare, bits, words, tokens, alone)


@dataclass(frozen=True)
class Slice:
    """Tokens of some texts: the places of word and context among ``codes`` and ``ids``.

    ``codes``: place in the head; one beyond the last of a word that is not kept: one that is there once, in a text
    learned from, or else one that is not there; FAR of one that may be kept. ``ids``: numbers of words.
    """

    rows: np.ndarray | None
    learned: np.ndarray
    sizes: np.ndarray
    at: np.ndarray
    before: np.ndarray
    codes: np.ndarray
    ids: np.ndarray


def _read(batches: Iterator[pa.RecordBatch], head: Head, bits: np.ndarray | None, start: int) -> Iterator[Slice]:
    """Slices of PART tokens, or one text, each. ``start``: place of the start of a text."""
    for batch in batches:
        for i in range(batch.num_rows):
            words = _numbers_of(batch, "words", i, np.uint64)
            found, there = _find(head.sorted, words)
            codes = np.full(len(words) + 1, len(head.word), np.int64)
            codes[:-1][there] = head.place_of_sorted[found[there]]
            if bits is not None:
                codes[:-1][~there & in_map(bits, words.view(np.int64) >> 3)] = FAR
            codes[-1] = start
            ids = np.where(codes == FAR, np.append(words, np.uint64(START)).view(np.int64), _numbers(codes))
            at = _numbers_of(batch, "tokens", i, np.int32)
            sizes = batch.column("sizes")[i].values.to_numpy()
            before = np.empty_like(at)
            before[1:] = at[:-1]
            before[np.cumsum(sizes) - sizes] = len(words)
            learned = batch.column("learned")[i].values.to_numpy(zero_copy_only=False)
            rows = batch.column("row_no")[i].values.to_numpy() if "row_no" in batch.schema.names else None
            ends = np.concatenate([[0], np.cumsum(sizes)])
            first = 0
            while first < len(sizes):
                last = max(first + 1, int(np.searchsorted(ends, ends[first] + PART, "right")) - 1)
                own, part = slice(first, last), slice(ends[first], ends[last])
                yield Slice(None if rows is None else rows[own], learned[own], sizes[own], at[part], before[part], codes, ids)
                first = last


def _numbers(place):
    """The numbers of words that go by their places."""
    return place * SALTS + 1


def _dealt(word: np.ndarray, context: np.ndarray, spread: np.ndarray | int, buckets: int) -> np.ndarray:
    """Buckets of pairs: those of a word are dealt to ``spread`` of them at most."""
    part = mixed(context.view(np.uint64)) % np.asarray(spread).astype(np.uint64)
    with np.errstate(over="ignore"):
        return (mixed(word.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + part) % np.uint64(buckets)).astype(np.int64)


def _lists_of(bucket: np.ndarray, numbers: list[np.ndarray], kind: type = np.int32) -> tuple[pa.Array, list[pa.Array]]:
    """Buckets, of an ordered array, and lists of their numbers."""
    at = _starts(bucket)
    ends = pa.array(np.append(at, len(bucket)).astype(np.int32))
    return pa.array(bucket[at].astype(kind)), [pa.ListArray.from_arrays(ends, pa.array(x)) for x in numbers]


def _flat(table: pa.Table, name: str) -> np.ndarray:
    """Lists, one after the other."""
    chunks = [c.flatten().to_numpy() for c in table.column(name).chunks]
    return np.concatenate(chunks) if chunks else np.empty(0, np.int64)


PLACES, NUMBERS = ("word", "context", "n"), ("far_word", "far_context", "far_n")


def _buckets(tokens: int, each: int) -> int:
    return max(LEAST_BUCKETS, tokens // each)


def counts(coded: DataFrame, vocabulary: Vocabulary, all_asked: bool) -> DataFrame:
    """``word``, ``context``, ``n``: one row per pair of the texts that are ``learned``, as numbers of words.

    Unless all pairs are asked for, those that are there once, and not in the texts that are not learned, are
    left out. Rows without context have of a word, in parts: how many others it follows, and after how many once
    and twice. All words that are not kept are one there.
    """
    head, other, buckets = vocabulary.head, len(vocabulary.head.word), _buckets(vocabulary.tokens, BUCKET)
    start = head.start(vocabulary.rare)
    # a word that is in many of a bucket's tokens is dealt to so many more
    spread = np.append(1 + head.n.astype(np.int64) * (16 * buckets) // max(vocabulary.tokens, 1), 1)
    shared = coded.sparkSession.sparkContext.broadcast((spread.astype(np.int32), head, vocabulary.bits))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, far, tokens = [], [], 0

        def counted() -> Iterator[pa.RecordBatch]:
            # bucket, word, context, and whether it is asked for
            key = np.sort(np.concatenate(near))
            at = _starts(key >> 1)
            n = np.add.reduceat(1 - (key & 1), at) if len(at) else at
            asked = np.append(key[at[1:] - 1], key[-1:]) & 1
            own = key[at]
            places = [((own >> s) & ((1 << 21) - 1)).astype(np.int32) for s in (22, 1)]
            yield rows(own >> 43, [*places, (2 * n + asked).astype(np.int32)], PLACES)
            word, context, bucket, asked = (np.concatenate(x) for x in zip(*far))
            if len(word):
                _, at, pair = np.unique(_pair(word.view(np.uint64), context.view(np.uint64)), return_index=True, return_inverse=True)
                n = 2 * np.bincount(pair, ~asked, len(at)) + (np.bincount(pair, asked, len(at)) > 0)
                order = np.argsort(bucket[at], kind="stable")
                yield rows(bucket[at][order], [x[at][order] for x in (word, context)] + [n[order].astype(np.int32)], NUMBERS)

        def rows(bucket: np.ndarray, numbers: list[np.ndarray], names: tuple[str, ...]) -> pa.RecordBatch:
            found, lists = _lists_of(bucket, numbers)
            listed = dict(zip(names, lists))
            none = lambda c: pa.nulls(len(found), pa.list_(pa.int64() if c in NUMBERS[:2] else pa.int32()))
            return pa.RecordBatch.from_arrays([found, *[listed.get(c, none(c)) for c in PLACES + NUMBERS]], ["bucket", *PLACES, *NUMBERS])

        spread, own_head, bits = shared.value
        for t in _read(batches, own_head, bits, start):
            learned = np.repeat(t.learned, t.sizes)
            w, c = t.codes[t.at], t.codes[t.before]
            alone = w == other
            c[alone] = other
            told = learned | ((w != other) & (c != other))  # else a word is not there, and the pair neither
            use = np.flatnonzero(told & (w != FAR) & (c != FAR))
            word, context = w[use], c[use]
            bucket = _dealt(_numbers(word), _numbers(context), spread[word], buckets)
            near.append((((bucket << 21 | word) << 21 | context) << 1) | ~learned[use])
            use = np.flatnonzero(told & ~alone & ((w == FAR) | (c == FAR)))
            many = np.where(w[use] == FAR, 1, spread[w[use]])
            word, context = t.ids[t.at[use]], t.ids[t.before[use]]
            far.append((word, context, _dealt(word, context, many, buckets), ~learned[use]))
            tokens += len(t.at)
            if tokens >= CHUNK:
                yield from counted()
                near, far, tokens = [], [], 0
        if tokens:
            yield from counted()

    def merge(table: pa.Table) -> pa.Table:
        found = []
        for names in (PLACES, NUMBERS):
            word, context, n = (_flat(table, c).astype(np.int64) for c in names)
            if not len(word):
                continue
            if names == PLACES:
                word, context = _numbers(word), _numbers(context)
                order = np.argsort(word << 22 | context >> 2)
            else:
                order = np.lexsort((context, word))
            word, context, n = word[order], context[order], n[order]
            at = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (context[1:] != context[:-1])]))
            asked = np.maximum.reduceat(n & 1, at) > 0
            word, context, n = word[at], context[at], np.add.reduceat(n >> 1, at)
            there, many = n > 0, context == _numbers(other)
            at = np.flatnonzero(there & ~many & ((n > 1) | asked | all_asked))
            found.append((word[at], context[at], np.zeros(len(at), bool), n[at], np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)))
            word, n, many = word[there], n[there], many[there]
            at = _starts(word)
            if len(at):
                kinds, one, two = (np.add.reduceat(x, at) for x in (np.where(many, n, 1), np.where(many, n, n == 1), ((n == 2) & ~many).astype(np.int64)))
                found.append((word[at], word[at], np.ones(len(at), bool), kinds, one, two))
        word, context, total, n, one, two = (np.concatenate(x) for x in zip(*found)) if found else [np.empty(0, np.int64)] * 6
        arrays = [pa.array(word), pa.array(context, mask=total.astype(bool)), *map(pa.array, (n, one, two))]
        return pa.Table.from_arrays(arrays, ["word", "context", "n", "one", "two"])

    lists = "bucket int, word array<int>, context array<int>, n array<int>, far_word array<long>, far_context array<long>, far_n array<int>"
    raw = coded.select("learned", "sizes", "words", "tokens").mapInArrow(count, lists)
    found = raw.groupBy("bucket").applyInArrow(merge, "word long, context long, n long, one long, two long")
    out = written(found, "lm-pairs")
    shared.destroy()
    return out


@dataclass(frozen=True)
class Totals:
    """``root_customers``, ``root_tables``: of the parent, one number per state that words have totals of."""

    vocabulary: int
    tokens: int
    discount: float
    root_discount: float
    root_customers: tuple[float, ...]
    root_tables: tuple[float, ...]

    def new_table(self, tables: np.ndarray) -> np.ndarray:
        """Weight of a new table in restaurants with these tables, before the parent's probability."""
        return CONCENTRATION + self.discount * tables

    def base(self, state: int) -> float:
        """Weight of one word by the uniform base alone."""
        return (CONCENTRATION + self.root_discount * self.root_tables[state]) / (self.vocabulary + 1)

    def root(self, state: int, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """The parent's probability of words with these customers and tables."""
        return (customers - self.root_discount * tables + self.base(state)) / (CONCENTRATION + self.root_customers[state])


def stirling(most: int, discount: float) -> np.ndarray:
    """Logarithms of generalised Stirling numbers: customers by tables, both from 0."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[1, 1] = 0.0
    for c in range(1, most):
        t = np.arange(1, c + 1)
        out[c + 1, 1 : c + 1] = out[c, 1 : c + 1] + np.log(c - discount * t)
        out[c + 1, 1 : c + 2] = np.logaddexp(out[c + 1, 1 : c + 2], out[c, 0 : c + 1])
    return out


def draw_tables(
    customers: np.ndarray, weight: np.ndarray, discount: float, table: np.ndarray, u: np.ndarray, v: np.ndarray
) -> np.ndarray:
    """Tables of dishes given their customers and the weight of a new table.

    The probability of t tables goes with the Stirling number times weight to the t. ``u`` and
    ``v`` are uniform numbers; ``table`` is what ``stirling`` returns.
    """
    out = np.ones(len(customers))
    small = np.flatnonzero((customers > 1) & (customers < len(table)))
    order = small[np.argsort(customers[small], kind="stable")]
    sizes, starts = np.unique(customers[order], return_index=True)
    for c, at in zip(sizes, np.split(order, starts[1:])):
        t = np.arange(1, c + 1)
        logs = table[c, 1 : c + 1] + t * np.log(weight[at])[:, None]
        sums = np.cumsum(np.exp(logs - logs.max(axis=1, keepdims=True)), axis=1)
        out[at] = 1 + (sums < (u[at] * sums[:, -1])[:, None]).sum(axis=1)
    large = np.flatnonzero(customers >= len(table))
    if len(large):
        # tables come as a Poisson number with sizes of a power law, given the sum of sizes
        c, x = customers[large].astype(float), weight[large]
        low, high = np.full(len(c), -700.0), np.zeros(len(c))  # log of y = 1 - z, where x z y^(d - 1) = c
        for _ in range(60):
            middle = (low + high) / 2
            over = np.log(x) + np.log(-np.expm1(middle)) + (discount - 1) * middle > np.log(c)
            low, high = np.where(over, middle, low), np.where(over, high, middle)
        y = np.exp(high)
        mean = x * -np.expm1(discount * high) / discount
        spread = np.sqrt(np.maximum(mean - c * y / (1 - discount * (1 - y)), 0))
        normal = np.sqrt(-2 * np.log1p(-u[large])) * np.cos(2 * np.pi * v[large])
        out[large] = np.clip(np.rint(mean + spread * normal), 1, c)
    return out


def _uniform(key: np.ndarray, step: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = mixed(mixed(key + np.uint64(step) * np.uint64(0x9E3779B97F4A7C15)) + np.uint64(0xA0761D6478BD642F))
    return (x >> np.uint64(11)) / (1 << 53)


#: What is known of a word: its count, that of the words after it, and per state the parent's customers and
#: tables of the dish, and the tables of the word's own restaurant. A word that is not kept has null for these:
#: it is one customer with one table, and its own restaurant has a table for the word after it, if there is one.
STATES = ("customers", "dish_tables", "tables")
WORDS = "word long, n long, followed long, customers array<double>, dish_tables array<double>, tables array<double>"


def _lists(array: pa.Array) -> np.ndarray:
    """Lists of one length as a table, a row per list."""
    flat = array.flatten().to_numpy()
    return flat.reshape(len(array), flat.size // max(len(array), 1))


def _slim(numbers: np.ndarray) -> np.ndarray:
    """Whole numbers in half the room, if they fit."""
    return numbers.astype(np.int32) if not numbers.size or numbers.max() < 1 << 31 else numbers.astype(np.int64)


@dataclass
class Head:
    """Totals of some words by their place, the most frequent first; tables of states by words."""

    word: np.ndarray
    n: np.ndarray
    followed: np.ndarray
    states: dict[str, np.ndarray]

    @classmethod
    def first(cls, words: DataFrame) -> Head:
        """Of words with ``n`` and ``followed`` and no states."""
        found = words.select("word", "n", "followed").toArrow()
        word, n, followed = (found.column(c).to_numpy() for c in ("word", "n", "followed"))
        order = np.lexsort((word, -np.maximum(n, followed)))
        none = {s: np.empty((0, len(word)), np.int32) for s in STATES}
        return cls(word[order].view(np.uint64), _slim(n[order]), _slim(followed[order]), none)

    @classmethod
    def of(cls, words: DataFrame) -> Head:
        """Of words with ``place`` and states."""
        table = words.toArrow().combine_chunks()
        if not table.num_rows:
            return cls(np.empty(0, np.uint64), *[np.empty(0, np.int32)] * 2, {s: np.empty((1 + ROUNDS + SAMPLES, 0), np.int32) for s in STATES})
        found = {c: pa.concat_arrays(table.column(c).chunks) for c in table.column_names}
        order = np.argsort(found["place"].to_numpy())
        states = {s: _slim(np.ascontiguousarray(_lists(found[s])[order].T)) for s in STATES}
        n, followed = (_slim(found[c].to_numpy()[order]) for c in ("n", "followed"))
        return cls(found["word"].to_numpy()[order].view(np.uint64), n, followed, states)

    def frame(self, spark: SparkSession) -> DataFrame:
        """As rows: ``place``, and the columns of WORDS."""
        lists = [pa.ListArray.from_arrays(np.arange(len(self.word) + 1, dtype=np.int32) * len(x), x.T.astype(float).ravel()) for x in (self.states[s] for s in STATES)]
        numbers = [np.arange(len(self.word), dtype=np.int32), self.word.view(np.int64), self.n.astype(np.int64), self.followed.astype(np.int64)]
        table = pa.Table.from_arrays([*map(pa.array, numbers), *lists], ["place", "word", "n", "followed", *STATES])
        return spark.createDataFrame(table, "place int, " + WORDS)

    def __getstate__(self) -> dict:
        """Numbers take a byte from the first word on that has none above 255."""
        most = np.maximum(self.n, self.followed)
        at = int(np.searchsorted(-most, -255)) if len(most) else 0
        cut = lambda x: (x[..., :at], x[..., at:].astype(np.uint8))
        return {"word": self.word, "n": cut(self.n), "followed": cut(self.followed), "states": {s: cut(x) for s, x in self.states.items()}}

    def __setstate__(self, state: dict) -> None:
        whole = lambda x: np.concatenate([x[0], x[1].astype(x[0].dtype)], axis=-1)
        self.word, self.n, self.followed = state["word"], whole(state["n"]), whole(state["followed"])
        self.states = {s: whole(x) for s, x in state["states"].items()}

    @cached_property
    def place_of_sorted(self) -> np.ndarray:
        return np.argsort(self.word).astype(np.int32)

    @cached_property
    def sorted(self) -> np.ndarray:
        return self.word[self.place_of_sorted]

    def place(self, word: int) -> int:
        """Of one word, or FAR."""
        found = np.flatnonzero(self.word == np.uint64(word))
        return int(found[0]) if len(found) else FAR

    def start(self, rare: DataFrame | None) -> int:
        """Place of the start of a text; if nothing is learned, of a word that is not there."""
        found = self.place(START)
        return found if found != FAR or rare is not None else len(self.word)

    def places(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where words are by their numbers, and whether they are there at all."""
        at = numbers >> 3
        there = (numbers & 1 == 1) & (at < len(self.word))
        return np.where(there, at, 0), there

    def hashes(self, numbers: np.ndarray) -> np.ndarray:
        out = numbers.view(np.uint64).copy()
        at, there = self.places(numbers)
        out[there] = self.word[at[there]]
        return out

    def scoring(self, t: Totals) -> Scoring:
        """What tokens score by, made once by each worker."""
        if "_scoring" not in self.__dict__:
            self._scoring = Scoring.of(self, t)
        return self._scoring


@dataclass(frozen=True)
class Scoring:
    """By place of the word or context; then of one there once that is not kept, then of one not there.

    ``shares``, ``roots``: per sample. ``back``: what one customer of a restaurant weighs.
    """

    shares: list[np.ndarray]
    roots: list[np.ndarray]
    back: np.ndarray
    base: np.ndarray
    known: np.ndarray

    @classmethod
    def of(cls, head: Head, t: Totals) -> Scoring:
        more = lambda x: np.concatenate([x, np.broadcast_to(np.array([1, 0], x.dtype), (*x.shape[:-1], 2))], axis=-1)
        n, followed = more(head.n), more(head.followed)
        customers, dish_tables, tables = (more(head.states[s]) for s in STATES)
        return cls(
            list(_shares(t, tables, followed)), list(_roots(t, customers, dish_tables)), 1 / (CONCENTRATION + followed), _base(n, t), n > 0
        )

    def parent(self, word: np.ndarray, context: np.ndarray) -> np.ndarray:
        return sum(share[context] * root[word] for share, root in zip(self.shares, self.roots))


@dataclass(frozen=True)
class Facts:
    """What is known of the words and contexts of some pairs; a word never seen has zeros."""

    n: np.ndarray
    customers: np.ndarray
    dish_tables: np.ndarray
    followed: np.ndarray
    tables: np.ndarray


def _from_head(head: Head, at_word: np.ndarray, at_context: np.ndarray) -> Facts:
    take = lambda name, at: head.states[name][:, at]
    return Facts(
        head.n[at_word], take("customers", at_word), take("dish_tables", at_word), head.followed[at_context], take("tables", at_context)
    )


def _joined_facts(batch: pa.RecordBatch, head: Head, states: int) -> Facts:
    """Facts of a batch as ``_beside`` joins them: of frequent words from the head, else from the joined columns."""
    rows = batch.num_rows

    def facts(side: str, counted: str, names: list[str]) -> list[np.ndarray]:
        at, there = head.places(batch.column(side).to_numpy())
        own = batch.column(f"{side}_{counted}")
        found = own.is_valid().to_numpy(zero_copy_only=False)
        number = np.zeros(rows, np.int64)
        number[there] = getattr(head, counted)[at[there]]
        number[found] = own.drop_null().to_numpy()
        out = [number]
        for name in names:
            x = np.zeros((states, rows))
            if there.any():
                x[:, there] = head.states[name][:, at[there]]
            lists = batch.column(f"{side}_{name}")
            listed = lists.is_valid().to_numpy(zero_copy_only=False)
            if listed.any():
                x[:, listed] = _lists(lists.drop_null()).T
            x[:, found & ~listed] = number[found & ~listed]
            out.append(x)
        return out

    return Facts(*facts("word", "n", ["customers", "dish_tables"]), *facts("context", "followed", ["tables"]))


def _places_to_join(number: np.ndarray) -> pa.Array:
    """The word to be joined, or, where it goes by its place, a number that is no word and few other rows'."""
    return pa.array(np.where(number & 1 == 1, np.arange(len(number)) * 2 + 1, number))


def _beside(rows: DataFrame, words: DataFrame) -> DataFrame:
    """Rows of words and contexts that the head lacks, with what ``words`` has of them beside them."""
    w = words.select(F.col("word").alias("word_at"), *[F.col(c).alias(f"word_{c}") for c in ("n", "customers", "dish_tables")])
    c = words.select(F.col("word").alias("context_at"), *[F.col(c).alias(f"context_{c}") for c in ("followed", "tables")])
    return rows.join(w, "word_at", "left").join(c, "context_at", "left").drop("word_at", "context_at")


def _over_pairs(
    pairs: DataFrame, rare: DataFrame | None, head, states: int, work: Callable[[Iterator], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``work`` on (word, context, key, n, Facts) of all pairs: of those with two frequent words where they are, others after joins."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for batch in batches:
                if batch.num_rows:
                    word, context = (batch.column(c).to_numpy() for c in ("word", "context"))
                    a, b = word >> 3, context >> 3
                    h = head.value
                    yield word, context, _pair(h.word[a], h.word[b]), batch.column("n").to_numpy(), _from_head(h, a, b)

        yield from work(found())

    def far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, context = (batch.column(c).to_numpy() for c in ("word", "context"))
            places = [_places_to_join(word), _places_to_join(context)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *places], [*batch.schema.names, "word_at", "context_at"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for batch in batches:
                if batch.num_rows:
                    word, context = (batch.column(c).to_numpy() for c in ("word", "context"))
                    key = _pair(head.value.hashes(word), head.value.hashes(context))
                    yield word, context, key, batch.column("n").to_numpy(), _joined_facts(batch, head.value, states)

        yield from work(found())

    both = _both_placed()
    pairs = pairs.select("word", "context", "n")
    if rare is None:
        return pairs.mapInArrow(near, schema)
    rest = pairs.where(~both).mapInArrow(far, "word long, context long, n long, word_at long, context_at long")
    return pairs.where(both).mapInArrow(near, schema).unionByName(_beside(rest, rare).mapInArrow(joined, schema))


def _placed(number: str) -> Column:
    """Whether a word goes by its place."""
    return F.col(number).bitwiseAND(F.lit(1)) == 1


def _both_placed() -> Column:
    return _placed("word") & _placed("context")


def _seated(key: np.ndarray, n: np.ndarray, facts: Facts, totals: Totals, leaf: np.ndarray, draws: int):
    """Tables of pairs: the last ``draws`` of the chain that goes through all rounds up to the totals at hand."""
    t = n.astype(float)
    rounds = len(totals.root_customers)
    for state in range(rounds):
        # the first table of a dish is there; what is drawn are further ones, given the other customers
        others = np.maximum(facts.customers[state] - t, 0) + 1
        p = totals.root(state, others, np.minimum(facts.dish_tables[state], others))
        weight = totals.new_table(facts.tables[state]) * p
        drawn = []
        for i in range(draws if state == rounds - 1 else 1):
            step = 2 * ((state << 8) + i)
            drawn.append(draw_tables(n, weight, totals.discount, leaf, _uniform(key, step), _uniform(key, step + 1)))
        t = drawn[-1]
    return drawn


def _first(pairs: DataFrame, vocabulary: Vocabulary) -> Totals:
    """Discounts from how many dishes have one and two customers."""
    other = int(_numbers(len(vocabulary.head.word)))  # each of the words that are not kept follows one other
    found = pairs.where(F.isnull("context")).groupBy("word").agg(*[F.sum(c).alias(c) for c in ("n", "one", "two")])
    share = lambda one, two: min(max(one / (one + 2 * two), 0.05), 0.95) if one + two else 0.5
    own, zero = F.col("word") != other, F.lit(0)
    one, two, lone, root1, root2 = found.agg(
        *[F.coalesce(F.sum(c), zero) for c in ("one", "two", F.when(~own, F.col("n")))],
        F.count(F.when(own & (F.col("n") == 1), 1)),
        F.count(F.when(own & (F.col("n") == 2), 1)),
    ).first()
    return Totals(vocabulary.words, vocabulary.tokens, share(one, two), share(root1 + lone, root2), (), ())


def _drawn(key: np.ndarray, customers: np.ndarray, weight: float, discount: float, table: np.ndarray, state: int) -> np.ndarray:
    """The parent's tables of dishes given their customers."""
    u, v = (_uniform(key, (1 << 20) + 2 * state + j) for j in (0, 1))
    return np.where(customers > 0, draw_tables(customers, np.full(len(customers), weight), discount, table, u, v), 0)


def _dish_tables(words: DataFrame, totals: Totals, weights: list[float], state: int) -> DataFrame:
    """The parent's tables of each dish, given its customers, for as many states as there are weights, from ``state`` on."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = stirling(TABULATED, totals.root_discount)
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column("word").to_numpy().view(np.uint64)
            customers = _lists(batch.column("customers"))
            known = _lists(batch.column("dish_tables"))
            states = [(w, state + i) for i, w in enumerate(weights)]
            fresh = [_drawn(key, customers[:, s].astype(np.int64), w, totals.root_discount, table, s) for w, s in states]
            drawn = np.hstack([known, np.stack(fresh, 1)])
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * drawn.shape[1])
            at = batch.schema.get_field_index("dish_tables")
            yield batch.set_column(at, "dish_tables", pa.ListArray.from_arrays(offsets, pa.array(drawn.ravel())))

    return words.mapInArrow(draw, WORDS)


def _listed(words: DataFrame, states: int) -> DataFrame:
    """Words whose customers and tables were the same in all states so far."""
    lists = [F.array_repeat(F.col(n).cast("double"), states).alias(c) for c, n in (("customers", "n"), ("tables", "followed"))]
    return words.select("word", "n", "followed", lists[0], F.array().cast("array<double>").alias("dish_tables"), lists[1])


@dataclass(frozen=True)
class Seats:
    """Totals of all words: of those in the head, of the rare ones, and of all together.

    ``moving``: rare words in a pair that is seated, as WORDS says; the totals of ``still`` ones change in nothing but
    the parent's tables, which go by the ``weights`` of the states. Both are None if no word is rare.
    """

    head: Head
    moving: DataFrame | None
    still: DataFrame | None
    totals: Totals
    alone: int
    weights: tuple[float, ...] = ()

    def with_state(self, customers: np.ndarray, tables: np.ndarray, moving: DataFrame | None) -> Seats:
        """With new states: of the head's words the customers and tables, a row per state, of the moving ones in their lists."""
        t, old, draws = self.totals, len(self.totals.root_customers), len(customers)
        # the uniform base weighs as the state before had it; at first, every dish has one table
        before = t.root_tables[-1] if old else float(t.vocabulary)
        weight = (CONCENTRATION + t.root_discount * before) / (t.vocabulary + 1)
        table = stirling(TABULATED, t.root_discount)
        dishes = np.stack([_drawn(self.head.word, c, weight, t.root_discount, table, old + i) for i, c in enumerate(customers)])
        fresh = dict(zip(STATES, (customers, dishes, tables)))
        states = {s: _slim(np.concatenate([x, fresh[s].astype(np.int64)])) for s, x in self.head.states.items()}
        # a word that is not kept is one customer with one table
        sums = [[float(x.sum()) + self.alone for x in rows] for rows in (customers, dishes)]
        fresh_weights = [weight] * draws
        if moving is not None:
            moving = written(_dish_tables(moving, t, fresh_weights, old), "lm-words")
            still = _dish_tables(_listed(self.still, old + draws), t, fresh_weights, old)
            for words, first in ((moving, old), (still, 0)):
                found = [F.col("customers")[old + i] for i in range(draws)] + [F.col("dish_tables")[first + i] for i in range(draws)]
                more = words.agg(*[F.coalesce(F.sum(c), F.lit(0.0)) for c in found]).first()
                sums = [[x + more[k * draws + i] for i, x in enumerate(s)] for k, s in enumerate(sums)]
        totals = replace(t, root_customers=(*t.root_customers, *sums[0]), root_tables=(*t.root_tables, *sums[1]))
        return replace(
            self, head=replace(self.head, states=states), moving=moving, totals=totals, weights=(*self.weights, *fresh_weights)
        )

    def rare(self) -> DataFrame | None:
        """Words that are not in the head, as WORDS says."""
        if self.moving is None:
            return None
        still = _dish_tables(_listed(self.still, len(self.weights)), self.totals, list(self.weights), 0)
        return written(self.moving.unionByName(still), "lm-words")


def _round(pairs: DataFrame, seats: Seats, draws: int) -> Seats:
    """Seat all pairs given the totals at hand; totals with the states that the draws give."""
    totals, head = seats.totals, seats.head
    shared = pairs.sparkSession.sparkContext.broadcast(head)
    names = [f"{side}{i}" for side in "dt" for i in range(draws)]

    def sums(found) -> Iterator[pa.RecordBatch]:
        leaf, waiting, rows = stirling(TABULATED, totals.discount), [], 0

        def added() -> pa.RecordBatch:
            word, at = np.unique(np.concatenate([w for w, *_ in waiting] + [c for _, c, _ in waiting]), return_inverse=True)
            less = np.hstack([l for *_, l in waiting])
            half = less.shape[1]
            total = [np.bincount(at[:half], l, len(word)) for l in less] + [np.bincount(at[half:], l, len(word)) for l in less]
            return pa.RecordBatch.from_arrays([pa.array(word), *(pa.array(x.astype(np.int64)) for x in total)], ["word", *names])

        for word, context, key, n, facts in found:
            waiting.append((word, context, np.stack(_seated(key, n, facts, totals, leaf, draws)) - n))
            rows += len(word)
            if rows >= SUMMED:
                yield added()
                waiting, rows = [], 0
        if rows:
            yield added()

    schema = "word long, " + ", ".join(f"{n} long" for n in names)
    work = _over_pairs(pairs, seats.moving, shared, len(totals.root_customers), sums, schema)
    found = work.groupBy("word").agg(*[F.sum(n).alias(n) for n in names])
    if seats.moving is not None:
        found = written(found, "lm-sums")
    own = found.where(_placed("word")).toArrow()
    at = own.column("word").to_numpy() >> 3
    base = {"d": head.n, "t": head.followed}
    fresh = {side: np.tile(x.astype(np.int64), (draws, 1)) for side, x in base.items()}
    for name in names:
        fresh[name[0]][int(name[1:]), at] += own.column(name).to_numpy()
    moving = seats.moving
    if moving is not None:
        more = lambda side, base: F.array(*[(F.col(base) + F.coalesce(f"{side}{i}", F.lit(0))).cast("double") for i in range(draws)])
        moving = moving.join(found.where(~_placed("word")), "word", "left").select(
            "word", "n", "followed",
            F.concat("customers", more("d", "n")).alias("customers"),
            "dish_tables",
            F.concat("tables", more("t", "followed")).alias("tables"),
        )
    out = seats.with_state(fresh["d"], fresh["t"], moving)
    shared.destroy()
    return out


@dataclass(frozen=True)
class Model:
    """``head``, ``rare``: the words, the last SAMPLES states being samples. ``pairs``: word, context, n, as numbers of words.

    ``lone``: the words that are not kept. ``pairs`` has all that occur twice or more, and of
    the others those that were asked for. ``bits`` is a map of the rare words.
    """

    head: Head
    rare: DataFrame | None
    lone: DataFrame
    bits: np.ndarray | None
    pairs: DataFrame
    totals: Totals

    @property
    def words(self) -> DataFrame:
        """All words as WORDS says, with their ``place`` in the head, or null."""
        nowhere = F.lit(None).cast("int").alias("place")
        followed = F.when(F.col("word") == END, 0).otherwise(F.col("n")).alias("followed")
        still = self.lone.select(nowhere, "word", "n", followed, *[F.lit(None).cast("array<double>").alias(c) for c in STATES])
        out = self.head.frame(self.lone.sparkSession).unionByName(still)
        return out if self.rare is None else out.unionByName(self.rare.select(nowhere, "*"))

    @property
    def frequent(self) -> Column:
        """Tells the words that every task has."""
        return F.col("place").isNotNull()


def fit(texts: DataFrame) -> Model:
    """Learn from the column ``text``; a null or empty text is just an end.

    With a column ``learned``, only rows where it is true teach, and the model is good for scoring
    these rows, with that column. Without it, the model is good for any.
    """
    told = "learned" in texts.columns
    return _fitted(encoded(texts.select("text", "learned" if told else F.lit(True).alias("learned"))), all_asked=not told)


def _fitted(coded: DataFrame, all_asked: bool) -> Model:
    """Learn from texts that are encoded."""
    vocabulary = learn_words(coded, all_asked)
    found = counts(coded, vocabulary, all_asked)
    pairs = found.where(F.col("context").isNotNull()).select("word", "context", "n")
    twice, moving, still = pairs.where("n > 1"), None, None
    if vocabulary.rare is not None:
        ends = twice.where(~_both_placed()).select(F.explode(F.array("word", "context")).alias("word")).where(~_placed("word"))
        told = vocabulary.rare.join(ends.distinct().withColumn("moves", F.lit(True)), "word", "left")
        told = written(told.select("word", "n", "followed", "moves"), "lm-rare")
        moving, still = _listed(told.where("moves"), 1), told.where("moves is null")
    seats = Seats(vocabulary.head, None, still, _first(found, vocabulary), vocabulary.alone)
    seats = seats.with_state(*(x.astype(np.int64)[None] for x in (vocabulary.head.n, vocabulary.head.followed)), moving)
    for draws in [1] * ROUNDS + [SAMPLES]:
        seats = _round(twice, seats, draws)
    return Model(seats.head, seats.rare(), vocabulary.counts.where(~F.col("kept")), vocabulary.bits, pairs, seats.totals)


def _most_frequent(rows: DataFrame, n: Column, most: int) -> Column:
    """Whether a row's count is so high that there are at most ``most`` of such rows.

    Counts are binned by their logarithm, so the driver gets a few hundred numbers to set the bound by.
    """
    bin_ = F.floor(F.log2(n) * 8)
    found = rows.groupBy(bin_.alias("bin")).agg(F.count("*").alias("rows")).collect()
    bound, total = None, 0
    for r in sorted(found, key=lambda r: -r["bin"]):
        total += r["rows"]
        if total > most:
            break
        bound = r["bin"]
    return bin_ >= bound if bound is not None else F.lit(False)


def _samples(t: Totals) -> range:
    return range(len(t.root_customers) - SAMPLES, len(t.root_customers))


def _shares(t: Totals, tables: np.ndarray, followed: np.ndarray) -> np.ndarray:
    """What restaurants leave to the parent, per sample; divided by the number of samples."""
    return np.stack([t.new_table(tables[s]) / (CONCENTRATION + followed) / SAMPLES for s in _samples(t)])


def _roots(t: Totals, customers: np.ndarray, dish_tables: np.ndarray) -> np.ndarray:
    """The parent's probability of words, per sample."""
    return np.stack([t.root(s, customers[s], dish_tables[s]) for s in _samples(t)])


def _parent(facts: Facts, t: Totals) -> np.ndarray:
    """The parent's share of the probability of words in contexts, averaged over samples."""
    return (_shares(t, facts.tables, facts.followed) * _roots(t, facts.customers, facts.dish_tables)).sum(axis=0)


def _base(n: np.ndarray, t: Totals) -> np.ndarray:
    return np.log10((n + 0.1) / (t.tokens + 0.1 * (t.vocabulary + 1)))


def _dishes(key: np.ndarray, n: np.ndarray, facts: Facts, t: Totals, leaf: np.ndarray) -> np.ndarray:
    """Customers of dishes less the discount for their tables, averaged over samples."""
    seated = replace(t, root_customers=t.root_customers[: 1 + ROUNDS], root_tables=t.root_tables[: 1 + ROUNDS])
    return n - t.discount * np.mean(_seated(key, n, facts, seated, leaf, SAMPLES), axis=0)


def _gains(model: Model, pairs: DataFrame, head) -> DataFrame:
    """``key``, ``dish``, ``unseen``, ``single``: what log10 of a pair's probability is above that of the pair not seen, and seen once."""
    t = model.totals

    def work(found) -> Iterator[pa.RecordBatch]:
        leaf = stirling(TABULATED, t.discount)
        for _, _, key, n, facts in found:
            parent, dish = _parent(facts, t), _dishes(key, n, facts, t, leaf)
            whole = np.log10(parent + dish / (CONCENTRATION + facts.followed))
            single = whole - np.log10(parent + (1 - t.discount) / (CONCENTRATION + facts.followed))
            arrays = [key.view(np.int64), dish, whole - np.log10(parent), single]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["key", "dish", "unseen", "single"])

    schema = "key long, dish double, unseen double, single double"
    return _over_pairs(pairs, model.rare, head, len(t.root_customers), work, schema)


def score(rows: DataFrame, model: Model) -> DataFrame:
    """``row_no``, ``n_tokens``, ``n_known``, ``base_score``, ``score`` of numbered rows with a ``text``.

    Rows may have a column ``learned``, which is true for those the model learned from: their pairs are all known.
    Others need a model that was asked for them, or for any.
    """
    learned = "learned" if "learned" in rows.columns else F.lit(False).alias("learned")
    return _scored(encoded(rows.select("row_no", learned, "text")), model)


def _scored(coded: DataFrame, model: Model) -> DataFrame:
    """Scores of texts that are encoded.

    The dish of a token's pair is at hand for the most frequent pairs. Others score as if the pair had been
    seen once (in rows learned from) or never; what is more is found by the pair, in its bucket. A
    token with one word that goes by its hash is scored in the bucket of this word, with two by joins.
    """
    t, context = model.totals, coded.sparkSession.sparkContext
    other, start, buckets = len(model.head.word), model.head.start(model.rare), _buckets(t.tokens, ASKED_BUCKET)
    states = len(t.root_customers)
    words, bits = context.broadcast(model.head), context.broadcast(model.bits)
    often = _both_placed() & _most_frequent(model.pairs.where(_both_placed()), F.col("n"), HEAD_PAIRS)
    table = _gains(replace(model, rare=None), model.pairs.where(often), words).select("key", "dish").toArrow()
    key, dish = table.column("key").to_numpy().view(np.uint64), table.column("dish").to_numpy()
    order = np.argsort(key)
    most = context.broadcast((key[order], dish[order]))
    others = model.pairs.where(~often)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, before = (words.value.hashes(batch.column(c).to_numpy()) for c in ("word", "context"))
            yield pa.RecordBatch.from_arrays([pa.array(_pair(word, before).view(np.int64))], ["key"])

    near = others.where(_both_placed()).select("word", "context")
    at_all = context.broadcast(bit_map(near.mapInArrow(keys, "key long"), F.col("key")))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = words.value.scoring(t)
        hashes = words.value.word
        for x in _read(batches, words.value, bits.value, start):
            rows, learned = x.rows, x.learned
            owner = np.repeat(np.arange(len(rows)), x.sizes)
            w, c = x.codes[x.at], x.codes[x.before]
            far = w == FAR, c == FAR
            here = np.flatnonzero(~far[0] & ~far[1])
            w, c, own = w[here], c[here], owner[here]
            teaches = learned[own]
            kept = np.flatnonzero((w < other) & (c < other))
            key = _pair(hashes[w[kept]], hashes[c[kept]])
            at, there = _find(most.value[0], key)
            dish = np.where(teaches, 1 - t.discount, 0.0)
            dish[kept[there]] = most.value[1][at[there]]
            w, c = (code + ((code == other) & ~teaches) for code in (w, c))
            s = np.log10(by.parent(w, c) + dish * by.back[c])
            sums = [np.bincount(own, v, len(rows)).astype(float) for v in (by.known[w], by.base[w], s)]
            bucket = np.full(len(rows), int(rows[0]) % buckets)
            yield listed(bucket, [rows, x.sizes, sums[0].astype(np.int64), *sums[1:]], SUMS, LEFT)
            rest = kept[~there & in_map(at_all.value, key.view(np.int64))]
            bucket = _dealt(_numbers(w[rest]), _numbers(c[rest]), buckets, buckets)
            yield listed(bucket, [w[rest], c[rest], rows[own[rest]], teaches[rest]], ASKS, LEFT)
            one = np.flatnonzero(far[0] != far[1])
            numbers, own = [x.ids[x.at[one]], x.ids[x.before[one]]], owner[one]
            yield listed(_dealt_far(*numbers, buckets), [*numbers, rows[own], learned[own]], FAR_ASKS, LEFT)

    def dealt_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, before, n = (batch.column(c).to_numpy() for c in ("word", "context", "n"))
            both = word & before & 1 == 1
            numbers = [x[both] for x in (word, before, n)]
            bucket = _dealt(*numbers[:2], buckets, buckets)
            yield listed(bucket, [numbers[0] >> 3, numbers[1] >> 3, numbers[2]], PAIRS, RIGHT)
            numbers = [x[~both & ((word | before) & 1 == 1)] for x in (word, before, n)]
            yield listed(_dealt_far(*numbers[:2], buckets), numbers, FAR_PAIRS, RIGHT)

    def dealt_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, n, followed = (batch.column(c).to_numpy() for c in ("word", "n", "followed"))
            lists = [_lists(batch.column(c)).astype(np.int64)[:, s] for c in STATES for s in range(states)] if batch.num_rows else []
            if lists:
                yield listed(_dealt(word, word, 1, buckets), [word, n, followed, *lists], RARE, RIGHT)

    def listed(bucket: np.ndarray, numbers: list[np.ndarray], names: dict[str, pa.DataType], of: dict[str, pa.DataType]) -> pa.RecordBatch:
        order = np.argsort(bucket, kind="stable")
        found, arrays = _lists_of(bucket[order], [x[order].astype(kind.to_pandas_dtype()) for x, kind in zip(numbers, names.values())])
        own = dict(zip(names, arrays))
        return pa.RecordBatch.from_arrays([found, *[own.get(c, pa.nulls(len(found), pa.list_(kind))) for c, kind in of.items()]], ["bucket", *of])

    def answered(asks: pa.Table, pairs: pa.Table) -> pa.Table:
        found = [[_flat(asks, c) for c in SUMS], _more_of_pairs(asks, pairs, words.value, t), _far_tokens(asks, pairs, words.value, t, RARE)]
        rows, *sums = (np.concatenate(x) for x in zip(*found))
        own, at = np.unique(rows, return_inverse=True)
        sums = [np.bincount(at, x, len(own)) for x in sums]
        blocks, lists = _lists_of(own >> BLOCK, [x.astype(kind.to_pandas_dtype()) for x, kind in zip([own, *sums], SUMS.values())], np.int64)
        return pa.Table.from_arrays([blocks, *lists], ["block", *SUMS])

    def added(table: pa.Table) -> pa.Table:
        rows, *sums = (_flat(table, c) for c in SUMS)
        own, at = np.unique(rows, return_inverse=True)
        sums = [np.bincount(at, x, len(own)).astype(kind.to_pandas_dtype()) for x, kind in zip(sums, list(SUMS.values())[1:])]
        return pa.Table.from_arrays([pa.array(x) for x in (own, *sums)], ["row_no", *OUT])

    RARE = {"rare": pa.int64(), "n": pa.int64(), "followed": pa.int64()} | {f"{c}{s}": pa.int64() for c in STATES for s in range(states)}
    RARE = {f"rare_{c}": kind for c, kind in RARE.items()}
    LEFT, RIGHT = SUMS | ASKS | FAR_ASKS, PAIRS | FAR_PAIRS | (RARE if model.rare is not None else {})
    schema = lambda of: "".join(f", {c} array<{_SQL[kind]}>" for c, kind in of.items())
    asks = coded.select("row_no", "learned", "sizes", "words", "tokens").mapInArrow(look_up, "bucket int" + schema(LEFT))
    dealt = others.mapInArrow(dealt_pairs, "bucket int" + schema(RIGHT))
    if model.rare is not None:
        dealt = dealt.unionByName(model.rare.mapInArrow(dealt_words, "bucket int" + schema(RIGHT)))
    found = asks.groupBy("bucket").cogroup(dealt.groupBy("bucket")).applyInArrow(answered, "block long" + schema(SUMS))
    out = "row_no long, n_tokens long, n_known long, base_score double, score double"
    found = found.groupBy("block").applyInArrow(added, out)
    if model.rare is None:
        return found
    found = found.unionByName(_far_sums(coded, model, words, bits, others))
    return found.groupBy("row_no").agg(*[F.sum(c).alias(c) for c in OUT])


#: Sums of rows; tokens and pairs of words that go by their places, and with one that goes by its hash.
OUT = ("n_tokens", "n_known", "base_score", "score")
SUMS = {"row": pa.int64(), "tokens": pa.int64(), "known": pa.int64(), "base": pa.float64(), "s": pa.float64()}
ASKS = {"word": pa.int32(), "context": pa.int32(), "asker": pa.int64(), "teaches": pa.int32()}
FAR_ASKS = {"far_word": pa.int64(), "far_context": pa.int64(), "far_asker": pa.int64(), "far_teaches": pa.int32()}
PAIRS = {"word": pa.int32(), "context": pa.int32(), "n": pa.int64()}
FAR_PAIRS = {"far_word": pa.int64(), "far_context": pa.int64(), "far_n": pa.int64()}
_SQL = {pa.int32(): "int", pa.int64(): "long", pa.float64(): "double"}


def _dealt_far(word: np.ndarray, context: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of pairs with one word that goes by its hash: those of the word."""
    far = np.where(word & 1 == 0, word, context)
    return _dealt(far, far, 1, buckets)


def _more_of_pairs(asks: pa.Table, pairs: pa.Table, head: Head, t: Totals) -> list[np.ndarray]:
    """Sums of rows: what tokens score above what was summed for them, by their pairs in the bucket."""
    w, c, asker, teaches = (_flat(asks, name).astype(np.int64) for name in ASKS)
    word, before, n = (_flat(pairs, name).astype(np.int64) for name in PAIRS)
    order = np.argsort(word << 21 | before)
    at, there = _find((word << 21 | before)[order], w << 21 | c)
    # only pairs that are asked for are seated
    wanted, back = np.unique(order[at[there]], return_inverse=True) if there.any() else [np.empty(0, np.int64)] * 2
    word, before, n, by = word[wanted], before[wanted], n[wanted], head.scoring(t)
    key = _pair(head.word[word], head.word[before])
    dish = _dishes(key, n, _from_head(head, word, before), t, stirling(TABULATED, t.discount))
    parent, weight = by.parent(word, before), by.back[before]
    whole, single, unseen = (np.log10(parent + x * weight) for x in (dish, 1 - t.discount, 0.0))
    more = np.where(teaches[there] == 1, (whole - single)[back], (whole - unseen)[back])
    nothing = np.zeros(len(more), np.int64)
    return [asker[there], nothing, nothing, np.zeros(len(more)), more]


def _far_tokens(asks: pa.Table, pairs: pa.Table, head: Head, t: Totals, rare: dict) -> list[np.ndarray]:
    """Sums of rows of tokens with one word that goes by its hash, by the rare words and the pairs in the bucket."""
    word, before, asker, teaches = (_flat(asks, name).astype(np.int64) for name in FAR_ASKS)
    if not len(word):
        return [np.empty(0, np.int64)] * 3 + [np.empty(0)] * 2
    own, *numbers = (_flat(pairs, c) for c in rare)
    order = np.argsort(own)
    own, (n, followed, *lists) = own[order], [x[order] for x in numbers]
    size = len(lists) // len(STATES)
    customers, dish_tables, tables = (np.stack(lists[i * size :][:size]) for i in range(len(STATES)))

    def facts(word: np.ndarray, before: np.ndarray) -> Facts:
        def side(numbers: np.ndarray, *known: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
            (a, x), (b, y) = head.places(numbers), _find(own, numbers)
            out = []
            for of_head, of_rare in known:
                found = np.zeros((*of_head.shape[:-1], len(numbers)), np.int64)
                found[..., x], found[..., y] = of_head[..., a[x]], of_rare[..., b[y]]
                out.append(found)
            return out

        of_word = side(word, (head.n, n), *((head.states[s], x) for s, x in zip(STATES, (customers, dish_tables))))
        return Facts(*of_word, *side(before, (head.followed, followed), (head.states["tables"], tables)))

    key = lambda word, before: _pair(head.hashes(word), head.hashes(before))
    w, c, many = (_flat(pairs, name) for name in FAR_PAIRS)
    dishes = _dishes(key(w, c), many, facts(w, c), t, stirling(TABULATED, t.discount))
    order = np.argsort(key(w, c))
    at, there = _find(key(w, c)[order], key(word, before))
    learned = teaches == 1
    dish = np.where(learned, 1 - t.discount, 0.0)
    dish[there] = dishes[order][at[there]]
    found = _with_lone(facts(word, before), learned)
    s = np.log10(_parent(found, t) + dish / (CONCENTRATION + found.followed))
    return [asker, np.zeros(len(s), np.int64), (found.n > 0).astype(np.int64), _base(found.n, t), s]


def _with_lone(facts: Facts, learned: np.ndarray) -> Facts:
    """A word of a text learned from that has no totals is there once."""
    for first, *more in ((facts.n, facts.customers, facts.dish_tables), (facts.followed, facts.tables)):
        lone = learned & (first == 0)
        for x in (first, *more):
            x[..., lone] = 1
    return facts


def _far_sums(coded: DataFrame, model: Model, words, bits, others: DataFrame) -> DataFrame:
    """What tokens with two words that go by their hashes add to the sums of rows."""
    t, start = model.totals, model.head.start(model.rare)
    states = len(t.root_customers)

    def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _read(batches, words.value, bits.value, start):
            at = np.flatnonzero((x.codes == FAR)[x.at] & (x.codes == FAR)[x.before])
            owner = np.repeat(np.arange(len(x.rows)), x.sizes)[at]
            numbers = [x.ids[y[at]] for y in (x.at, x.before)]
            arrays = [pa.array(y) for y in (x.rows[owner], x.learned[owner], *numbers, *numbers)]
            yield pa.RecordBatch.from_arrays(arrays, ["row_no", "learned", "word", "context", "word_at", "context_at"])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                learned = batch.column("learned").to_numpy(zero_copy_only=False)
                facts = _with_lone(_joined_facts(batch, words.value, states), learned)
                s = np.log10(_parent(facts, t) + np.where(learned, 1 - t.discount, 0.0) / (CONCENTRATION + facts.followed))
                key = _pair(*(batch.column(c).to_numpy().view(np.uint64) for c in ("word", "context")))
                sums = [(facts.n > 0).astype(np.int64), _base(facts.n, t), s]
                arrays = [batch.column("row_no"), batch.column("learned"), *map(pa.array, (key.view(np.int64), *sums))]
                yield pa.RecordBatch.from_arrays(arrays, ["row_no", "learned", "key", *OUT[1:]])

    schema = "row_no long, learned boolean, word long, context long, word_at long, context_at long"
    each = coded.select("row_no", "learned", "sizes", "words", "tokens").mapInArrow(apart, schema)
    schema = "row_no long, learned boolean, key long, n_known long, base_score double, score double"
    begun = _beside(each, model.rare).mapInArrow(scored, schema)
    gains = _gains(model, others.where(~_placed("word") & ~_placed("context")), words)
    more = F.when(F.col("learned"), F.col("single")).otherwise(F.col("unseen"))
    score = (F.col("score") + F.coalesce(more, F.lit(0.0))).alias("score")
    return begun.join(gains, "key", "left").select("row_no", F.lit(0).cast("long").alias("n_tokens"), *OUT[1:3], score)


def perplexity(scored: DataFrame) -> DataFrame:
    """One row: ``perplexity`` over all tokens of rows with ``score`` and ``n_tokens``; null if none."""
    return scored.agg(F.pow(F.lit(10.0), -F.sum("score") / F.sum("n_tokens")).alias("perplexity"))


def score_documents(df: DataFrame, doc_id: str = "doc_id", text: str = "text", keep_text: bool = True) -> DataFrame:
    """All rows and columns with ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    The model learns from the rows that are not held out and scores all. A null or empty text is
    one token, its end; repeated rows teach as often as they stand. If nothing is left to learn
    from, every token is unknown. Input columns with a result's name become ``<name>_input``.

    Without ``keep_text`` the text is left out, and not written again.
    """
    out = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "row_no")
    rows = step_aside(df, out).withColumn("held_out", held_out(col(doc_id)))
    rows = numbered(rows, "lm-rows") if keep_text else rows.withColumn("row_no", F.monotonically_increasing_id())
    others = [] if keep_text else [F.struct(*[col(c) for c in rows.columns if c not in (text, "row_no")]).alias("row")]
    texts = rows.select("row_no", (~F.col("held_out")).alias("learned"), col(text).alias("text"), *others)
    coded = encoded(texts)
    model = _fitted(coded, all_asked=False)
    found = _scored(coded, model).withColumn("train_tokens", F.lit(model.totals.tokens).cast("long"))
    rows = rows if keep_text else coded.select(F.inline(F.arrays_zip("row_no", "row"))).select("row_no", "row.*")
    return rows.join(written(found, "lm-scores"), "row_no").drop("row_no")
