"""Benchmark decontamination by a distributed positional inverted index.

A benchmark item is cut into phrases of 13 words (a shorter one is one phrase). Of each phrase
the four rarest terms that the training texts have at all are looked up in an index of postings
(term, text, positions). Texts that hold the rarest one, or the one after it, are candidates; in
each of them the sorted lists of the terms, shifted by their offsets in the phrase, are intersected
from the rarest on, in time that grows with the lists' lengths. Where all of them stand where they
should, the text is compared word by word. Where they stand within a few words of that, but the
phrase does not, is a proximity match; the text may lack one of them, so a replaced word doesn't hide
a phrase, nor do a few that no text has.

The index holds the terms that some phrase is looked up by. Which terms those are goes to the
tasks as a bit map of fixed size: a term outside the benchmark that shares a bit costs a posting,
no more, so the benchmark may be of any size.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import bit_map, col, in_map, numbered, row_place, row_places, step_aside, without, written

WINDOW = 13
ANCHORS = 4
#: Words by which each term of a proximity match may be off.
SLOP = 4
#: Words of a phrase that no text may have, for it to be looked up at all.
UNSEEN = 4
#: Phrases that every task gets at a time, about: some 60 MB.
ASKED = 1 << 17
#: Places of a term up to which they are gone through one by one.
FEW = 32
#: Bits of the term map: 1 MB.
BITS = 1 << 23
#: Values that one of Spark's bitmap aggregates covers.
BITMAP = 32768
#: A-Z lowered; letters, digits and everything beyond ASCII stay; the rest parts words.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


def _texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    return batch.column(name).cast(pa.binary()).to_pylist()


def phrases(benchmark: DataFrame, item_id: str, text: str, window: int = WINDOW) -> DataFrame:
    """``item``, ``phrase`` (words joined by spaces), one row per distinct pair."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, found = [], []
            for item, whole in zip(batch.column("item").to_pylist(), _texts(batch)):
                w = words(whole)
                for i in range(max(1, len(w) - window + 1) if w else 0):
                    items.append(item)
                    found.append(b" ".join(w[i : i + window]).decode())
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(found, pa.string())], ["item", "phrase"])

    rows = benchmark.select(col(item_id).cast("string").alias("item"), col(text).alias("text"))
    return rows.mapInArrow(cut, "item string, phrase string").distinct()


def _term_map(terms: DataFrame) -> np.ndarray:
    """One byte per bucket: whether some term falls into it. At most ``BITS / BITMAP`` rows come back."""
    bucket = F.crc32(F.encode("term", "UTF-8")) % BITS
    parts = (
        terms.select((bucket / BITMAP).cast("int").alias("part"), (bucket % BITMAP).alias("bit"))
        .groupBy("part")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .collect()
    )
    out = np.zeros(BITS, np.uint8)
    for r in parts:
        bits = np.unpackbits(np.frombuffer(bytes(r["bits"]), np.uint8), bitorder="little")[:BITMAP]
        out[r["part"] * BITMAP : r["part"] * BITMAP + bits.size] = bits
    return out


def _frequencies(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """``term``, ``frequency`` in all texts, for the terms of the benchmark that occur at all."""
    shared = rows.sparkSession.sparkContext.broadcast(_term_map(terms).tobytes())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, crc = shared.value, zlib.crc32
        for batch in batches:
            counts: Counter[bytes] = Counter()
            for text in _texts(batch):
                counts.update(words(text))
            kept = {t: n for t, n in counts.items() if known[crc(t) % BITS]}
            yield pa.RecordBatch.from_arrays(
                [pa.array([t.decode() for t in kept], pa.string()), pa.array(list(kept.values()), pa.int64())],
                ["term", "n"],
            )

    counted = rows.select("text").mapInArrow(count, "term string, n long")
    return counted.groupBy("term").agg(F.sum("n").alias("frequency"))


def _index(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """Per text ``row_no``, ``n_words`` and ``postings``: positions of each term that is looked up."""
    shared = rows.sparkSession.sparkContext.broadcast(_term_map(terms).tobytes())

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, crc = shared.value, zlib.crc32
        looked_up: dict[bytes, bool] = {}
        for batch in batches:
            if len(looked_up) > 1_000_000:
                looked_up = {}
            sizes, held = [], [0]
            terms: list[bytes] = []
            positions: list[list[int]] = []
            for text in _texts(batch):
                w = words(text)
                places: dict[bytes, list[int]] = {}
                for t in set(w):
                    if (hit := looked_up.get(t)) is None:
                        hit = looked_up[t] = bool(known[crc(t) % BITS])
                    if hit:
                        places[t] = []
                if places:
                    for i, t in enumerate(w):
                        if t in places:
                            places[t].append(i)
                sizes.append(len(w))
                terms.extend(places)
                positions.extend(places.values())
                held.append(len(terms))
            ends = np.cumsum([0, *map(len, positions)])
            flat = pa.array(np.fromiter(chain.from_iterable(positions), np.int32, ends[-1]))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
            named = pa.array(terms, pa.binary()).view(pa.string())
            postings = pa.ListArray.from_arrays(
                pa.array(held, pa.int32()), pa.StructArray.from_arrays([named, lists], ["term", "positions"])
            )
            columns = [batch.column("row_no"), pa.array(sizes, pa.int64()), postings]
            yield pa.RecordBatch.from_arrays(columns, ["row_no", "n_words", "postings"])

    schema = "row_no long, n_words long, postings array<struct<term:string,positions:array<int>>>"
    return rows.select("row_no", "text").mapInArrow(post, schema)


@dataclass
class Found:
    """``index``: row_no, n_words, postings. ``exact``: row_no, n_hit, phrases (their numbers).

    ``near``: row_no, phrase_no of phrases with a place that matches by proximity only. ``phrases``:
    phrase_no, phrase. ``items``: phrase, item.
    """

    index: DataFrame
    exact: DataFrame
    near: DataFrame
    phrases: DataFrame
    items: DataFrame


def close_starts(lists: list[np.ndarray], offsets: list[int], slop: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a phrase may start, by its terms' sorted positions and offsets, the rarest term first.

    Every start puts the first term exactly where it stands and each other one at most ``slop`` words
    off; by how many, at most, comes with it.
    """
    lists = [np.asarray(at, np.int64) for at in lists]
    starts = lists[0] - offsets[0]
    away = np.zeros(len(starts), np.int64)
    for at, offset in zip(lists[1:], offsets[1:]):
        want = starts + offset
        i = np.searchsorted(at, want)
        below, above = at[np.maximum(i - 1, 0)], at[np.minimum(i, len(at) - 1)]
        away = np.maximum(away, np.minimum(np.abs(want - below), np.abs(above - want)))
        kept = away <= slop
        starts, away = starts[kept], away[kept]
    return starts, away


@dataclass(frozen=True)
class Asked:
    """A phrase as it is looked up: number, words, whether texts have all of them, terms and offsets, rarest first."""

    number: int
    n: int
    whole: bool
    terms: tuple[str, ...]
    offsets: tuple[int, ...]

    @property
    def leads(self) -> tuple[str, ...]:
        """A text without the rarest term may hold the phrase but for that word if it holds the next one."""
        return self.terms[: 1 + self.may_lack]

    @property
    def may_lack(self) -> int:
        """Terms that a text may lack: one, but of a short phrase it must have all."""
        return int(self.n > len(self.terms))


def _few_starts(lists: list[list[int]], offsets: list[int], slop: int) -> tuple[list[int], list[int]]:
    """``close_starts`` for a term that stands in few places."""
    starts, aways = [], []
    for place in lists[0]:
        start, away = place - offsets[0], 0
        for at, offset in zip(lists[1:], offsets[1:]):
            i = bisect_left(at, start + offset)
            away = max(away, min(abs(start + offset - x) for x in at[max(0, i - 1) : i + 1]))
            if away > slop:
                break
        else:
            starts.append(start)
            aways.append(away)
    return starts, aways


def _intersect(batches: Iterator[pa.RecordBatch], by_lead: dict[str, list[Asked]], slop: int) -> Iterator[pa.RecordBatch]:
    """Per text and phrase: how many starts are close, and those that may be exact."""
    for batch in batches:
        rows, numbers, sizes, close, exact = [], [], [], [], []
        postings = batch.column("postings")
        for i, (row, n_words) in enumerate(zip(batch.column("row_no").to_pylist(), batch.column("n_words").to_pylist())):
            terms, positions = postings[i].values.flatten()
            at = {t: j for j, t in enumerate(terms.to_pylist())}
            asked = {p.number: p for t in at for p in by_lead.get(t, ())}
            lists: dict[str, list[int]] = {}
            for phrase in asked.values():
                here = [k for k, t in enumerate(phrase.terms) if t in at]
                lacks = len(phrase.terms) - len(here)
                if lacks > phrase.may_lack:
                    continue
                for t in (phrase.terms[k] for k in here):
                    if t not in lists:
                        lists[t] = positions[at[t]].as_py()
                found = close_starts if len(lists[phrase.terms[here[0]]]) > FEW else _few_starts
                starts, aways = found([lists[phrase.terms[k]] for k in here], [phrase.offsets[k] for k in here], slop)
                if not len(starts):
                    continue
                may_be = phrase.whole and not lacks
                rows.append(row)
                numbers.append(phrase.number)
                sizes.append(phrase.n)
                close.append(len(starts))
                exact.append(
                    [s for s, away in zip(starts, aways) if not away and 0 <= s <= n_words - phrase.n] if may_be else []
                )
        columns = [pa.array(x, pa.int64()) for x in (rows, numbers, sizes, close)]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(exact, pa.list_(pa.int32()))], ["row_no", "phrase_no", "n", "close", "starts"]
        )


def _places(index: DataFrame, looked_up: DataFrame, slop: int) -> DataFrame:
    """``row_no``, ``phrase_no``, ``n``, ``close``, ``starts``, phrases in blocks of bounded size against all texts."""
    blocks = max(1, -(-looked_up.count() // ASKED))
    block = F.pmod(F.xxhash64("phrase_no"), F.lit(blocks))
    schema = "row_no long, phrase_no long, n long, close long, starts array<int>"
    found = []
    for b in range(blocks):
        by_lead: dict[str, list[Asked]] = {}
        for r in looked_up.where(block == b).collect():
            terms, offsets = zip(*[(a["term"], a["off"]) for a in r["anchors"]])
            phrase = Asked(r["phrase_no"], r["n"], r["whole"], terms, offsets)
            for t in set(phrase.leads):
                by_lead.setdefault(t, []).append(phrase)
        sent = index.sparkSession.sparkContext.broadcast(by_lead)
        here = index.mapInArrow(lambda batches, sent=sent: _intersect(batches, sent.value, slop), schema)
        found.append(written(here, "phrase-places"))
    return reduce(DataFrame.unionByName, found)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text: words inside a phrase that stands there word by word, and how often each one does."""
    for batch in batches:
        hits, counts = [], []
        for i, text in enumerate(_texts(batch)):
            w, spans, found = words(text), [], []
            for asked in batch.column("asked")[i].as_py():
                n, phrase = asked["n"], asked["phrase"].encode()
                true = [s for s in asked["starts"] if b" ".join(w[s : s + n]) == phrase]
                if true:
                    found.append({"phrase_no": asked["phrase_no"], "n_true": len(true)})
                    spans += [(s, s + n) for s in true]
            covered, end = 0, 0
            for start, stop in sorted(spans):
                covered += max(0, stop - max(end, start))
                end = max(end, stop)
            hits.append(covered)
            counts.append(found)
        kind = pa.list_(pa.struct([("phrase_no", pa.int64()), ("n_true", pa.int64())]))
        columns = [batch.column("row_no"), pa.array(hits, pa.int64()), pa.array(counts, kind)]
        yield pa.RecordBatch.from_arrays(columns, ["row_no", "n_hit", "found"])


def _those_in(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose ``row_no`` is in ``wanted``, and few others: none is shuffled to find out."""
    sent = rows.sparkSession.sparkContext.broadcast(bit_map(wanted, row_place(F.col("row_no"))))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_map(sent.value, row_places(batch.column("row_no").to_numpy()))))

    return rows.mapInArrow(kept, rows.schema)


def search(rows: DataFrame, items: DataFrame, anchors: int = ANCHORS, slop: int = SLOP) -> Found:
    """Look all phrases up in all texts. ``rows``: row_no, text; ``items``: item, phrase.

    A phrase with an unseen word is nowhere exactly. It is looked up by proximity if no more than a few
    of its words are unseen and as many terms are left to look it up by as other phrases have.
    """
    items = written(items, "benchmark-items")
    all_phrases = numbered(items.select("phrase").distinct(), "benchmark-phrases", "phrase_no")
    terms = all_phrases.select("phrase_no", F.posexplode(F.split("phrase", " ")).alias("off", "term"))
    frequencies = written(_frequencies(rows, terms), "benchmark-terms")
    seen = F.when(F.col("frequency").isNotNull(), F.struct("frequency", "off", "term"))
    looked_up = written(
        terms.join(frequencies, "term", "left")
        .groupBy("phrase_no")
        .agg(
            F.slice(F.sort_array(F.collect_list(seen)), 1, anchors).alias("anchors"),
            F.count("frequency").alias("met"),
            F.count("*").alias("n"),
        )
        .where((F.col("n") - F.col("met") <= UNSEEN) & (F.size("anchors") >= F.least("n", F.lit(anchors))))
        .select("phrase_no", "n", (F.col("met") == F.col("n")).alias("whole"), "anchors"),
        "benchmark-anchors",
    )
    index = written(_index(rows, looked_up.select(F.explode("anchors.term").alias("term")).distinct()), "positional-index")
    places = _places(index, looked_up, slop)
    may_be = places.where(F.size("starts") > 0)
    to_compare = written(
        may_be.join(all_phrases, "phrase_no")
        .groupBy("row_no")
        .agg(F.collect_list(F.struct("phrase_no", "n", "starts", "phrase")).alias("asked")),
        "phrase-asked",
    )
    texts = _those_in(rows.select("row_no", "text"), to_compare)
    schema = "row_no long, n_hit long, found array<struct<phrase_no:long,n_true:long>>"
    compared = to_compare.join(texts, "row_no").select("row_no", "text", "asked").mapInArrow(_compare, schema)
    compared = written(compared.where("n_hit > 0"), "phrase-matches")
    exact = compared.select("row_no", "n_hit", F.col("found.phrase_no").alias("phrases"))
    true = compared.select("row_no", F.inline("found"))
    near = places.join(true, ["row_no", "phrase_no"], "left").where("close > coalesce(n_true, 0)").select("row_no", "phrase_no")
    return Found(index, exact, near, all_phrases, items)


def judge(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """All rows and columns with ``n_words``, ``n_hit``, ``items``, ``n_near`` and ``contaminated``.

    ``n_hit`` counts words inside any exact match, ``items`` are the items matched, as sorted
    strings; ``n_near`` counts phrases that match by proximity only. Contaminated: some words are
    hit, at least one in twenty; proximity has no say in it. A null or empty text has no words; neither has such an item. Null item
    ids count as no item, though their phrases hit. Repeated rows are judged alike; an empty
    table on either side gives no hits. Input columns with a result's name become ``<name>_input``.
    """
    out = ("n_words", "n_hit", "items", "n_near", "contaminated", "row_no")
    rows = numbered(step_aside(df, out), "decontaminate-rows")
    result = _judged(rows, benchmark, text, item_id, item_text, window)
    return rows.join(written(result, "decontaminate-result"), "row_no").drop("row_no")


def clean(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """All columns of the rows that ``judge`` does not find contaminated."""
    rows = numbered(step_aside(df, ("row_no",)), "decontaminate-rows", level=9)
    result = _judged(rows, benchmark, text, item_id, item_text, window)
    return without(rows, result.where("contaminated"), "decontaminate-dropped").drop("row_no")


def _judged(
    rows: DataFrame, benchmark: DataFrame, text: str, item_id: str, item_text: str, window: int
) -> DataFrame:
    """``row_no`` and the results of numbered rows."""
    found = search(rows.select("row_no", col(text).alias("text")), phrases(benchmark, item_id, item_text, window))
    items = (
        found.exact.select("row_no", F.explode("phrases").alias("phrase_no"))
        .join(found.phrases, "phrase_no")
        .join(found.items, "phrase")
        .groupBy("row_no")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    near = found.near.groupBy("row_no").agg(F.count("*").alias("n_near"))
    contaminated = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return (
        found.index.select("row_no", "n_words")
        .join(found.exact.select("row_no", "n_hit"), "row_no", "left")
        .join(items, "row_no", "left")
        .join(near, "row_no", "left")
        .select(
            "row_no",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
        )
        .withColumn("contaminated", contaminated)
    )
